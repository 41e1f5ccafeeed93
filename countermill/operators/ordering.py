"""Order-dependent steps that never need a whole group in one task.

A window over an entire log or table would hand one task everything its group
holds. Here a group is cut into blocks of bounded size; windows run inside a
block, and a second, tiny pass over one row per block links the blocks. Rows
carry ``pos``, their order in the group, and ``block``, which never falls as
``pos`` grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from countermill.functions.columns import ColumnLike, as_column
from countermill.session import durable

BLOCK_ROWS = 1_000_000


def with_blocks(df: DataFrame, pos: ColumnLike, rows: int = BLOCK_ROWS) -> DataFrame:
    """Add (block, pos): a whole-number position that no two rows of a group share, and its block."""
    position = as_column(pos).cast("bigint")
    return df.withColumn("pos", position).withColumn("block", F.expr(f"pos div {rows}"))


def _linked(df: DataFrame, group: Sequence[str], carried: Column, names: dict[str, str]) -> DataFrame:
    """Join each block with the value its predecessors hand over."""
    ends = df.groupBy(*group, "block").agg(carried.alias(names["end"]))
    before = W.partitionBy(*group).orderBy("block")
    if names["reach"] == "last":
        handed = F.last(names["end"], ignorenulls=True).over(before.rowsBetween(W.unboundedPreceding, -1))
    else:
        handed = F.lag(names["end"]).over(before)
    links = ends.withColumn(names["handed"], handed).drop(names["end"])
    return df.join(links, [*group, "block"], "left")


def carry_forward(df: DataFrame, value: Column, name: str, group: Sequence[str] = ("source_file",)) -> DataFrame:
    """``name``: the last non-null ``value`` at or before each row, by pos in its group."""
    own, end, handed = f"_{name}_own", f"_{name}_end", f"_{name}_handed"
    marked = df.withColumn(own, value)
    last_own = F.max_by(own, F.when(F.col(own).isNotNull(), F.col("pos")))
    linked = _linked(marked, group, last_own, {"end": end, "handed": handed, "reach": "last"})
    in_block = W.partitionBy(*group, "block").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    current = F.coalesce(F.last(own, ignorenulls=True).over(in_block), F.col(handed))
    return linked.withColumn(name, current).drop(own, handed)


def previous(df: DataFrame, value: Column, name: str, group: Sequence[str] = ("source_file",)) -> DataFrame:
    """``name``: ``value`` of the row before, by pos in its group."""
    own, end, handed = f"_{name}_own", f"_{name}_end", f"_{name}_handed"
    marked = df.withColumn(own, value)
    last_row = F.max_by(F.struct(F.col(own).alias("v")), "pos")["v"]
    linked = _linked(marked, group, last_row, {"end": end, "handed": handed, "reach": "lag"})
    in_block = W.partitionBy(*group, "block").orderBy("pos")
    first = F.row_number().over(in_block) == 1
    return linked.withColumn(name, F.when(first, F.col(handed)).otherwise(F.lag(own).over(in_block))).drop(own, handed)


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, total: str) -> DataFrame:
    """Number the rows of each group from 0 by ``order`` and add the group's row count.

    Rows are range-partitioned by group and order, so one big group spreads over
    many partitions; each partition numbers its own rows and adds the rows of
    the partitions before it. The ranged rows are checkpointed because both uses
    below must see the very same ranges: range bounds come from a sample.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in (*group, *order)])
    placed = durable(ranged.withColumn("_part", F.spark_partition_id()))
    counts = placed.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    parts = W.partitionBy(*group)
    offsets = counts.select(
        *group,
        "_part",
        F.coalesce(
            F.sum("_rows").over(parts.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
        F.sum("_rows").over(parts).alias(total),
    )
    local = F.row_number().over(W.partitionBy(*group, "_part").orderBy(*order)) - 1
    return (
        placed.join(offsets, [*group, "_part"])
        .withColumn(name, (F.col("_before") + local).cast("bigint"))
        .drop("_part", "_before")
    )
