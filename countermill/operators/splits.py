"""Column splits of one table stitched back together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _has_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def stitch_splits(splits: Sequence[DataFrame], keys: Sequence[str], unique_keys: bool = False) -> DataFrame:
    """Full outer join of the splits on ``keys``.

    Rows with a NULL key match nothing and are unioned aside, without a shuffle.
    With ``unique_keys`` (no split repeats a
    key) the splits are unioned and aggregated instead: one shuffle for any
    number of splits, combined before it. A key that is repeated after all fails
    the query.
    """
    columns = list(dict.fromkeys(c for split in splits for c in split.columns))
    loose = [split.filter(_has_null(keys)) for split in splits]
    keyed = [split.filter(~_has_null(keys)) for split in splits]
    if unique_keys:
        values = [c for c in columns if c not in keys]
        flags = [f"_rows{i}" for i in range(len(keyed))]
        marked = [split.withColumn(flag, F.lit(1)) for split, flag in zip(keyed, flags)]
        merged = _union(marked).groupBy(*keys).agg(
            *[F.any_value(c, True).alias(c) for c in values],
            F.greatest(*[F.coalesce(F.count(flag), F.lit(0)) for flag in flags], F.lit(0)).alias("_repeats"),
        )
        joined = merged.filter(F.assert_true(F.col("_repeats") <= 1, "a split repeats a key").isNull()).drop("_repeats")
        return _union([joined, *loose]).select(*columns)

    joined = reduce(lambda a, b: a.join(b, list(keys), "full_outer"), keyed)
    return _union([joined, *loose]).select(*columns)


def natural_full_join(tables: Sequence[DataFrame]) -> DataFrame:
    """NATURAL FULL JOIN of tables that share all their columns.

    Equal rows without NULL collapse: m copies on one side and n on the other
    give m*n, a side without the row gives the other side's copies. Rows with
    any NULL never match and all stay: m+n copies. So counting copies per side
    is enough; equal rows are combined before the only shuffle.
    """
    columns = tables[0].columns
    sides = [f"_copies{i}" for i in range(len(tables))]

    def tagged(i: int, df: DataFrame) -> DataFrame:
        present = [F.lit(1 if j == i else 0).cast("bigint").alias(s) for j, s in enumerate(sides)]
        return df.select(*columns, *present)

    counted = (
        _union([tagged(i, df) for i, df in enumerate(tables)])
        .groupBy(*columns)
        .agg(*[F.sum(s).alias(s) for s in sides])
    )
    matched = reduce(lambda a, b: a * b, [F.greatest(F.col(s), F.lit(1)) for s in sides])
    unmatched = reduce(lambda a, b: a + b, [F.col(s) for s in sides])
    copies = F.when(_has_null(columns), unmatched).otherwise(matched)
    repeated = counted.select(*columns, copies.alias("_copies"))
    # Copies are emitted in two levels, so no row builds an array longer than a chunk.
    chunk = 10_000
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / chunk))
    spread = repeated.select(*columns, "_copies", F.explode(chunks).alias("_chunk"))
    left = F.least(F.col("_copies") - F.col("_chunk") * chunk, F.lit(chunk)).cast("int")
    return spread.select(*columns, F.explode(F.array_repeat(F.lit(1), left)).alias("_one")).drop("_one")
