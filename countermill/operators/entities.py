"""Entity tables: wide, vector, and their duplicate rule."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Literal

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countermill.functions.counters import first_integer, map_value, vector_bins
from countermill.operators.flatten import explode_counters
from countermill.schemas import KEY_COLUMNS, ORIGIN_COLUMNS, VECTOR_BINS

# Up to this many counters, one conditional aggregate each is cheaper than a
# pivot: it shuffles once where the pivot shuffles twice. Beyond it the pivot
# wins, because every row would be tested against every counter. Measured on 4.8
# million rows: even at 8 counters, 3 times slower at 32, 12 times at 256.
CONDITIONAL_COUNTERS = 12


def select_measurement(long: DataFrame, measurement: str | None, counters: Sequence[str]) -> DataFrame:
    """Rows of one object class and the listed counters."""
    rows = long if measurement is None else long.filter(F.col("measurement") == measurement)
    return rows.filter(F.col("counter_name").isin(list(counters)))


def _order(order_by: Sequence[str]) -> Column:
    # A single fixed-width column keeps the aggregation hash-based.
    return F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)


def _aggregate(agg: str, value: Column, order: Column | None) -> Column:
    if agg == "sum":
        return F.sum(value)
    return F.min_by(value, F.when(value.isNotNull(), order))


def to_entity(
    long: DataFrame,
    counters: Sequence[str],
    measurement: str | None = None,
    agg: Literal["first", "sum"] = "first",
    keys: Sequence[str] = KEY_COLUMNS,
    order_by: Sequence[str] = ORIGIN_COLUMNS,
    conditional_limit: int = CONDITIONAL_COUNTERS,
) -> DataFrame:
    """One row per key, one column per counter.

    Where several rows give a counter for one key, ``first`` takes the one that
    comes first by ``order_by`` and has a value, as in :func:`merge_rows`, and
    ``sum`` adds them up. Both are combined
    before the shuffle, so a key with very many rows costs one small row per
    task.
    """
    rows = select_measurement(long, measurement, counters)
    value = F.col("counter_value")
    if len(counters) > conditional_limit:
        order = _order(order_by) if agg == "first" else None
        return rows.groupBy(*keys).pivot("counter_name", list(counters)).agg(_aggregate(agg, value, order))

    def column(name: str) -> Column:
        mine = F.col("counter_name") == name
        order = F.when(mine, _order(order_by)) if agg == "first" else None
        return _aggregate(agg, F.when(mine, value), order).alias(name)

    return rows.groupBy(*keys).agg(*[column(name) for name in counters])


def to_entity_from_map(
    maps: DataFrame,
    counters: Mapping[str, str],
    measurement: str | None = None,
    keys: Mapping[str, str] | Sequence[str] = KEY_COLUMNS,
    map_column: str = "counters",
    integers: bool = False,
) -> DataFrame:
    """Wide rows straight from the counter map: no explode, no pivot, no shuffle.

    ``counters`` and ``keys`` map column names to their sources. Use it where a
    key occurs once. Values stay raw text, or with ``integers`` become what the
    long table holds; rows that may repeat a key go through :func:`merge_rows`.
    """
    rows = maps if measurement is None else maps.filter(F.col("measurement") == measurement)
    sources = keys if isinstance(keys, Mapping) else {key: key for key in keys}

    def value(source: str) -> Column:
        raw = map_value(map_column, source)
        return first_integer(raw) if integers else raw

    return rows.select(
        *[F.col(source).alias(name) for name, source in sources.items()],
        *[value(source).alias(name) for name, source in counters.items()],
    )


def merge_rows(
    wide: DataFrame,
    counters: Sequence[str],
    keys: Sequence[str] = KEY_COLUMNS,
    agg: Literal["first", "sum"] = "first",
    order_by: Sequence[str] = ORIGIN_COLUMNS,
) -> DataFrame:
    """Wide rows of equal key to one: per counter the first value that is there, or the sum.

    For keys spread over several info blocks or files. It shuffles one wide row
    per instance, with its keys once, where :func:`to_entity` shuffles one row
    per counter: far fewer bytes for many counters. ``first`` costs more CPU than
    there, unless ``order_by`` is a single number, which keeps it hash-based.
    """

    def merged(name: str) -> Column:
        value = F.col(name)
        return _aggregate(agg, value, _order(order_by)).alias(name)

    return wide.groupBy(*keys).agg(*[merged(name) for name in counters])


def to_vector_rows(
    raw: DataFrame, keys: Sequence[str] = KEY_COLUMNS, bins: int = VECTOR_BINS, bin_type: str = "string"
) -> DataFrame:
    """Raw counter rows with the value split into ``bin0..bin<n-1>``; short ones padded with NULL."""
    split = raw.select(*keys, F.col("counter_name_raw").alias("counter_name"), vector_bins("counter_value_raw").alias("bins"))
    return bin_columns(split, [*keys, "counter_name"], "bins", bins, bin_type)


@dataclass(frozen=True)
class EntitySpec:
    """What one entity table takes from the long rows."""

    name: str
    measurement: str
    counters: tuple[str, ...]
    agg: Literal["first", "sum"] = "first"
    keys: tuple[str, ...] = tuple(KEY_COLUMNS)


def write_entities(
    long: DataFrame,
    specs: Sequence[EntitySpec],
    write: Callable[[str, DataFrame], None],
    concurrent: int = 4,
) -> None:
    """Write every entity of a batch with ``write(name, wide rows)``.

    For sinks that need one table per entity. The long rows are persisted once
    for all of them, and a few entities are written at a time, so that small
    ones do not leave the cluster idle. Sinks that can hold long rows take them
    in one job instead: see :func:`countermill.sinks.stores.write_long`.
    """
    rows = long.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(concurrent) as pool:
            jobs = [
                pool.submit(write, s.name, to_entity(rows, s.counters, s.measurement, s.agg, s.keys)) for s in specs
            ]
            for job in jobs:
                job.result()
    finally:
        rows.unpersist()


def bin_columns(
    df: DataFrame, kept: Sequence[str], values: str, bins: int = VECTOR_BINS, bin_type: str = "string"
) -> DataFrame:
    """An array column spread over ``bins`` columns; missing places are NULL.

    A longer array fails the query, as its last values would have no column;
    :func:`vector_long` takes any length.
    """
    fits = F.coalesce(F.size(values), F.lit(0)) <= bins
    df = df.filter(F.assert_true(fits, f"an array has more than {bins} values").isNull())

    def at(i: int) -> Column:
        value = F.get(F.col(values), F.lit(i))
        return value if bin_type == "string" else value.try_cast(bin_type)

    return df.select(*kept, *[at(i).alias(f"bin{i}") for i in range(bins)])


def to_vector_entity(
    maps: DataFrame,
    counters: Sequence[str],
    measurement: str | None = None,
    keys: Sequence[str] = KEY_COLUMNS,
    bins: int = VECTOR_BINS,
    bin_type: str = "string",
) -> DataFrame:
    """One row per key and vector counter (raw names), one column per bin."""
    rows = maps if measurement is None else maps.filter(F.col("measurement") == measurement)
    return to_vector_rows(explode_counters(rows, counters), keys, bins, bin_type)


def vector_long(raw: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Long form of vector counters: one row per filled bin, position from 0."""
    bins = F.posexplode_outer(vector_bins("counter_value_raw")).alias("bin", "value")
    return raw.select(*keys, F.col("counter_name_raw").alias("counter_name"), bins).filter(F.col("bin").isNotNull())
