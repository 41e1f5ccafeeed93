"""Column functions for counter lists, maps and values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from countermill.functions.columns import ColumnLike, as_column


def all_distinct(values: ColumnLike) -> Column:
    """True when an array holds no value twice (NULL array: NULL)."""
    values = as_column(values)
    return F.size(F.array_distinct(values)) == F.size(values)


def counter_name_at(names: ColumnLike, index: ColumnLike, index_base: int = 0) -> Column:
    """Name a result refers to; NULL when the index lies outside the list."""
    return F.get(as_column(names), (as_column(index) - F.lit(index_base)).cast("int"))


def last_results(
    names: ColumnLike, results: ColumnLike, index_base: int = 0, names_distinct: Column | None = None
) -> Column:
    """The result list without entries that a later one of the same name replaces.

    Lists without repeated names, nearly all of them, come back as they are: two
    hash-based distinct counts decide that, so the per-entry search only ever
    runs on a list that needs it.
    """
    names, results = as_column(names), as_column(results)
    unique = (names_distinct if names_distinct is not None else all_distinct(names)) & all_distinct(
        results.getField("_p")
    )

    def without_replaced(named: Column) -> Column:
        later = lambda i: F.slice(named, i + F.lit(2), F.size(named))
        return F.filter(results, lambda r, i: ~F.coalesce(F.array_contains(later(i), F.get(named, i)), F.lit(False)))

    named_lists = F.array(F.transform(results, lambda r: counter_name_at(names, r["_p"], index_base)))
    return F.when(F.coalesce(unique, F.lit(True)), results).otherwise(
        F.get(F.transform(named_lists, without_replaced), F.lit(0))
    )


def counter_map(
    names: ColumnLike, results: ColumnLike, index_base: int = 0, names_distinct: Column | None = None
) -> Column:
    """Positional join of a name list and a result list into MAP<name, raw text>.

    ``results`` is ARRAY<STRUCT<_p, _VALUE>>; ``_p`` indexes ``names`` from
    ``index_base``. An index outside the list is dropped. A repeated name keeps
    its last value.
    """
    names = as_column(names)
    entries = F.transform(
        last_results(names, results, index_base, names_distinct),
        lambda r: F.struct(counter_name_at(names, r["_p"], index_base).alias("key"), r["_VALUE"].alias("value")),
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["key"].isNotNull()))


def name_index(names: ColumnLike) -> Column:
    """MAP<_p, name> from ARRAY<STRUCT<_p, _VALUE>>; a repeated index keeps its last name."""
    names = as_column(names)
    known = F.filter(names, lambda n: n["_p"].isNotNull())

    def last_per_index(keys: Column) -> Column:
        later = lambda i: F.slice(keys, i + F.lit(2), F.size(keys))
        return F.filter(known, lambda n, i: ~F.array_contains(later(i), n["_p"]))

    entries = F.when(F.coalesce(all_distinct(known.getField("_p")), F.lit(True)), known).otherwise(
        F.get(F.transform(F.array(known.getField("_p")), last_per_index), F.lit(0))
    )
    return F.map_from_entries(F.transform(entries, lambda n: F.struct(n["_p"], n["_VALUE"])))


def indexed_counter_map(names: ColumnLike, results: ColumnLike) -> Column:
    """Equi join of two (_p, _VALUE) lists on ``_p`` into MAP<name, raw text>.

    Results whose index has no name are dropped; a repeated name keeps its last
    value.
    """
    lookups = F.array(name_index(names))

    def join(lookup: Column) -> Column:
        named = F.filter(
            F.transform(
                as_column(results),
                lambda r: F.struct(
                    F.try_element_at(lookup, r["_p"]).alias("key"), r["_VALUE"].cast("string").alias("value")
                ),
            ),
            lambda e: e["key"].isNotNull(),
        )
        return last_entries(named)

    return F.map_from_entries(F.get(F.transform(lookups, join), F.lit(0)))


def last_entries(entries: ColumnLike) -> Column:
    """(key, value) list without entries that a later one of the same key replaces."""
    bound = F.array(as_column(entries))

    def dedupe(es: Column) -> Column:
        keys = es.getField("key")
        later = lambda i: F.slice(keys, i + F.lit(2), F.size(keys))
        return F.when(all_distinct(keys), es).otherwise(
            F.filter(es, lambda e, i: ~F.array_contains(later(i), e["key"]))
        )

    return F.get(F.transform(bound, dedupe), F.lit(0))


def first_integer(value: ColumnLike) -> Column:
    """Integer before the first comma; NULL for empty or non-numeric text."""
    return F.substring_index(as_column(value), ",", 1).try_cast("bigint")


def map_value(counters: ColumnLike, name: str) -> Column:
    """Value of one counter of a counter map, NULL when the map lacks it."""
    return as_column(counters)[F.lit(name)]


def vector_bins(value: ColumnLike) -> Column:
    """Comma-separated bins as ARRAY<STRING>."""
    return F.split(as_column(value), ",")
