"""One view over several versions of a table, and the type widening behind it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countermill.functions.types import MISSING, catalog_type, spark_type, widened, widened_column


def view_types(versions: Mapping[str, DataFrame], columns: Sequence[str] | None = None) -> dict[str, T.DataType]:
    """Column -> widened Spark type over all versions, in order of first sight."""
    seen: dict[str, list[str]] = {}
    originals: dict[str, set[str]] = {}
    for df in versions.values():
        for field in df.schema:
            if columns is None or field.name in columns:
                seen.setdefault(field.name, []).append(catalog_type(field.dataType))
                originals.setdefault(field.name, set()).add(field.dataType.json())
    types = {}
    for name, names in seen.items():
        if len(originals[name]) == 1:
            types[name] = T._parse_datatype_json_string(next(iter(originals[name])))
        else:
            types[name] = spark_type(widened(names))
    return types


def explode_with_index(df: DataFrame, column: str) -> DataFrame:
    """Array column to rows: ``<c>_index`` and ``<c>``; an empty or NULL array keeps its row."""
    others = [c for c in df.columns if c != column]
    index, item = f"{column}_index", f"_{column}_item"
    return df.select(*others, F.posexplode_outer(column).alias(index, item)).withColumnRenamed(item, column)


def explode_together(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Several array columns to rows by equal position, shorter ones padded with NULL."""
    others = [c for c in df.columns if c not in columns]
    zipped = F.posexplode_outer(F.arrays_zip(*columns)).alias("_index", "_items")
    rows = df.select(*others, zipped)
    return rows.select(
        *others,
        *[c for name in columns for c in (F.col("_index").alias(f"{name}_index"), F.col(f"_items.{name}").alias(name))],
    )


def merge_versions(
    versions: Mapping[str, DataFrame],
    columns: Sequence[str] | None = None,
    zip_arrays: bool = False,
) -> DataFrame:
    """UNION ALL of all versions under one schema, with a ``version`` column.

    Each column takes the narrowest type that holds every version's; a version
    without it gives NULL, and a version with none of the columns is left out.
    Array columns become ``<c>_index`` and ``<c>`` rows: several of them as
    their product per row, or by equal position with ``zip_arrays``.
    """
    types = view_types(versions, columns)
    arrays = [name for name, t in types.items() if isinstance(t, T.ArrayType)]

    def part(version: str, df: DataFrame) -> DataFrame:
        present = [c for c in types if c in df.columns]
        rows = df.select([F.col(c).cast(types[c]).alias(c) for c in present])
        own_arrays = [c for c in arrays if c in present]
        if zip_arrays and len(own_arrays) > 1:
            rows = explode_together(rows, own_arrays)
        else:
            rows = reduce(explode_with_index, own_arrays, rows)
        return rows.select(F.lit(version).alias("version"), *[c for name in types for c in output(name, name in present)])

    def output(name: str, present: bool) -> list[Column]:
        index = f"{name}_index"
        item_type = types[name].elementType if name in arrays else types[name]
        value = F.col(name) if present else F.lit(None).cast(item_type)
        if name not in arrays:
            return [value.alias(name)]
        place = F.col(index) if present else F.lit(None).cast("int")
        return [place.alias(index), value.alias(name)]

    parts = [part(v, df) for v, df in versions.items() if any(c in df.columns for c in types)]
    return reduce(DataFrame.unionByName, parts)


def widened_columns(columns: DataFrame) -> DataFrame:
    """Catalog form of the widening: (entity, column, type) over all versions.

    Input: (entity, version, column, type). A column missing everywhere keeps
    the type name MISSING.
    """
    # As many distinct types as a column ever had.
    return columns.groupBy("entity", "column").agg(F.collect_set("type").alias("types")).select(
        "entity", "column", widened_column("types").alias("type")
    )


def usable_versions(columns: DataFrame) -> DataFrame:
    """(entity, version) pairs with at least one present column, and its counts."""
    absent = F.count_if(F.col("type") == MISSING)
    counts = columns.groupBy("entity", "version").agg(absent.alias("absent"), F.count(F.lit(1)).alias("columns"))
    return counts.filter(F.col("absent") < F.col("columns"))


def column_versions(columns: DataFrame) -> DataFrame:
    """Versions that share one column signature: (entity, column, type, versions).

    ``versions`` joins the distinct version names with ``::``, in order; there
    are as many as software releases, so the set stays small.
    """
    versions = F.array_join(F.array_sort(F.collect_set("version")), "::")
    return columns.filter(F.col("type") != MISSING).groupBy("entity", "column", "type").agg(versions.alias("versions"))
