"""Type names of the catalog, their Spark types and their widening order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countermill.functions.columns import ColumnLike, as_column

# Widening order of the merged views, narrowest first.
WIDENING_ORDER = ["TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "VARCHAR"]

# Cold-store type -> hot-store (relational) type.
HOT_STORE_TYPES = {
    "DOUBLE": "DOUBLE PRECISION",
    "REAL": "DOUBLE PRECISION",
    "FLOAT": "REAL",
    "INT": "INTEGER",
    "TINYINT": "SMALLINT",
    "VARCHAR": "VARCHAR",
    "CHAR": "VARCHAR",
    "STRING": "VARCHAR",
}

# Text types share one place in the widening order.
TEXT_TYPES = ["VARCHAR", "CHAR", "STRING"]

# FLOAT has 24 bits for digits: with any of these only DOUBLE holds both. DOUBLE
# in turn rounds BIGINT values beyond 2^53, as no wider number type is used.
WIDER_THAN_FLOAT_DIGITS = ["INT", "BIGINT"]

MISSING = "MISSING"


def split_size(type_name: str) -> tuple[str, int | None]:
    """``ARRAY<BIGINT>:12`` as (``ARRAY<BIGINT>``, 12)."""
    base, _, size = type_name.strip().partition(":")
    return base.upper(), int(size) if size else None


def element_type(type_name: str) -> str | None:
    """Element type name of an ``ARRAY<...>`` type name, else None."""
    base, _ = split_size(type_name)
    return base[len("ARRAY<") : -1] if base.startswith("ARRAY<") else None


def spark_type(type_name: str) -> T.DataType:
    """Spark type of a catalog type name (sizes are ignored)."""
    element = element_type(type_name)
    if element is not None:
        return T.ArrayType(spark_type(element))
    base, _ = split_size(type_name)
    if base.split("(")[0] in TEXT_TYPES:
        return T.StringType()
    return T.StructType.fromDDL(f"c {'DOUBLE' if base == 'REAL' else base}")[0].dataType


def catalog_type(data_type: T.DataType) -> str:
    """Catalog type name of a Spark type."""
    if isinstance(data_type, T.ArrayType):
        return f"ARRAY<{catalog_type(data_type.elementType)}>"
    return "VARCHAR" if isinstance(data_type, T.StringType) else data_type.simpleString().upper()


def hot_store_type(type_name: str) -> str:
    """Relational type of a catalog type name; arrays become ``<type> []``."""
    element = element_type(type_name)
    if element is not None:
        return f"{element} []"
    base, _ = split_size(type_name)
    return HOT_STORE_TYPES.get(base, base)


def hot_store_type_column(type_name: ColumnLike) -> Column:
    """Column form of :func:`hot_store_type`, for whole catalogs."""
    base = F.upper(F.trim(F.substring_index(as_column(type_name), ":", 1)))
    element = F.regexp_extract(base, r"^ARRAY<(.*)>$", 1)
    mapped = base
    for cold, hot in HOT_STORE_TYPES.items():
        mapped = F.when(base == cold, F.lit(hot)).otherwise(mapped)
    return F.when(element != "", F.concat(element, F.lit(" []"))).otherwise(mapped)


def data_type_size(type_name: ColumnLike) -> Column:
    """Size suffix of ``ARRAY<t>:n`` as INT, else NULL."""
    return F.regexp_extract(as_column(type_name), r":(\d+)$", 1).try_cast("int")


def counter_data_type(data_type: ColumnLike, is_vector: Column, max_length: ColumnLike) -> Column:
    """Column type of a counter: long kinds become BIGINT, vectors ``ARRAY<t>:n``."""
    scalar = F.when(as_column(data_type).isin("long", "longlong"), F.lit("BIGINT")).otherwise(as_column(data_type))
    vector = F.concat(F.lit("ARRAY<"), scalar, F.lit(">:"), as_column(max_length))
    return F.when(is_vector, vector).otherwise(scalar)


def _unsized(type_name: str) -> str:
    """Base type name; every text type, sized or not, is VARCHAR."""
    base, _ = split_size(type_name)
    return "VARCHAR" if base.split("(")[0] in TEXT_TYPES else base


def widened(type_names: Iterable[str]) -> str:
    """Narrowest type name that holds all given ones; missing ones do not count.

    Text types are VARCHAR, alone or with others, as their sizes may differ.
    """
    present = [_unsized(t) for t in type_names if t != MISSING]
    if not present:
        return MISSING
    elements = [element_type(t) for t in present]
    if all(e is not None for e in elements):
        return f"ARRAY<{widened(elements)}>"
    if len(set(present)) == 1:
        return present[0]
    if all(t in WIDENING_ORDER for t in present):
        widest = max(present, key=WIDENING_ORDER.index)
        return "DOUBLE" if widest == "FLOAT" and any(t in WIDER_THAN_FLOAT_DIGITS for t in present) else widest
    return "VARCHAR"


def _widened_column(types: Column) -> Column:
    """Column form for an array of type names without array sizes or missing ones."""
    text = lambda t: F.regexp_extract(t, r"^(\w+)", 1).isin(TEXT_TYPES)
    plain = F.array_distinct(F.transform(types, lambda t: F.when(text(t), F.lit("VARCHAR")).otherwise(t)))
    order = F.array(*[F.lit(t) for t in WIDENING_ORDER])
    places = F.transform(plain, lambda t: F.array_position(order, t).cast("int"))
    widest = F.get(order, F.array_max(places) - 1)
    digits = F.arrays_overlap(plain, F.array(*[F.lit(t) for t in WIDER_THAN_FLOAT_DIGITS]))
    number = F.when((widest == "FLOAT") & digits, F.lit("DOUBLE")).otherwise(widest)
    mixed = F.when(F.array_contains(places, 0), F.lit("VARCHAR")).otherwise(number)
    return F.when(F.size(plain) == 1, plain[0]).otherwise(mixed)


def widened_column(type_names: ColumnLike) -> Column:
    """:func:`widened` of an array column of type names."""
    names = F.transform(as_column(type_names), lambda t: F.upper(F.trim(F.substring_index(t, ":", 1))))
    present = F.array_distinct(F.filter(names, lambda t: t != MISSING))
    element = lambda t: F.regexp_extract(t, r"^ARRAY<(.*)>$", 1)
    of_arrays = F.forall(present, lambda t: t.startswith("ARRAY<"))
    elements = _widened_column(F.transform(present, element))
    whole = F.when(of_arrays, F.concat(F.lit("ARRAY<"), elements, F.lit(">"))).otherwise(_widened_column(present))
    return F.when(F.size(present) == 0, F.lit(MISSING)).otherwise(whole)
