"""Sinks for entity tables, the cold store and the catalog."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from itertools import chain, islice
from typing import Any

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countermill.functions.types import catalog_type, hot_store_type
from countermill.schemas import CATALOG

# Task code travels with its task, so workers need no copy of this package.
register_pickle_by_value(sys.modules[__name__])


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run ``write(df)`` and return the number of rows written, without another pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def jdbc_column_types(schema: T.StructType, text_type: str = "VARCHAR(255)") -> str:
    """``createTableColumnTypes`` of a schema: text columns as ``text_type``.

    Arrays are left to the database dialect, which alone can declare them.
    """
    parts = []
    for field in schema:
        if isinstance(field.dataType, T.StringType):
            parts.append(f"`{field.name}` {text_type}")
        elif not isinstance(field.dataType, T.ArrayType):
            parts.append(f"`{field.name}` {_createable(field.dataType)}")
    return ", ".join(parts)


def _createable(data_type: T.DataType) -> str:
    # Spark parses this option with its own type names.
    return data_type.simpleString().upper()


def hot_store_columns(schema: T.StructType) -> list[tuple[str, str]]:
    """Column names and relational types of an entity table."""
    return [(f.name, hot_store_type(catalog_type(f.dataType))) for f in schema]


def entity_table_name(pack: str, entity: str) -> str:
    """Hot-store table of an entity: ``<pack>_<entity>``."""
    return f"{pack}_{entity}"


def append_hot(
    df: DataFrame, options: Mapping[str, str], table: str, text_type: str = "VARCHAR(255)"
) -> None:
    """Append entity rows to a relational table."""
    (
        df.write.format("jdbc")
        .mode("append")
        .options(**options)
        .option("dbtable", table)
        .option("createTableColumnTypes", jdbc_column_types(df.schema, text_type))
        .save()
    )


def write_cold(df: DataFrame, path: str, partition_columns: Sequence[str] = ("date_id",), append: bool = False) -> None:
    """Write partitioned Parquet.

    By default the partitions present in ``df`` are replaced, so a rerun after a
    failure leaves each row once, but so does a second part of a partition: ``df``
    must hold its partitions whole. ``append`` adds files instead.
    """
    writer = df.write.partitionBy(*partition_columns)
    if append:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_long(df: DataFrame, path: str, batch: str) -> None:
    """All entities of a batch in one pass: long rows by batch, measurement and day.

    One job serves any number of entities; clustering by the partition columns
    first keeps the number of files per folder small, and AQE splits the
    clusters that are too large for one task. A day comes in many batches:
    writing a batch again replaces what it wrote before, and nothing else.
    """
    clustered = df.withColumn("batch_id", F.lit(batch)).hint("rebalance", "measurement", "date_id")
    write_cold(clustered, path, ["batch_id", "measurement", "date_id"])


def delete_by_key(
    keys: DataFrame,
    connect: Callable[[], Any],
    table: str,
    column: str,
    placeholder: str = "%s",
    batch: int = 500,
) -> None:
    """Delete rows of a relational table whose ``column`` is in ``keys``.

    Every partition opens one connection with the caller's ``connect`` (DB-API)
    and deletes its own keys in one transaction. Deleting twice is harmless, so
    a retried task is too.
    """

    def delete(rows: Iterable[Row]) -> None:
        chunks = _chunks((row[0] for row in rows), batch)
        first = next(chunks, None)
        if first is None:
            return
        connection = connect()
        try:
            cursor = connection.cursor()
            for chunk in chain([first], chunks):
                marks = ", ".join([placeholder] * len(chunk))
                cursor.execute(f"DELETE FROM {table} WHERE {column} IN ({marks})", chunk)
            connection.commit()
        finally:
            connection.close()

    keys.select(column).distinct().foreachPartition(delete)


def _chunks(values: Iterator[Any], size: int) -> Iterator[list]:
    while chunk := list(islice(values, size)):
        yield chunk


def write_catalog(tables: Mapping[str, DataFrame], folder: str, mode: str = "overwrite") -> None:
    """Write catalog tables as Parquet, every column in its declared type."""
    for name, df in tables.items():
        schema = T.StructType.fromDDL(CATALOG[name])
        df.select([df[f.name].cast(f.dataType) for f in schema]).write.mode(mode).parquet(f"{folder}/{name}")
