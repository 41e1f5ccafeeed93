"""Relational stores and the metadata catalog.

Connection options always come from the caller.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countermill.functions.hashing import HASH_LOWER, HASH_SLICES, HASH_UPPER, hash_slice
from countermill.functions.times import Day, day_column
from countermill.schemas import CATALOG


def hash_sliced_query(table: str, key: str, where: str | None = None) -> str:
    """Derived table with the signed 32-bit hash of ``key`` (Postgres syntax).

    ``where`` goes into the database query, so old or new rows are never moved.
    """
    condition = f" WHERE {where}" if where else ""
    return f"(SELECT t.*, ('x' || substr(md5({key}), 1, 8))::bit(32)::int AS key_hash FROM {table} t{condition}) AS sliced"


def read_hash_sliced(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    key: str,
    where: str | None = None,
    slices: int = HASH_SLICES,
) -> DataFrame:
    """A relational table read in ``slices`` parallel queries by key hash."""
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", hash_sliced_query(table, key, where))
        .option("partitionColumn", "key_hash")
        .option("lowerBound", HASH_LOWER)
        .option("upperBound", HASH_UPPER)
        .option("numPartitions", slices)
        .load()
        .drop("key_hash")
    )


def hash_sliced(df: DataFrame, key: str, slices: int = HASH_SLICES) -> DataFrame:
    """A DataFrame laid out in ``slices`` partitions by key hash."""
    return df.repartition(slices, F.col(key))


def read_query(spark: SparkSession, options: Mapping[str, str], query: str) -> DataFrame:
    """Result of a database query."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def backlog_older_than(backlog: DataFrame, today: Day, days: int = 3) -> DataFrame:
    """Backlog rows received more than ``days`` days before ``today``."""
    return backlog.filter(F.col("received_date") < F.date_sub(day_column(today), days))


@dataclass(frozen=True)
class Catalog:
    """The metadata tables as DataFrames, by name."""

    tables: Mapping[str, DataFrame]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> Catalog:
        """Catalog written with :func:`countermill.sinks.stores.write_catalog`."""
        return cls({name: spark.read.schema(schema).parquet(f"{folder}/{name}") for name, schema in CATALOG.items()})

    @classmethod
    def from_jdbc(cls, spark: SparkSession, options: Mapping[str, str]) -> Catalog:
        """Catalog kept in a relational database."""
        reader = spark.read.format("jdbc").options(**options)
        return cls({name: reader.option("dbtable", name).load() for name in CATALOG})
