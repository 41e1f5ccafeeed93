"""Ageing: move the oldest day from the hot to the cold store, and retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from countermill.functions.times import Day, between_days_ago, date_id, day_column
from countermill.operators.partitions import drop_partitions
from countermill.sinks.stores import write_cold

# The window of days ago that may age, both ends included.
NEWEST_DAYS, OLDEST_DAYS = 3, 5


def ageing_window(
    df: DataFrame, today: Day, newest: int = NEWEST_DAYS, oldest: int = OLDEST_DAYS, moment: str = "ropendtime"
) -> DataFrame:
    """Rows whose period ended within the window of days before ``today``."""
    return df.filter(between_days_ago(moment, today, newest, oldest))


def oldest_day(
    df: DataFrame,
    today: Day,
    newest: int = NEWEST_DAYS,
    oldest: int = OLDEST_DAYS,
    moment: str = "ropendtime",
    slack_days: int | None = None,
) -> DataFrame:
    """One row: the oldest ``date_id`` with a row inside the window, or NULL.

    ``slack_days`` states how far a row's ``date_id`` may lie from its moment (a day, where it is
    the local one); then only folders of these days are read.
    """
    inside = ageing_window(df, today, newest, oldest, moment)
    if slack_days is not None:
        day = day_column(today)
        first, last = (date_id(F.date_sub(day, n)) for n in (oldest + slack_days, newest - slack_days))
        inside = inside.filter(F.col("date_id").between(first, last))
    return inside.agg(F.min("date_id").alias("date_id"))


def age_out(
    df: DataFrame, today: Day, newest: int = NEWEST_DAYS, oldest: int = OLDEST_DAYS, moment: str = "ropendtime"
) -> tuple[DataFrame, DataFrame]:
    """(archived, remaining).

    Only the oldest ``date_id`` found in the window moves, and all its rows do,
    also those outside the window. The day is a scalar subquery: on a table
    partitioned by ``date_id`` it prunes folders, and nothing is joined.
    """
    day = oldest_day(df, today, newest, oldest, moment).scalar()
    moves = F.coalesce(F.col("date_id") == day, F.lit(False))
    return df.filter(F.col("date_id") == day), df.filter(~moves)


def _content(columns: Sequence[str]) -> list[Column]:
    """Row count and checksum of rows in any order; repeated rows count each time."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("checksum")]


def archive_oldest(
    spark: SparkSession,
    table: str,
    cold_path: str,
    today: Day,
    newest: int = NEWEST_DAYS,
    oldest: int = OLDEST_DAYS,
    partition_columns: Sequence[str] = ("date_id",),
    slack_days: int | None = 1,
) -> str | None:
    """Move the oldest day of a partitioned hot table to Parquet; returns the day.

    The hot rows of the day are read once: count and checksum are taken while they are written.
    Cold rows replace their partition, are read back and must give the same count and
    checksum, and only then the hot partition goes. A run that stops anywhere can be repeated.
    """
    hot = spark.table(table)
    day = oldest_day(hot, today, newest, oldest, slack_days=slack_days).first()["date_id"]
    if day is None:
        return None
    sent = Observation()
    write_cold(hot.filter(F.col("date_id") == day).observe(sent, *_content(hot.columns)), cold_path, partition_columns)
    cold = spark.read.schema(hot.schema).parquet(cold_path).filter(F.col("date_id") == day)
    arrived = cold.agg(*_content(hot.columns)).first().asDict()
    if arrived != sent.get:
        raise RuntimeError(f"{table} {day}: {arrived} arrived in {cold_path}, not {sent.get}")
    drop_partitions(spark, table, [day])
    return day


def within_retention(df: DataFrame, today: Day, days: int, moment: str = "ropendtime") -> DataFrame:
    """Rows not older than the retention period."""
    return df.filter(F.col(moment) >= F.date_sub(day_column(today), days))


def beyond_retention(df: DataFrame, today: Day, days: int, moment: str = "ropendtime") -> DataFrame:
    """Rows a purge removes."""
    return df.filter(F.col(moment) < F.date_sub(day_column(today), days))


def archive_backlog(backlog: DataFrame, today: Day, days: int = 3) -> tuple[DataFrame, DataFrame]:
    """(archived, kept) backlog rows by age; archived ones get a ``received_day`` to partition by."""
    old = F.col("received_date") < F.date_sub(day_column(today), days)
    archived = backlog.filter(old).withColumn("received_day", F.to_date("received_date"))
    return archived, backlog.filter(~F.coalesce(old, F.lit(False)))
