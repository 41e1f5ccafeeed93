"""Partition calendar, expiry, and the table statements they lead to."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countermill.functions.times import Day, date_id, day_column
from countermill.sources.counter_files import found_files

# Partition columns by level.
PARTITION_LEVELS = ["date_id", "hour_id", "rop_id"]


def partition_calendar(days: DataFrame, levels: int = 1, day: str = "day") -> DataFrame:
    """Partitions of the day after each input day: 1, 24 or 96 rows by level.

    Columns date_id (``yyyyMMdd``), then hour_id (00-23), then rop_id (the
    minute a quarter hour starts: 00, 15, 30, 45).
    """
    calendar = days.select(date_id(F.date_add(F.to_date(day), 1)).alias("date_id")).distinct()
    two_digits = lambda c: F.lpad(c.cast("string"), 2, "0")
    if levels >= 2:
        calendar = calendar.select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
        calendar = calendar.select("date_id", two_digits(F.col("hour")).alias("hour_id"))
    if levels >= 3:
        calendar = calendar.select("*", F.explode(F.sequence(F.lit(0), F.lit(45), F.lit(15))).alias("minute"))
        calendar = calendar.select("date_id", "hour_id", two_digits(F.col("minute")).alias("rop_id"))
    return calendar


def partition_locations(calendar: DataFrame, root: str) -> DataFrame:
    """Add the folder of each partition: ``root/date_id=../hour_id=../rop_id=..``."""
    levels = [c for c in PARTITION_LEVELS if c in calendar.columns]
    parts = [F.concat(F.lit(f"{c}="), F.col(c)) for c in levels]
    return calendar.withColumn("location", F.concat_ws("/", F.lit(root.rstrip("/")), *parts))


def expired_partitions(partitions: DataFrame, today: Day, retention_days: int, location: str = "location") -> DataFrame:
    """Partitions whose ``date_id=`` lies strictly before today minus the retention."""
    text = F.regexp_extract(location, r"(?:^|/)date_id=(\d+)", 1)
    dated = partitions.withColumn("date_id", F.nullif(text, F.lit("")))
    return dated.filter(F.try_to_date("date_id", "yyyyMMdd") < F.date_sub(day_column(today), retention_days))


def table_partitions(spark: SparkSession, table: str) -> DataFrame:
    """``SHOW PARTITIONS`` as (location)."""
    return spark.sql(f"SHOW PARTITIONS {table}").withColumnRenamed("partition", "location")


def create_external_table(
    spark: SparkSession, table: str, schema: T.StructType, partition_columns: Sequence[str], location: str
) -> None:
    """External partitioned Parquet table over ``location``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(f"`{c}`" for c in partition_columns)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({keys}) LOCATION '{location}'")


def _spec(values: dict[str, str]) -> str:
    return ", ".join(f"{column}='{value}'" for column, value in values.items())


def table_location(spark: SparkSession, table: str) -> str:
    """Folder of a table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def partition_drift(spark: SparkSession, table: str) -> DataFrame:
    """(location, state) of a table's partitions and of the partition folders below it.

    ``listed``: the catalog has it and it holds files; ``empty``: the catalog has it, no file
    does; ``unlisted``: a folder with files that the catalog does not know, as another job moved
    it in or its partition was dropped. Only the names of files are read.
    """
    folder = F.regexp_extract("path", r"((?:[^/=]+=[^/]*/)+)[^/]+$", 1)
    found = found_files(spark, table_location(spark, table)).select(F.url_decode(F.rtrim(folder, F.lit("/"))).alias("location"))
    known = table_partitions(spark, table).select("location", F.lit(True).alias("known"), F.lit(False).alias("held"))
    held = found.filter("location != ''").select("location", F.lit(False).alias("known"), F.lit(True).alias("held"))
    both = known.unionByName(held).groupBy("location").agg(F.max("known").alias("known"), F.max("held").alias("held"))
    state = F.when(~F.col("held"), "empty").when(F.col("known"), "listed").otherwise("unlisted")
    return both.select("location", state.alias("state"))


def recover_partitions(spark: SparkSession, table: str, locations: DataFrame, batch: int = 500) -> int:
    """Add the partitions named by ``location`` (``date_id=../hour_id=..``); returns their number.

    ``locations`` is catalog metadata, such as the unlisted folders of a few days.
    """
    specs = [f"PARTITION ({_spec(dict(part.split('=', 1) for part in row['location'].split('/')))})" for row in locations.collect()]
    for start in range(0, len(specs), batch):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs[start : start + batch])}")
    return len(specs)


def add_partitions(spark: SparkSession, table: str, calendar: DataFrame) -> int:
    """Add the calendar's partitions to a table, in one statement; returns their number.

    A calendar covers one day of one table: at most 96 rows reach the driver.
    """
    levels = [c for c in PARTITION_LEVELS if c in calendar.columns]
    has_location = "location" in calendar.columns
    clauses = []
    for row in calendar.collect():
        clause = f"PARTITION ({_spec({c: row[c] for c in levels})})"
        clauses.append(f"{clause} LOCATION '{row['location']}'" if has_location else clause)
    if clauses:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(clauses)}")
    return len(clauses)


def drop_partitions(spark: SparkSession, table: str, date_ids: Iterable[str], batch: int = 500) -> int:
    """Drop all partitions of the given days of a table; returns their number.

    Partitions are named in full, hours and quarter hours included: not every
    catalog takes a day alone. The list is catalog metadata, 96 entries a day.
    """
    days = list(date_ids)
    if not days:
        return 0
    day = F.regexp_extract("location", r"(?:^|/)date_id=([^/]+)", 1)
    chosen = table_partitions(spark, table).filter(day.isin(days))
    specs = [f"PARTITION ({_spec(dict(part.split('=', 1) for part in row['location'].split('/')))})" for row in chosen.collect()]
    for start in range(0, len(specs), batch):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs[start : start + batch])} PURGE")
    return len(specs)


def purge_expired(spark: SparkSession, table: str, today: Day, retention_days: int) -> int:
    """Drop all partitions of every expired day of a table; returns their number."""
    expired = expired_partitions(table_partitions(spark, table), today, retention_days)
    days = [row["date_id"] for row in expired.select("date_id").distinct().collect()]
    return drop_partitions(spark, table, days)


def refresh_days(spark: SparkSession, table: str) -> None:
    """Let a table see files that another job moved in."""
    spark.sql(f"REFRESH TABLE {table}")
