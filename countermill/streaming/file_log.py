"""Which files a batch of a file stream was given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countermill.sources.counter_files import scan_path


def _log_offset(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Last entry of the file log that a batch took; -1 before the first batch."""
    if batch_id < 0:
        return -1
    lines = spark.read.text(f"{checkpoint}/offsets/{batch_id}")
    offset = F.get_json_object("value", "$.logOffset").cast("bigint")
    return lines.agg(F.max(offset)).first()[0]


def batch_files(spark: SparkSession, checkpoint: str, batch_id: int) -> DataFrame:
    """``path`` of every file that a batch of a file stream was given, from the stream's checkpoint.

    Names empty files and files of another format too, of which no record tells.
    """
    first, last = (_log_offset(spark, checkpoint, n) for n in (batch_id - 1, batch_id))
    entries = spark.read.schema("path STRING, batchId BIGINT").json(f"{checkpoint}/sources/0")
    return entries.filter((F.col("batchId") > first) & (F.col("batchId") <= last)).select(scan_path("path").alias("path")).distinct()
