"""Log text as ordered lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def scan_log_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with their order: (source_file, block, pos, line).

    A big file is read split by split: ``block`` is the byte offset of the split
    and ``pos`` that offset plus the line's number inside the split. A split has
    no more lines than bytes, so ``pos`` orders the lines of the whole file, and
    no task ever holds more than one split.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("read_order"),
        F.col("value").alias("line"),
    )
    in_split = W.partitionBy("source_file", "block").orderBy("read_order")
    return lines.withColumn("pos", F.col("block") + F.row_number().over(in_split)).select(
        "source_file", "block", "pos", "line"
    )


def scan_numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with their number in the whole file, from 1: (source_file, block, pos, line).

    Files are read in splits. The lines of each split are counted first, in a pass that keeps
    no text; a prefix sum over the splits of a file says how many lines come before each, and a
    line's number is that sum plus its place in the split. Only split counts are shuffled,
    one row for each split of a file; lines stay where they are read.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Rows of one split follow each other in their partition, so ids grow by 1 there.
        F.monotonically_increasing_id().alias("read_order"),
        F.col("value").alias("line"),
    )
    splits = lines.groupBy("source_file", "block").agg(
        F.min("read_order").alias("first_read"), F.count(F.lit(1)).alias("lines")
    )
    earlier = W.partitionBy("source_file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    places = splits.select(
        "source_file", "block", (F.coalesce(F.sum("lines").over(earlier), F.lit(0)) - F.col("first_read") + 1).alias("shift")
    )
    return lines.join(places, ["source_file", "block"]).select(
        "source_file", "block", (F.col("read_order") + F.col("shift")).alias("pos"), "line"
    )
