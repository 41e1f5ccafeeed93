"""Multi-line application log records.

Lines are (source_file, block, pos, line) as :mod:`countermill.sources.logs`
reads them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countermill.functions.times import is_date
from countermill.operators.ordering import carry_forward


def is_header(line: str = "line") -> Column:
    """A line opens a record when its first word is a valid date."""
    return is_date(F.substring_index(F.col(line), " ", 1))


def with_record(lines: DataFrame, header: Column | None = None, group: Sequence[str] = ("source_file",)) -> DataFrame:
    """Add ``record``: ``pos`` of the header a line belongs to, NULL before the first one."""
    opens = is_header() if header is None else header
    return carry_forward(lines, F.when(opens, F.col("pos")), "record", group)


def orphan_lines(lines: DataFrame, group: Sequence[str] = ("source_file",)) -> DataFrame:
    """Lines before the first header of their file: part of no record."""
    return with_record(lines, group=group).filter(F.col("record").isNull()).drop("record")


def record_text(
    lines: DataFrame, header: Column | None = None, group: Sequence[str] = ("source_file",), separator: str = "\n"
) -> DataFrame:
    """One row per record with its lines joined in order."""
    belonging = with_record(lines, header, group).filter(F.col("record").isNotNull())
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda part: part["line"])
    return belonging.groupBy(*group, "record").agg(F.array_join(ordered, separator).alias("text"))


def stitch_log_records(lines: DataFrame, group: Sequence[str] = ("source_file",)) -> DataFrame:
    """Records as (datetime, thread, log_level, classname, logmessage).

    Words 0 and 1 are date and time, then thread, level and class; word 5 is a
    separator and dropped, the rest is the message including continuation lines.
    """
    words = record_text(lines, group=group).withColumn("words", F.split("text", " "))
    word = lambda i: F.get("words", F.lit(i))
    return words.select(
        *group,
        "record",
        F.concat_ws(" ", word(0), word(1)).alias("datetime"),
        word(2).alias("thread"),
        word(3).alias("log_level"),
        word(4).alias("classname"),
        F.array_join(F.slice("words", 7, F.size("words")), " ").alias("logmessage"),
    )
