"""Column functions on period end times, dates and durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from countermill.functions.columns import ColumnLike, as_column

Day = str | dt.date | Column


def day_column(day: Day) -> Column:
    """A DATE column from a date, an ISO text or a Column."""
    return day if isinstance(day, Column) else F.to_date(F.lit(str(day)))


def rop_instant(mts: ColumnLike) -> Column:
    """True instant of ``yyyyMMddHHmmss`` plus offset; NULL when unreadable."""
    return F.try_to_timestamp(as_column(mts), F.lit("yyyyMMddHHmmssX"))


def rop_wall_clock(mts: ColumnLike) -> Column:
    """The written wall-clock digits read as UTC, whatever the offset says."""
    digits = F.substring(as_column(mts), 1, 14)
    return F.try_to_timestamp(F.concat(digits, F.lit("Z")), F.lit("yyyyMMddHHmmssX"))


def iso_instant(text: ColumnLike) -> Column:
    """Instant of an ISO date-time; one without offset counts as UTC."""
    return as_column(text).try_cast("timestamp")


def iso_wall_clock(text: ColumnLike) -> Column:
    """Wall-clock digits of an ISO date-time read as UTC, offset ignored."""
    return F.replace(F.substring(as_column(text), 1, 19), F.lit("T"), F.lit(" ")).try_cast("timestamp")


def date_id_of_text(mts: ColumnLike) -> Column:
    """``yyyyMMdd`` of the node's own day: the first eight characters."""
    return F.substring(as_column(mts), 1, 8)


def date_id(day: ColumnLike) -> Column:
    """``yyyyMMdd`` of a date or timestamp column."""
    return F.date_format(as_column(day), "yyyyMMdd")


def duration_seconds(text: ColumnLike) -> Column:
    """Digits of an ISO seconds duration as text: ``PT86400S`` gives ``86400``."""
    return F.nullif(F.regexp_extract(as_column(text), r"^PT(\d+)S$", 1), F.lit(""))


def is_date(text: ColumnLike) -> Column:
    """True when the text is a valid ``yyyy-MM-dd`` date."""
    text = as_column(text)
    return F.coalesce(
        text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & F.try_to_date(text, "yyyy-M-d").isNotNull(), F.lit(False)
    )


def between_days_ago(moment: ColumnLike, today: Day, newest: int, oldest: int) -> Column:
    """``moment`` within [today - oldest, today - newest], both midnights included."""
    day = day_column(today)
    return as_column(moment).between(F.date_sub(day, oldest), F.date_sub(day, newest))


def period_start(moment: ColumnLike, minutes: int) -> Column:
    """Start of the fixed period (counted from the epoch) that ``moment`` lies in."""
    seconds = minutes * 60
    epoch = F.unix_seconds(as_column(moment).cast("timestamp"))
    return F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(seconds)))
