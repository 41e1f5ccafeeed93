"""Shared argument handling of the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = str | Column


def as_column(value: ColumnLike) -> Column:
    """A column from a name or a Column."""
    return F.col(value) if isinstance(value, str) else value
