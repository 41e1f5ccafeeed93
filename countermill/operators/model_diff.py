"""Differences between two model snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds of change.
ADDED, REMOVED, CHANGED, UNCHANGED = "added", "removed", "changed", "unchanged"


def model_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Keys of both snapshots with old and new value and the kind of change.

    Values compare NULL-safe and keys match NULL to NULL, as dictionary entries
    do. Both sides are aggregated together: one shuffle, no join. A key that a
    snapshot repeats fails the query, as it has no one value.
    """
    no, yes = F.lit(False), F.lit(True)
    missing = F.lit(None).cast(old.schema[value].dataType)
    left = old.select(*keys, F.col(value).alias("old"), missing.alias("new"), yes.alias("in_old"), no.alias("in_new"))
    right = new.select(*keys, missing.alias("old"), F.col(value).alias("new"), no.alias("in_old"), yes.alias("in_new"))
    both = left.unionByName(right).groupBy(*keys).agg(
        F.max("old").alias("old"),
        F.max("new").alias("new"),
        F.max("in_old").alias("in_old"),
        F.max("in_new").alias("in_new"),
        F.greatest(F.count_if("in_old"), F.count_if("in_new")).alias("_repeats"),
    )
    both = both.filter(F.assert_true(F.col("_repeats") <= 1, "a snapshot repeats a key").isNull())
    change = (
        F.when(~F.col("in_old"), ADDED)
        .when(~F.col("in_new"), REMOVED)
        .when(F.col("old").eqNullSafe(F.col("new")), UNCHANGED)
        .otherwise(CHANGED)
    )
    return both.select(*keys, F.col("old").alias("old_value"), F.col("new").alias("new_value"), change.alias("change_type"))


def common_keys(diff: DataFrame) -> DataFrame:
    """Keys present in both snapshots."""
    return diff.filter(F.col("change_type").isin(CHANGED, UNCHANGED))
