"""File backlog: which files are new, waiting, parsed or lost.

A backlog row is (path, status, received_date, processed_date); a NULL status
means waiting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countermill.functions.columns import ColumnLike, as_column

# Final states of a file.
PARSED, DROPPED, FAILED = "Parsed", "Dropped", "Failed"


def waiting_files(backlog: DataFrame) -> DataFrame:
    """Paths not processed yet, each once."""
    return backlog.filter(F.col("status").isNull()).select("path").distinct()


def processed_files(backlog: DataFrame) -> DataFrame:
    """Paths processed before, each once."""
    return backlog.filter(F.col("status").isNotNull()).select("path").distinct()


def file_states(listing: DataFrame, backlog: DataFrame) -> DataFrame:
    """(path, listed, processed, waiting) over both inputs.

    One aggregation by path answers what three anti joins would, in one shuffle
    that combines repeated paths first.
    """
    no, yes = F.lit(False), F.lit(True)
    listed = listing.select("path", yes.alias("listed"), no.alias("processed"), no.alias("waiting"))
    known = backlog.select(
        "path",
        no.alias("listed"),
        F.col("status").isNotNull().alias("processed"),
        F.col("status").isNull().alias("waiting"),
    )
    flags = [F.max(c).alias(c) for c in ("listed", "processed", "waiting")]
    return listed.unionByName(known).groupBy("path").agg(*flags)


def reconcile(listing: DataFrame, backlog: DataFrame) -> DataFrame:
    """(path, outcome) with outcome ``new`` or ``failed``; other files do not show.

    A file is new when listed, never processed and not waiting; it failed when
    waiting but no longer listed, or waiting although processed before.
    """
    usable = F.col("listed") & ~F.col("processed")
    outcome = F.when(usable & ~F.col("waiting"), "new").when(F.col("waiting") & ~usable, "failed")
    return file_states(listing, backlog).select("path", outcome.alias("outcome")).filter(F.col("outcome").isNotNull())


def reconcile_files(listing: DataFrame, backlog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new, failed) paths of :func:`reconcile`."""
    outcomes = reconcile(listing, backlog)
    return (
        outcomes.filter(F.col("outcome") == "new").select("path"),
        outcomes.filter(F.col("outcome") == "failed").select("path"),
    )


def register_files(backlog: DataFrame, listing: DataFrame, at: ColumnLike) -> DataFrame:
    """Next backlog after a listing: new files wait, vanished ones are Failed."""
    at = as_column(at).cast("timestamp")
    outcomes = reconcile(listing, backlog)
    failed = outcomes.filter(F.col("outcome") == "failed").select("path", F.lit(True).alias("_failed"))
    lost = F.col("status").isNull() & F.col("_failed")
    kept = backlog.join(failed, "path", "left").select(
        "path",
        F.when(lost, F.lit(FAILED)).otherwise(F.col("status")).alias("status"),
        "received_date",
        F.when(lost, at).otherwise(F.col("processed_date")).alias("processed_date"),
    )
    new = outcomes.filter(F.col("outcome") == "new").select(
        "path",
        F.lit(None).cast("string").alias("status"),
        at.alias("received_date"),
        F.lit(None).cast("timestamp").alias("processed_date"),
    )
    return kept.unionByName(new)


def close_batch(
    backlog: DataFrame,
    requested: DataFrame,
    parsed: DataFrame,
    at: ColumnLike,
    failed: DataFrame | None = None,
) -> DataFrame:
    """Next backlog after a batch: parsed files are Parsed, the other requested ones Dropped.

    Files in ``failed`` become Failed. Only waiting rows change.
    """
    parts = [
        requested.select("path", F.lit(1).alias("_rank")),
        parsed.select("path", F.lit(2).alias("_rank")),
    ]
    if failed is not None:
        parts.append(failed.select("path", F.lit(3).alias("_rank")))
    marks = parts[0]
    for part in parts[1:]:
        marks = marks.unionByName(part)
    # A parsed file that was not requested is no part of this batch.
    ranks = (
        marks.groupBy("path")
        .agg(F.max("_rank").alias("_rank"), F.max(F.col("_rank").isin(1, 3)).alias("_asked"))
        .filter("_asked")
        .drop("_asked")
    )
    status = F.when(F.col("_rank") == 2, PARSED).when(F.col("_rank") == 3, FAILED).otherwise(DROPPED)
    return apply_states(backlog, ranks.select("path", status.alias("status")), at)


def apply_states(backlog: DataFrame, states: DataFrame, at: ColumnLike) -> DataFrame:
    """Next backlog after ``states``, one (path, status) per file: waiting rows take their status."""
    at = as_column(at)
    final = states.select("path", F.col("status").alias("_status"))
    changes = F.col("status").isNull() & F.col("_status").isNotNull()
    return backlog.join(final, "path", "left").select(
        "path",
        F.when(changes, F.col("_status")).otherwise(F.col("status")).alias("status"),
        "received_date",
        F.when(changes, at).otherwise(F.col("processed_date")).alias("processed_date"),
    )
