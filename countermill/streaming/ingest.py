"""Counter files as a stream: each file once, bounded batches, several sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from countermill.operators.entities import EntitySpec, write_entities
from countermill.operators.files import DROPPED, PARSED
from countermill.sinks.stores import write_cold
from countermill.sources.counter_files import parsed_files, unreadable_files
from countermill.streaming.file_log import batch_files

# Files arrive once per result period.
ROP = "15 minutes"

# Files a batch may add to one folder of the long table.
FILES_PER_FOLDER = 16

Handler = Callable[[DataFrame, int], None]


def start_ingest(records: DataFrame, handle: Handler, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` over a stream of records.

    The checkpoint remembers which files were taken; ``available_now`` works off
    what is there, in batches, and stops.
    """
    writer = records.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=ROP)
    return writer.start()


def start_long_sink(
    records: DataFrame,
    flatten: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    available_now: bool = True,
    spread: int = FILES_PER_FOLDER,
) -> StreamingQuery:
    """Stream long rows into Parquet below ``measurement=../date_id=..``.

    The file sink's own log makes every row appear exactly once, so this needs
    no batch column; use it where the long table is the only sink. A batch puts
    at most ``spread`` files into a folder and spreads a big class over as many
    tasks.
    """
    slice_of = F.pmod(F.xxhash64("moid"), F.lit(spread))
    rows = flatten(records)
    writer = (
        rows.repartition(F.col("measurement"), F.col("date_id"), slice_of)
        .writeStream.format("parquet")
        .partitionBy("measurement", "date_id")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=ROP)
    return writer.start()


def long_writer(
    flatten: Callable[[DataFrame], DataFrame],
    long_path: str,
    status_path: str | None = None,
    checkpoint: str | None = None,
) -> Handler:
    """Handler that writes long rows, and the state of every file of the batch.

    With the ``checkpoint`` of its stream, files without any record, empty or of another
    format, get a state too; records alone cannot tell of them.

    Rows go below ``batch_id=<n>/measurement=../date_id=..``, replacing what an
    earlier try of the same batch left there, so a repeated batch adds nothing.
    ``batch_id`` keeps the sinks of one batch together; readers that only want
    the rows ignore it.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        shared = status_path is not None
        records = batch.persist(StorageLevel.MEMORY_AND_DISK) if shared else batch
        try:
            rows = flatten(records).withColumn("batch_id", F.lit(batch_id))
            clustered = rows.hint("rebalance", "measurement", "date_id")
            write_cold(clustered, long_path, ["batch_id", "measurement", "date_id"])
            if shared:
                files = batch_files(batch.sparkSession, checkpoint, batch_id) if checkpoint else None
                states = file_states(records, files).withColumn("batch_id", F.lit(batch_id))
                write_cold(states, status_path, ["batch_id"])
        finally:
            if shared:
                records.unpersist()

    return handle


def entity_writer(
    flatten: Callable[[DataFrame], DataFrame],
    specs: Sequence[EntitySpec],
    write: Callable[[str, int, DataFrame], None],
) -> Handler:
    """Handler that writes every entity of a batch with ``write(name, batch_id, wide rows)``.

    A batch may be repeated after a failure: ``write`` gets its number, so that
    it can replace what the first try left.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_entities(flatten(batch), specs, lambda name, df: write(name, batch_id, df))

    return handle


def file_states(records: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """(path, status) of the files of a batch: Dropped when any record was unreadable.

    ``files`` (path) lists what the batch was given; a file of it without any
    record, empty or of another format, is Dropped too.
    """
    bad = unreadable_files(records).select("path", F.lit(1).alias("bad"))
    good = parsed_files(records).select("path", F.lit(0).alias("bad"))
    found = good.unionByName(bad)
    if files is not None:
        found = found.unionByName(files.select("path", F.lit(None).cast("int").alias("bad")))
    states = found.groupBy("path").agg(F.coalesce(F.max("bad"), F.lit(1)).alias("bad"))
    return states.select("path", F.when(F.col("bad") == 1, DROPPED).otherwise(PARSED).alias("status"))
