"""Several sinks of one micro-batch that become visible together.

Each sink writes a batch into a folder of its own, ``root/<sink>/batch_id=<n>``, replacing what an
earlier try left there. When all have written, one row for each sink is appended to
``root/committed``, in one file, which appears whole or not at all. :func:`committed` reads only
batches named there, so a batch that stopped between two sinks is seen in none of them, and a
batch that comes again after its commit is passed over.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from countermill.streaming.file_log import batch_files
from countermill.streaming.ingest import Handler, start_ingest

COMMITTED = "committed"
COMMIT_ROWS = "batch_id BIGINT, sink STRING, rows BIGINT"


@dataclass(frozen=True)
class Sink:
    """What one sink takes from a batch: ``rows(records, files)``, and its partition columns.

    ``files`` has the ``path`` of every file the batch was given, those without any record too.
    """

    rows: Callable[[DataFrame, DataFrame], DataFrame]
    partition_columns: Sequence[str] = ()


def commits(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, sink, rows) of all batches that every sink has written."""
    return spark.read.schema(COMMIT_ROWS).parquet(f"{root}/{COMMITTED}")


def committed(spark: SparkSession, root: str, sink: str, schema: str) -> DataFrame:
    """Rows of a sink with their ``batch_id``, of committed batches alone.

    ``schema`` names the columns of the sink. The folders of other batches are pruned where
    Spark finds the list of batches small.
    """
    rows = spark.read.schema(f"{schema}, batch_id BIGINT").parquet(f"{root}/{sink}")
    return rows.join(commits(spark, root).select("batch_id").distinct(), "batch_id", "left_semi")


def fan_out(spark: SparkSession, sinks: Mapping[str, Sink], root: str, checkpoint: str) -> Handler:
    """Handler that writes each batch to all sinks and then commits it once.

    The batch is persisted for its sinks.
    """
    spark.createDataFrame([], COMMIT_ROWS).write.mode("ignore").parquet(f"{root}/{COMMITTED}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not commits(spark, root).filter(F.col("batch_id") == batch_id).isEmpty():
            return
        files = batch_files(spark, checkpoint, batch_id)
        records = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            written = [(batch_id, name, _write(sink.rows(records, files), sink, f"{root}/{name}/batch_id={batch_id}")) for name, sink in sinks.items()]
        finally:
            records.unpersist()
        spark.createDataFrame(written, COMMIT_ROWS).coalesce(1).write.mode("append").parquet(f"{root}/{COMMITTED}")

    return handle


def _write(rows: DataFrame, sink: Sink, path: str) -> int:
    """Replace the whole folder of a batch, so that nothing stays of an earlier try, not even a
    partition the new one lacks; the number of rows found there, from the footers of its files."""
    clustered = rows.hint("rebalance", *sink.partition_columns) if sink.partition_columns else rows
    writer = clustered.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*sink.partition_columns).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).count()


def start_fan_out(
    records: DataFrame, sinks: Mapping[str, Sink], root: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Run a file stream of records into all sinks, see :func:`fan_out`."""
    return start_ingest(records, fan_out(records.sparkSession, sinks, root, checkpoint), checkpoint, available_now)
