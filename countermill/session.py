"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# UTC: local_timestamp is a label, not an instant, and date_format() must not
# depend on where the driver runs. The rest leaves sizing to AQE.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Rows up to which a checkpointed side of a join is broadcast.
BROADCAST_ROWS = 200_000


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the recommended settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    Where that is unset a temporary one is made on a local master (unit tests);
    on a cluster it would hold only part of what is written, so that fails.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="countermill-shared-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder, so lost executors cost no lineage."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a checkpointed side of a join, with a broadcast hint where its counted rows stay under a
    bound; Spark knows no size of a checkpoint and would shuffle the other side."""
    return F.broadcast(df) if df.count() <= most else df
