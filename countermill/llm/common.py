"""What the operators share: table columns, scratch tables, bounded broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir``.

    Unset on a local master, one is made and set; elsewhere that is an error, as a
    machine-local folder would hold only part of each table.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="countermill-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return os.path.join(folder, spark.sparkContext.applicationId)


def cut(frame: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps neither
    recompute it nor depend on the executors that made it."""
    path = os.path.join(scratch_dir(frame.sparkSession), uuid.uuid4().hex)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def small_side(frame: DataFrame, rows: int, most: int) -> DataFrame:
    """Broadcast hint when the counted rows stay under a bound; else Spark shuffles."""
    return F.broadcast(frame) if rows <= most else frame


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Place of an installed public tokenizer file, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)
