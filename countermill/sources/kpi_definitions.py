"""KPI definition documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countermill.schemas import KPI_DOCUMENT


def scan_kpi_definitions(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per definition: source, name, alias, expression, type, period, elements."""
    documents = spark.read.schema(KPI_DOCUMENT).json(paths if isinstance(paths, str) else list(paths), multiLine=True)
    return documents.select("source", F.explode("kpi_definitions").alias("d")).select("source", "d.*")
