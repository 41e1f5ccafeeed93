from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

from countermill.session import configure


def new_session() -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("countermill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="countermill-warehouse-"))
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return new_session()
