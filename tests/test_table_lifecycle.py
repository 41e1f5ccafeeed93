from __future__ import annotations

import uuid

import pytest

from countermill.operators import partitions
from countermill.sinks.stores import write_cold
from tests.helpers import rows

SCHEMA = "v BIGINT, date_id STRING, hour_id STRING"


@pytest.fixture()
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    location = str(tmp_path / "store")
    frame = spark.createDataFrame([(1, "20240101", "00"), (2, "20240101", "05"), (3, "20240102", "00")], SCHEMA)
    write_cold(frame, location, ["date_id", "hour_id"])
    partitions.create_external_table(spark, name, frame.schema, ["date_id", "hour_id"], location)
    yield name, location
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_new_table_knows_no_partition(spark, table):
    name, location = table
    assert partitions.table_location(spark, name).endswith(location)
    assert {r.state for r in partitions.partition_drift(spark, name).collect()} == {"unlisted"}
    assert spark.table(name).count() == 0


def test_folders_are_recovered_and_dropped_partitions_keep_their_files(spark, table):
    name, location = table
    unlisted = partitions.partition_drift(spark, name).filter("state = 'unlisted'")
    assert partitions.recover_partitions(spark, name, unlisted, batch=2) == 3
    assert partitions.recover_partitions(spark, name, partitions.partition_drift(spark, name).filter("state = 'unlisted'")) == 0
    assert sorted(r.v for r in spark.table(name).collect()) == [1, 2, 3]
    assert partitions.purge_expired(spark, name, "2024-01-05", 3) == 2
    assert rows(partitions.partition_drift(spark, name)) == [
        ("date_id=20240101/hour_id=00", "unlisted"),
        ("date_id=20240101/hour_id=05", "unlisted"),
        ("date_id=20240102/hour_id=00", "listed"),
    ]
    assert [r.v for r in spark.table(name).collect()] == [3]
    assert spark.read.parquet(location).count() == 3


def test_calendar_partitions_are_empty_until_files_come(spark, table):
    name, location = table
    calendar = partitions.partition_calendar(spark.sql("SELECT DATE '2024-01-02' AS day"), 2)
    assert partitions.add_partitions(spark, name, calendar) == 24
    states = dict(rows(partitions.partition_drift(spark, name)))
    assert states["date_id=20240103/hour_id=07"] == "empty"
    more = spark.createDataFrame([(9, "20240103", "07")], SCHEMA)
    write_cold(more, location, ["date_id", "hour_id"], append=True)
    partitions.refresh_days(spark, name)
    assert dict(rows(partitions.partition_drift(spark, name)))["date_id=20240103/hour_id=07"] == "listed"
    assert [r.v for r in spark.table(name).filter("date_id = '20240103'").collect()] == [9]
