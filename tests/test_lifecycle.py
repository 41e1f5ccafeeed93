from __future__ import annotations

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from countermill.operators import ageing, files, partitions
from countermill.sinks import stores as sinks
from countermill.sources import stores as sources
from tests.helpers import dicts, rows


def backlog(spark, *entries):
    return spark.createDataFrame(
        [(path, status, dt.datetime(2024, 1, day), None) for path, status, day in entries],
        "path string, status string, received_date timestamp, processed_date timestamp",
    )


def paths(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


def test_reconcile(spark):
    known = backlog(spark, ("a", "Parsed", 1), ("b", None, 1), ("d", None, 1))
    new, failed = files.reconcile_files(paths(spark, "a", "b", "c", "c"), known)
    assert (rows(new), rows(failed)) == ([("c",)], [("d",)])


def test_waiting_file_that_was_processed_fails(spark):
    known = backlog(spark, ("b", None, 1), ("b", "Parsed", 1))
    new, failed = files.reconcile_files(paths(spark, "b"), known)
    assert (rows(new), rows(failed)) == ([], [("b",)])


def test_register_is_idempotent(spark):
    known = backlog(spark, ("a", "Parsed", 1), ("b", None, 1), ("d", None, 1))
    listing = paths(spark, "a", "b", "c")
    once = files.register_files(known, listing, F.lit("2024-01-05"))
    twice = files.register_files(once, listing, F.lit("2024-01-06"))
    assert rows(once) == rows(twice)
    assert {r["path"]: r["status"] for r in dicts(once)} == {"a": "Parsed", "b": None, "c": None, "d": "Failed"}


def test_close_batch(spark):
    known = backlog(spark, ("a", None, 1), ("b", None, 1), ("c", None, 1), ("d", "Parsed", 1), ("e", None, 1))
    asked, parsed, failed = paths(spark, "a", "b", "d", "e"), paths(spark, "a", "c"), paths(spark, "e")
    after = {r["path"]: r for r in dicts(files.close_batch(known, asked, parsed, F.lit(dt.datetime(2024, 1, 9)), failed))}
    # c was parsed but not asked for; d was closed before.
    assert {p: r["status"] for p, r in after.items()} == {
        "a": "Parsed", "b": "Dropped", "c": None, "d": "Parsed", "e": "Failed",
    }
    assert after["a"]["processed_date"] == dt.datetime(2024, 1, 9)
    assert after["c"]["processed_date"] is None and after["d"]["processed_date"] is None


def test_old_backlog(spark):
    known = backlog(spark, ("a", "Parsed", 1), ("b", None, 7), ("c", None, 8))
    assert rows(sources.backlog_older_than(known, "2024-01-10").select("path")) == [("a",)]
    archived, kept = ageing.archive_backlog(known, "2024-01-10")
    assert rows(archived.select("path", "received_day")) == [("a", dt.date(2024, 1, 1))]
    assert rows(kept.select("path")) == [("b",), ("c",)]


def hot(spark):
    data = [(f"202401{d:02}", dt.datetime(2024, 1, d, h), f"n{i}") for d in (4, 5, 6, 7, 8) for i, h in enumerate((0, 12))]
    data.append(("20240105", dt.datetime(2024, 1, 9), "late"))
    return spark.createDataFrame(data, "date_id string, ropendtime timestamp, nedn string")


def test_age_out_moves_the_oldest_day_whole(spark):
    archived, remaining = ageing.age_out(hot(spark), "2024-01-10")
    assert {r["date_id"] for r in dicts(archived)} == {"20240105"}
    assert archived.count() == 3
    assert rows(archived.unionAll(remaining)) == rows(hot(spark))


def test_age_out_with_nothing_in_the_window(spark):
    archived, remaining = ageing.age_out(hot(spark), "2025-01-01")
    assert archived.count() == 0
    assert rows(remaining) == rows(hot(spark))


def test_window_includes_both_midnights(spark):
    inside = ageing.ageing_window(hot(spark), "2024-01-10")
    assert rows(inside.select("date_id").distinct()) == [("20240105",), ("20240106",), ("20240107",)]
    # Only midnight of the newest day is inside.
    assert inside.filter("date_id = '20240107'").count() == 1


def test_archive_oldest_moves_partitions_and_can_be_repeated(spark, tmp_path):
    table, cold = f"hot_{uuid.uuid4().hex[:8]}", str(tmp_path / "cold")
    hot(spark).write.partitionBy("date_id").saveAsTable(table)
    before = rows(spark.table(table).select("date_id", "nedn"))
    day = spark.table(table).filter("date_id = '20240105'")
    sinks.write_cold(day, cold)  # a run that stopped after writing
    assert ageing.archive_oldest(spark, table, cold, "2024-01-10") == "20240105"
    assert ageing.archive_oldest(spark, table, cold, "2024-01-10") == "20240106"
    moved = spark.read.schema("ropendtime timestamp, nedn string, date_id string").parquet(cold)
    left = spark.table(table)
    assert rows(moved.select("date_id", "nedn").unionAll(left.select("date_id", "nedn"))) == before
    assert ageing.archive_oldest(spark, table, cold, "2025-01-10") is None


def test_a_day_that_arrives_changed_is_not_dropped(spark, tmp_path, monkeypatch):
    table, cold = f"hot_{uuid.uuid4().hex[:8]}", str(tmp_path / "cold")
    hot(spark).write.partitionBy("date_id").saveAsTable(table)
    write = sinks.write_cold

    def spoiled(df, path, columns):
        write(df, path, columns)
        kept = spark.read.schema(df.schema).parquet(path).withColumn("nedn", F.concat("nedn", F.lit("!")))
        write(spark.createDataFrame(kept.collect(), kept.schema).select(*df.columns), path, columns)

    monkeypatch.setattr(ageing, "write_cold", spoiled)
    with pytest.raises(RuntimeError, match="20240105"):
        ageing.archive_oldest(spark, table, cold, "2024-01-10")
    assert spark.table(table).filter("date_id = '20240105'").count() == 3


def test_the_day_search_reads_only_folders_near_the_window(spark):
    table = f"hot_{uuid.uuid4().hex[:8]}"
    hot(spark).write.partitionBy("date_id").saveAsTable(table)
    search = ageing.oldest_day(spark.table(table), "2024-01-10", slack_days=1)
    assert search.first()["date_id"] == "20240105"
    scans = search._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
    assert "date_id" in scans.split("]")[0]


def test_retention(spark):
    kept, purged = (f(hot(spark), "2024-01-08", 2) for f in (ageing.within_retention, ageing.beyond_retention))
    assert kept.count() + purged.count() == 11
    assert rows(purged.select("date_id").distinct()) == [("20240104",), ("20240105",)]


@pytest.mark.parametrize("levels, count", [(1, 1), (2, 24), (3, 96)])
def test_calendar(spark, levels, count):
    day = spark.createDataFrame([(dt.date(2024, 2, 28),)], "day date")
    calendar = partitions.partition_calendar(day, levels)
    located = dicts(partitions.partition_locations(calendar, "/pm/").orderBy("location"))
    assert len(located) == count and {r["date_id"] for r in located} == {"20240229"}
    assert located[-1]["location"] == {
        1: "/pm/date_id=20240229",
        2: "/pm/date_id=20240229/hour_id=23",
        3: "/pm/date_id=20240229/hour_id=23/rop_id=45",
    }[levels]


def test_expired_is_strict_and_ignores_other_locations(spark):
    locations = spark.createDataFrame(
        [(f"/t/date_id={d}",) for d in ("20240102", "20240103", "x")] + [("/t/other=1",), ("date_id=20240101/hour_id=01",)],
        "location string",
    )
    expired = partitions.expired_partitions(locations, "2024-01-10", 7)
    assert rows(expired.select("date_id")) == [("20240101",), ("20240102",)]


def test_external_table_lifecycle(spark, tmp_path):
    table, folder = f"cold_{uuid.uuid4().hex[:8]}", str(tmp_path / "cold")
    schema = spark.createDataFrame([], "v bigint, date_id string, hour_id string").schema
    partitions.create_external_table(spark, table, schema, ["date_id", "hour_id"], folder)
    for day in (dt.date(2024, 1, 1), dt.date(2024, 1, 5)):
        calendar = partitions.partition_calendar(spark.createDataFrame([(day,)], "day date"), 2)
        assert partitions.add_partitions(spark, table, partitions.partition_locations(calendar, folder)) == 24
        assert partitions.add_partitions(spark, table, calendar) == 24  # IF NOT EXISTS
    assert partitions.table_partitions(spark, table).count() == 48
    assert partitions.purge_expired(spark, table, "2024-01-10", 7) == 24
    assert {r[0].split("/")[0] for r in partitions.table_partitions(spark, table).collect()} == {"date_id=20240106"}
    sinks.write_cold(spark.createDataFrame([(1, "20240106", "00")], schema), folder, ["date_id", "hour_id"])
    partitions.refresh_days(spark, table)
    assert spark.table(table).count() == 1


def test_cold_write_replaces_only_its_days(spark, tmp_path):
    folder = str(tmp_path / "cold")
    frame = lambda *r: spark.createDataFrame(r, "v int, date_id string")
    sinks.write_cold(frame((1, "20240101"), (2, "20240102")), folder)
    sinks.write_cold(frame((3, "20240102")), folder)
    assert rows(spark.read.parquet(folder).select("v")) == [(1,), (3,)]
    sinks.write_cold(frame((4, "20240102")), folder, append=True)
    assert spark.read.parquet(folder).count() == 3


def test_rows_are_counted_while_written(spark, tmp_path):
    frame = spark.range(1000).withColumn("date_id", F.lit("20240101")).repartition(7)
    assert sinks.counted(frame, lambda df: sinks.write_cold(df, str(tmp_path / "cold"))) == 1000
    assert spark.read.parquet(str(tmp_path / "cold")).count() == 1000


def test_column_types_for_a_relational_table(spark):
    schema = spark.createDataFrame([], "a string, b bigint, c double, d array<bigint>").schema
    assert sinks.jdbc_column_types(schema) == "`a` VARCHAR(255), `b` BIGINT, `c` DOUBLE"
    assert sinks.hot_store_columns(schema) == [
        ("a", "VARCHAR"), ("b", "BIGINT"), ("c", "DOUBLE PRECISION"), ("d", "BIGINT []"),
    ]
    assert sinks.entity_table_name("PM_X", "CELL") == "PM_X_CELL"


def test_sliced_query_filters_in_the_database():
    query = sources.hash_sliced_query("pm_cell", "nedn", "ropendtime < now()")
    assert query == (
        "(SELECT t.*, ('x' || substr(md5(nedn), 1, 8))::bit(32)::int AS key_hash FROM pm_cell t"
        " WHERE ropendtime < now()) AS sliced"
    )


def test_hash_sliced_layout(spark):
    laid_out = sources.hash_sliced(spark.range(1000).withColumn("k", F.col("id").cast("string")), "k", 4)
    assert laid_out.rdd.getNumPartitions() == 4 and laid_out.count() == 1000


class FakeConnection:
    """Writes what it is asked to do into a folder, one file per connection."""

    def __init__(self, folder):
        self.folder, self.statements = folder, []

    def cursor(self):
        return self

    def execute(self, statement, values):
        self.statements.append((statement, list(values)))

    def commit(self):
        with open(f"{self.folder}/{uuid.uuid4().hex}.json", "w") as out:
            json.dump(self.statements, out)

    def close(self):
        pass


def test_delete_by_key_covers_every_key_once(spark, tmp_path):
    folder = str(tmp_path)
    keys = spark.range(25).select(F.col("id").cast("string").alias("date_id")).union(spark.range(5).select(F.col("id").cast("string")))
    sinks.delete_by_key(keys, lambda: FakeConnection(folder), "pm_cell", "date_id", "?", batch=10)
    statements = [s for f in tmp_path.iterdir() for s in json.loads(f.read_text())]
    assert sorted(int(v) for _, values in statements for v in values) == list(range(25))
    assert all(s == f"DELETE FROM pm_cell WHERE date_id IN ({', '.join('?' * len(v))})" for s, v in statements)
