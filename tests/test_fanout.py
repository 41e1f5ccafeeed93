from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from countermill.operators import flatten
from countermill.plans import queries
from countermill.sources import counter_files as CF
from countermill.streaming.fanout import Sink, commits, committed, start_fan_out
from countermill.streaming.ingest import file_states, long_writer, start_ingest
from tests.helpers import CELLS, mdc, rows

LONG = "counter_name STRING, counter_value BIGINT, date_id STRING"
STATES = "path STRING, status STRING"


def put(folder, **files) -> None:
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.xml").write_text(text)


def names(df) -> list[tuple]:
    return sorted((r.path.rsplit("/", 1)[1], r.status) for r in df.collect())


def sinks(failing=None):
    def states(records, files):
        if failing:
            raise failing.pop()
        return file_states(records, files)

    return {"long": Sink(lambda records, files: flatten.flatten_mdc(records), ["date_id"]), "files": Sink(states)}


def test_every_file_of_a_batch_gets_a_state(spark, tmp_path):
    put(tmp_path / "in", one=mdc(instances=CELLS), two=mdc("N2"), foreign="<other>1</other>", empty="")
    put(tmp_path / "in", **{"with space": mdc(instances=CELLS), "broken": "<mdc><mfh>"})
    start_fan_out(CF.stream_mdc(spark, str(tmp_path / "in")), sinks(), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert names(committed(spark, str(tmp_path / "out"), "files", STATES)) == [
        ("broken.xml", "Dropped"),
        ("empty.xml", "Dropped"),
        ("foreign.xml", "Dropped"),
        ("one.xml", "Parsed"),
        ("two.xml", "Parsed"),
        ("with%20space.xml", "Parsed"),
    ]
    counts = {r.sink: r["rows"] for r in commits(spark, str(tmp_path / "out")).collect()}
    assert counts == {"long": 12, "files": 6}


def test_a_batch_is_seen_in_all_sinks_or_in_none(spark, tmp_path):
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    put(tmp_path / "in", one=mdc(instances=CELLS))
    stream = lambda: CF.stream_mdc(spark, str(tmp_path / "in"))
    with pytest.raises(StreamingQueryException):
        start_fan_out(stream(), sinks([RuntimeError("stopped")]), root, checkpoint).awaitTermination()
    assert (tmp_path / "out" / "long" / "batch_id=0").exists()
    assert committed(spark, root, "long", LONG).count() == 0
    # What a try leaves in other partitions goes, too.
    stale = spark.createDataFrame([("x", 1, "19990101")], LONG)
    stale.write.partitionBy("date_id").mode("append").parquet(f"{root}/long/batch_id=0")
    start_fan_out(stream(), sinks(), root, checkpoint).awaitTermination()
    assert committed(spark, root, "long", LONG).count() == 6
    assert committed(spark, root, "files", STATES).count() == 1
    put(tmp_path / "in", two=mdc("N2", instances=CELLS))
    start_fan_out(stream(), sinks(), root, checkpoint).awaitTermination()
    assert committed(spark, root, "long", LONG).groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 6), (1, 6)]


def test_a_batch_that_comes_again_after_its_commit_is_passed_over(spark, tmp_path):
    root, checkpoint = str(tmp_path / "out"), tmp_path / "cp"
    put(tmp_path / "in", one=mdc(instances=CELLS))
    start_fan_out(CF.stream_mdc(spark, str(tmp_path / "in")), sinks(), root, str(checkpoint)).awaitTermination()
    # The stream stopped after the manifest, before its own commit.
    (checkpoint / "commits" / "0").unlink()
    (checkpoint / "commits" / ".0.crc").unlink()
    never = {"long": Sink(lambda records, files: 1 / 0)}
    start_fan_out(CF.stream_mdc(spark, str(tmp_path / "in")), never, root, str(checkpoint)).awaitTermination()
    assert committed(spark, root, "long", LONG).count() == 6


def test_long_writer_names_files_without_records(spark, tmp_path):
    put(tmp_path / "in", one=mdc(instances=CELLS), foreign="<other>1</other>", empty="")
    checkpoint = str(tmp_path / "cp")
    handle = long_writer(flatten.flatten_mdc, str(tmp_path / "long"), str(tmp_path / "status"), checkpoint)
    start_ingest(CF.stream_mdc(spark, str(tmp_path / "in")), handle, checkpoint).awaitTermination()
    assert names(spark.read.parquet(str(tmp_path / "status"))) == [
        ("empty.xml", "Dropped"), ("foreign.xml", "Dropped"), ("one.xml", "Parsed")
    ]
    assert spark.read.parquet(str(tmp_path / "long")).count() == 6


def test_found_files_lists_empty_nested_and_foreign_ones(spark, tmp_path):
    put(tmp_path / "in", one="<mdc/>", empty="")
    put(tmp_path / "in" / "deep er", foreign="x")
    (tmp_path / "in" / "note.txt").write_text("12345")
    found = CF.found_files(spark, str(tmp_path / "in"))
    assert sorted((r.path.rsplit("/", 2)[1:], r.size, r.modified is not None) for r in found.collect()) == [
        (["deep%20er", "foreign.xml"], 1, True),
        (["in", "empty.xml"], 0, False),
        (["in", "note.txt"], 5, True),
        (["in", "one.xml"], 6, True),
    ]
    assert CF.found_files(spark, str(tmp_path / "in"), "*.xml").count() == 3
    scanned = spark.read.text(str(tmp_path / "in")).select(F.col("_metadata.file_path").alias("path")).distinct()
    assert scanned.join(found, "path").count() == 2


def test_a_big_group_of_documents_is_written_in_several_files(spark, tmp_path, monkeypatch):
    events = spark.range(240).selectExpr(
        "id AS event_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, id div 40) AS ts", "id % 40 AS user_id", "'view' AS event_type", "1.0D AS value"
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    queries._grouped_files(spark, str(tmp_path), str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("*/part-*"))) == 8
    monkeypatch.setattr(queries, "DOCUMENTS_PER_FILE", 15)
    queries._grouped_files(spark, str(tmp_path), str(tmp_path / "in"))
    files = [f.read_text() for f in (tmp_path / "in").glob("*/part-*")]
    assert len(files) > 8 and sum(f.count("<mdc>") for f in files) == 240
    assert all(sum(f"MeContext={user}<" in f for f in files) == 1 for user in range(40))
    found = rows(queries.batch_fanout(spark, str(tmp_path)))
    assert found == sorted(
        [("entity", "20240101", f"Cell{n}", 8, 4800) for n in range(5)]
        + [("files", None, "Dropped", 2, None), ("files", None, "Parsed", 8, None), ("long", "20240101", "view", 240, 24000)], key=str
    )
