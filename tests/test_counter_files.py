from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from countermill.operators import entities, files, flatten, profiles
from countermill.operators.files import DROPPED, PARSED
from countermill.sinks.stores import write_cold
from countermill.sources import counter_files as CF
from countermill.streaming import ingest
from tests.helpers import CELLS, dicts, mdc, rows


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "a.xml").write_text(mdc(instances=CELLS))
    return tmp_path


def test_flat_rows(spark, folder):
    long = flatten.flatten_mdc(CF.scan_mdc(spark, str(folder)))
    got = {(r["moid"][-2:], r["counter_name"]): r for r in dicts(long)}
    assert {k: v["counter_value"] for k, v in got.items()} == {
        ("c1", "pma"): 5, ("c1", "pmb"): None, ("c1", "pmvec"): 1,
        ("c2", "pma"): 7, ("c2", "pmb"): 9, ("c2", "pmvec"): 4,
    }
    row = got["c1", "pma"]
    assert (row["nedn"], row["node"], row["granularity"]) == ("SubNetwork=X,MeContext=N1", "N1", "900")
    assert (row["date_id"], row["measurement"]) == ("20240101", "CellFDD")
    assert row["ropendtime"] == row["utc_timestamp"] == dt.datetime(2024, 1, 1, 9, 15)
    assert row["local_timestamp"] == dt.datetime(2024, 1, 1, 10, 15)
    assert row["source_file"].endswith("/a.xml")


def test_full_schema_keeps_header_and_footer(spark, folder):
    row = CF.scan_mdc(spark, str(folder), full=True).select("mfh.vn", "mff.ts").first()
    assert tuple(row) == ("V", "20240101101500Z")


def test_wide_forms_agree_when_keys_are_unique(spark, folder):
    records = CF.scan_mdc(spark, str(folder))
    long = flatten.flatten_mdc(records)
    keys = ["moid", "node", "ropendtime"]
    pivoted = entities.to_entity(long, ["pma", "pmb"], "CellFDD", keys=keys)
    by_pivot = entities.to_entity(long, ["pma", "pmb"], "CellFDD", keys=keys, conditional_limit=0)
    looked_up = entities.to_entity_from_map(flatten.mdc_counter_maps(records), {"pma": "pmA", "pmb": "pmB"}, "CellFDD", keys)
    typed = looked_up.select(*keys, looked_up["pma"].try_cast("bigint"), looked_up["pmb"].try_cast("bigint"))
    assert rows(pivoted) == rows(by_pivot) == rows(typed)
    assert pivoted.count() == 2


@pytest.mark.parametrize("agg", ["first", "sum"])
def test_merged_wide_rows_equal_the_pivot(spark, tmp_path, agg):
    for name, names, value in (("b", ("x", "y"), "7"), ("a", ("y", "z"), "5"), ("c", ("z", "w"), "")):
        cells = [(f"A=1,Cell=c{i}", [(0, value), (1, str(i))]) for i in range(3)]
        (tmp_path / f"{name}.xml").write_text(mdc(names=names, instances=cells))
    records = CF.scan_mdc(spark, str(tmp_path))
    keys, counters = ["moid", "ropendtime"], ["w", "x", "y"]
    wide = entities.to_entity_from_map(
        flatten.mdc_counter_maps(records), {c: c for c in counters}, keys=[*keys, "source_file", "source_pos"], integers=True
    )
    pivoted = entities.to_entity(flatten.flatten_mdc(records), counters, agg=agg, keys=keys)
    assert rows(entities.merge_rows(wide, counters, keys, agg)) == rows(pivoted)


def test_absent_counter_is_null(spark, folder):
    records = CF.scan_mdc(spark, str(folder))
    wide = entities.to_entity_from_map(flatten.mdc_counter_maps(records), {"x": "pmNone"}, keys=["moid"])
    assert {r["x"] for r in dicts(wide)} == {None}


def test_vector_entity(spark, folder):
    maps = flatten.mdc_counter_maps(CF.scan_mdc(spark, str(folder)))
    vectors = entities.to_vector_entity(maps, ["pmVec"], "CellFDD", ["moid"])
    got = {r["moid"][-2:]: r for r in dicts(vectors)}
    assert [got["c1"][f"bin{i}"] for i in range(4)] == ["1", "2", "3", None]
    assert got["c2"]["bin0"] == "4" and got["c2"]["bin255"] is None
    assert vectors.columns[-1] == "bin255" and got["c1"]["counter_name"] == "pmVec"


def test_index_base_one(spark, tmp_path):
    cells = [("A=1,Cell=c", [(1, "5"), (2, "6")])]
    (tmp_path / "a.xml").write_text(mdc(names=("x", "y"), instances=cells))
    records = CF.scan_mdc(spark, str(tmp_path))
    assert rows(flatten.flatten_mdc(records, 1).select("counter_name", "counter_value")) == [("x", 5), ("y", 6)]
    # Read from zero, index 2 lies outside the list.
    assert rows(flatten.flatten_mdc(records).select("counter_name", "counter_value")) == [("y", 5)]


def test_repeated_counter_in_one_list_keeps_the_last(spark, tmp_path):
    cells = [("A=1,Cell=c", [(0, "5"), (0, "6"), (1, "x")]), ("A=1,Cell=d", [(0, "1"), (2, "2")])]
    (tmp_path / "a.xml").write_text(mdc(names=("x", "y", "x"), instances=cells))
    records = CF.scan_mdc(spark, str(tmp_path))
    long = flatten.flatten_mdc(records).select("moid", "counter_name", "counter_value")
    assert rows(long) == [("A=1,Cell=c", "x", 6), ("A=1,Cell=c", "y", None), ("A=1,Cell=d", "x", 2)]
    maps = flatten.explode_counters(flatten.mdc_counter_maps(records))
    assert rows(flatten.long_counters(maps).select("moid", "counter_name", "counter_value")) == rows(long)


def test_parts_of_split_files_equal_the_whole(spark, tmp_path):
    for node in ("N1", "N&amp;2"):
        infos = "".join(
            f"<mi><mts>202401011015{i % 60:02}Z</mts><gp>900</gp><mt>x</mt><mt>y</mt>"
            f"<mv><moid>A=1,Cell=c{i}</moid><r p='0'>{i}</r><r p='1'/><r p='0'>{i + 1}</r></mv></mi>\n"
            for i in range(300)
        )
        document = f"<mdc>\n<mfh><ffv>1</ffv>\n<sn>Net=X,Node={node}</sn></mfh><md>{infos}</md><mff><ts>z</ts></mff></mdc>"
        (tmp_path / f"{node[:2]}{len(node)}.xml").write_text(document)
    (tmp_path / "empty.xml").write_text("<mdc><mfh><sn>e</sn></mfh><md/></mdc>")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192b")
    try:
        parts = CF.scan_mdc_parts(spark, str(tmp_path))
        split = flatten.long_counters(flatten.raw_counters(flatten.mdc_part_instances(parts)))
        whole = flatten.flatten_mdc(CF.scan_mdc(spark, str(tmp_path)))
        compared = ["nedn", "moid", "ropendtime", "date_id", "counter_name", "counter_value", "source_file"]
        assert parts.select("part_pos.block").distinct().count() > 2
        assert whole.count() == 1200
        assert rows(split.select(compared)) == rows(whole.select(compared))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_empty_lists_give_no_rows(spark, tmp_path):
    (tmp_path / "a.xml").write_text(mdc(names=(), instances=[("A=1,Cell=c", [(0, "5")])]))
    (tmp_path / "b.xml").write_text(mdc(instances=()))
    records = CF.scan_mdc(spark, str(tmp_path))
    assert flatten.flatten_mdc(records).count() == 0
    assert len(rows(CF.parsed_files(records))) == 2


def test_same_key_in_two_files_takes_the_first_file(spark, tmp_path):
    for name, text in (("a", "5"), ("b", "6")):
        (tmp_path / f"{name}.xml").write_text(mdc(names=("x",), instances=[("A=1,Cell=c", [(0, text)])]))
    long = flatten.flatten_mdc(CF.scan_mdc(spark, [str(tmp_path / "b.xml"), str(tmp_path / "a.xml")]))
    for limit in (0, 64):
        first = entities.to_entity(long, ["x"], keys=["moid"], conditional_limit=limit)
        total = entities.to_entity(long, ["x"], agg="sum", keys=["moid"], conditional_limit=limit)
        assert rows(first) == [("A=1,Cell=c", 5)]
        assert rows(total) == [("A=1,Cell=c", 11)]


def test_unreadable_file_is_dropped_not_lost(spark, folder):
    (folder / "bad.xml").write_text("<mdc><mfh><sn>a</sn></mfh><md><mi>")
    records = CF.scan_mdc(spark, str(folder))
    assert [r[0].rsplit("/", 1)[1] for r in rows(CF.unreadable_files(records))] == ["bad.xml"]
    assert [r[0].rsplit("/", 1)[1] for r in rows(CF.parsed_files(records))] == ["a.xml"]
    assert flatten.flatten_mdc(records).count() == 6


MEAS = """<measData><managedElement localDn="N1">
 <measInfo measInfoId="G1"><granPeriod duration="PT86400S" endTime="2024-01-01T00:30:00+02:00"/>
  <measType p="1">A</measType><measType p="2">B</measType>
  <measValue measObjLdn="o1"><r p="1">5</r><r p="2">6</r><r p="9">7</r></measValue>
  <measValue measObjLdn="o2"><r p="2">8</r></measValue></measInfo>
 <measInfo measInfoId="G2"><granPeriod duration="PT900S" endTime="2024-01-01T10:00:00Z"/>
  <measType p="1">C</measType><measValue measObjLdn="o1"><r p="1">1</r></measValue></measInfo>
</managedElement></measData>"""


def test_measdata_counts_every_info_and_value(spark, tmp_path):
    (tmp_path / "m.xml").write_text(MEAS)
    long = flatten.flatten_measdata(CF.scan_measdata(spark, str(tmp_path)))
    got = rows(long.select("measurement", "moid", "node", "granularity", "date_id", "counter_name", "counter_value"))
    assert got == [
        ("G1", "o1", "N1", "86400", "20231231", "a", 5),
        ("G1", "o1", "N1", "86400", "20231231", "b", 6),
        ("G1", "o2", "N1", "86400", "20231231", "b", 8),
        ("G2", "o1", "N1", "900", "20240101", "c", 1),
    ]
    wide = entities.to_entity(long, ["a", "b"], "G1", "sum", ["node"])
    assert rows(wide) == [("N1", 5, 14)]


def test_documents_with_prolog_and_namespace(spark, tmp_path):
    prolog = '<?xml version="1.0" encoding="UTF-8"?>\n<?xml-stylesheet type="text/xsl" href="m.xsl"?>\n'
    (tmp_path / "a.xml").write_text(f'{prolog}<!DOCTYPE mdc SYSTEM "m.dtd">\n<!-- c -->\n{mdc(instances=CELLS)}\n')
    assert flatten.flatten_mdc(CF.scan_mdc(spark, str(tmp_path / "a.xml"))).count() == 6
    file = f'{prolog}<measCollecFile xmlns="http://x/y#measCollec"><fileHeader/>{MEAS}</measCollecFile>'
    (tmp_path / "m.xml").write_text(file)
    assert flatten.flatten_measdata(CF.scan_measdata(spark, str(tmp_path / "m.xml"))).count() == 4


def test_listing_is_recursive_and_by_pattern(spark, folder):
    (folder / "sub").mkdir()
    (folder / "sub" / "b.xml").write_text("x")
    (folder / "sub" / "c.txt").write_text("x")
    assert [r[0].rsplit("/", 1)[1] for r in rows(CF.list_files(spark, str(folder)))] == ["a.xml", "b.xml"]


def test_coverage_counts_all_classes_of_a_block(spark, tmp_path):
    cells = [("A=1,Cell=c", [(0, "5")]), ("A=1,Link=d", [(0, "5")])]
    (tmp_path / "a.xml").write_text(mdc(names=("x", "y"), instances=cells))
    (tmp_path / "b.xml").write_text(mdc(names=("y", "z"), instances=cells[:1]))
    covered = profiles.counter_coverage(CF.scan_mdc(spark, str(tmp_path)))
    assert rows(covered) == [("Cell", 3, ["x", "y", "z"]), ("Link", 2, ["x", "y"])]


def test_stream_takes_each_file_once(spark, tmp_path):
    source, long_path, status_path, state = (str(tmp_path / p) for p in ("in", "long", "status", "state"))
    (tmp_path / "in").mkdir()
    handle = ingest.long_writer(flatten.flatten_mdc, long_path, status_path)

    def run():
        query = ingest.start_ingest(CF.stream_mdc(spark, source, max_files=1), handle, state)
        query.awaitTermination()

    (tmp_path / "in" / "a.xml").write_text(mdc(instances=CELLS))
    (tmp_path / "in" / "bad.xml").write_text("<mdc><mfh>")
    run()
    assert spark.read.parquet(long_path).count() == 6
    (tmp_path / "in" / "b.xml").write_text(mdc("N2", instances=CELLS))
    run()
    run()
    written = spark.read.parquet(long_path)
    assert written.count() == 12
    assert {"batch_id", "measurement", "date_id"} <= set(written.columns)
    states = {r["path"].rsplit("/", 1)[1]: r["status"] for r in dicts(spark.read.parquet(status_path))}
    assert states == {"a.xml": PARSED, "b.xml": PARSED, "bad.xml": DROPPED}


def test_backlog_cycle_from_listing_to_stream_states(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a b.xml").write_text(mdc(instances=CELLS))
    (inbox / "bad.xml").write_text("<mdc><mfh>")
    empty = spark.createDataFrame([], "path string, status string, received_date timestamp, processed_date timestamp")
    backlog = files.register_files(empty, CF.list_files(spark, str(inbox)), F.lit("2024-01-01"))
    specs = [entities.EntitySpec("CELL", "CellFDD", ("pma",), keys=("moid",))]

    def write(name, batch_id, df):
        write_cold(df.withColumn("batch_id", F.lit(batch_id)), str(tmp_path / name), ["batch_id"])

    handlers = [
        ingest.long_writer(flatten.flatten_mdc, str(tmp_path / "long"), str(tmp_path / "status")),
        ingest.entity_writer(flatten.flatten_mdc, specs, write),
    ]

    def handle(batch, batch_id):
        for one in handlers:
            one(batch, batch_id)

    ingest.start_ingest(CF.stream_mdc(spark, str(inbox)), handle, str(tmp_path / "state")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "CELL")).select("pma")) == [(5,), (7,)]
    states = spark.read.parquet(str(tmp_path / "status"))
    closed = files.apply_states(backlog, states, F.to_timestamp(F.lit("2024-01-02")))
    assert sorted((r["path"].rsplit("/", 1)[1], r["status"]) for r in dicts(closed)) == [
        ("a%20b.xml", PARSED), ("bad.xml", DROPPED),
    ]


def test_long_sink_writes_each_row_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out = str(tmp_path / "out")

    def run():
        stream = CF.stream_mdc(spark, str(tmp_path / "in"))
        ingest.start_long_sink(stream, flatten.flatten_mdc, out, str(tmp_path / "state")).awaitTermination()

    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.xml").write_text(mdc(name, instances=CELLS))
        run()
    run()
    assert spark.read.parquet(out).count() == 12


def test_every_entity_of_a_batch_is_written(spark, folder, tmp_path):
    long = flatten.flatten_mdc(CF.scan_mdc(spark, str(folder)))
    specs = [
        entities.EntitySpec("CELL", "CellFDD", ("pma", "pmb"), keys=("moid",)),
        entities.EntitySpec("SUMS", "CellFDD", ("pma",), "sum", ("node",)),
        entities.EntitySpec("NONE", "Other", ("pma",), keys=("moid",)),
    ]
    entities.write_entities(long, specs, lambda name, df: df.write.parquet(str(tmp_path / "e" / name)))
    read = {s.name: rows(spark.read.parquet(str(tmp_path / "e" / s.name))) for s in specs}
    assert read["CELL"] == [(CELLS[0][0], 5, None), (CELLS[1][0], 7, 9)]
    assert read["SUMS"] == [("N1", 12)] and read["NONE"] == []


def test_many_counters_take_the_pivot(spark, folder):
    long = flatten.flatten_mdc(CF.scan_mdc(spark, str(folder)))
    many = ["pma", "pmb", *[f"absent{i}" for i in range(entities.CONDITIONAL_COUNTERS)]]
    wide = entities.to_entity(long, many, keys=["moid"])
    assert wide.columns == ["moid", *many]
    assert rows(wide.select("pma", "pmb", "absent0")) == [(5, None, None), (7, 9, None)]


def test_repeated_batch_adds_nothing(spark, folder, tmp_path):
    records = CF.scan_mdc(spark, str(folder))
    handle = ingest.long_writer(flatten.flatten_mdc, str(tmp_path / "out"))
    handle(records, 0)
    handle(records, 0)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_path_profile(spark):
    documents = [("<a x='1'>t<b/><b y='2'>u</b></a>",), ("<a xmlns='urn:n'><c/></a>",), ("<a><b>",)]
    profile = profiles.xml_path_profile(spark.createDataFrame(documents, "value string").repartition(3))
    assert rows(profile) == [
        ("a", "Multiple", True, ["x"]),
        ("a.b", "Multiple", True, ["y"]),
        ("a.c", "Single", False, []),
        (None, "Single", False, []),
    ]
