from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from countermill.operators import log_records, ordering, replication
from countermill.sources.logs import scan_log_lines, scan_numbered_lines
from tests.helpers import dicts, rows

LOG = "\r\n".join(
    [
        "orphan line",
        "2024-01-01 10:15:30,1 [t] INFO Cls - first words",
        "  continued",
        "2024-13-01 is no date",
        "2024-01-01 10:15:31,2 [u] WARN Other - second",
        "2024-01-01 10:15:32,3 [v] INFO Last - third",
        "tail",
    ]
)


def test_records_of_a_file(spark, tmp_path):
    (tmp_path / "a.log").write_text(LOG)
    (tmp_path / "b.log").write_text("2024-01-02 00:00:00,0 [w] INFO B - only")
    lines = scan_log_lines(spark, str(tmp_path))
    records = log_records.stitch_log_records(lines).select("datetime", "thread", "log_level", "classname", "logmessage")
    assert rows(records) == [
        ("2024-01-01 10:15:30,1", "[t]", "INFO", "Cls", "first words\n  continued\n2024-13-01 is no date"),
        ("2024-01-01 10:15:31,2", "[u]", "WARN", "Other", "second"),
        ("2024-01-01 10:15:32,3", "[v]", "INFO", "Last", "third\ntail"),
        ("2024-01-02 00:00:00,0", "[w]", "INFO", "B", "only"),
    ]
    assert [r["line"] for r in dicts(log_records.orphan_lines(lines))] == ["orphan line"]


def test_records_cross_the_splits_of_a_file(spark, tmp_path):
    random.seed(3)
    expected, text = [], []
    for i in range(400):
        body = [f"line {i}.{j} " + "x" * random.randrange(40) for j in range(random.choice([0, 0, 1, 30]))]
        text += [f"2024-01-01 10:00:00,{i} [t] INFO C - m{i}", *body]
        expected.append("\n".join([f"m{i}", *body]))
    (tmp_path / "big.log").write_text("\n".join(text) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096b")
    try:
        lines = scan_log_lines(spark, str(tmp_path / "big.log"))
        assert lines.select("block").distinct().count() > 5
        assert sorted(r["logmessage"] for r in dicts(log_records.stitch_log_records(lines))) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def blocks(spark, values, rows_per_block):
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(values)], "source_file string, i bigint, v string")
    return ordering.with_blocks(df.repartition(5), "i", rows_per_block)


@pytest.mark.parametrize("rows_per_block", [1, 3, 7, 1000])
def test_carry_and_previous_across_blocks(spark, rows_per_block):
    random.seed(rows_per_block)
    values = [random.choice([None, None, None, "a", "b"]) for _ in range(60)]
    df = blocks(spark, values, rows_per_block)
    carried, last = [], None
    for v in values:
        last = v if v is not None else last
        carried.append(last)
    got = ordering.carry_forward(df, F.col("v"), "c").orderBy("i")
    assert [r["c"] for r in dicts(got)] == carried
    before = ordering.previous(df, F.col("v"), "p").orderBy("i")
    assert [r["p"] for r in dicts(before)] == [None, *values[:-1]]


def test_numbered_is_the_row_number(spark):
    random.seed(1)
    data = [("hot" if random.random() < 0.7 else random.choice("ab"), f"n{i:04}") for i in random.sample(range(2000), 500)]
    df = spark.createDataFrame(data, "g string, n string").repartition(6)
    got = {(r["g"], r["n"]): (r["no"], r["total"]) for r in dicts(ordering.numbered(df, ["g"], ["n"], "no", "total"))}
    for group in {g for g, _ in data}:
        members = sorted(n for g, n in data if g == group)
        assert [got[group, n] for n in members] == [(i, len(members)) for i in range(len(members))]


REPLICATION_LOG = """2024-01-01 10:15:30 INFO x: Exported SI_CUID: c1, SI_ID: 11, SI_NAME: n1, SI_KIND: k
2024-01-01 10:15:31 INFO x: Removing SI_CUID: c2, SI_NAME: n2, SI_KIND: k
2024-01-01 10:15:32 INFO x: Imported SI_CUID: c1, SI_ID: 21, SI_NAME: n1, SI_KIND: k
2024-01-01 10:15:33 ERROR x: Import Error: some message
2024-01-01 10:15:34 ERROR x: id: 21
"""


def test_replication_of_a_file(spark, tmp_path):
    (tmp_path / "r.log").write_text(REPLICATION_LOG)
    state = replication.replication_state(scan_log_lines(spark, str(tmp_path)))
    assert rows(state) == [
        ("c1", "n1", "11", "21", "k", False, True, "some message"),
        ("c2", "n2", "", "", "k", True, False, "Null"),
    ]


def fold(lines):
    """The state machine, one line at a time."""
    entities, errors, message = {}, {}, None
    for line in lines:
        fields = line.split(":")
        field = lambda i: fields[i].split(",")[0].strip()
        if message is not None:
            errors[fields[-1].strip()] = message
            message = None
        if "Import Error" in line:
            message = fields[-1].strip()
        blank = {"source": "", "target": "", "deleted": False}
        if "Exported SI_CUID" in line:
            entities[field(4)] = {**blank, "source": field(5), "name": field(6), "kind": field(7)}
        elif "Removing SI_CUID" in line:
            entities.setdefault(field(4), {**blank, "name": field(5), "kind": field(6)})["deleted"] = True
        elif "Imported SI_CUID" in line:
            entities.setdefault(field(4), {**blank, "name": field(6), "kind": field(7)})["target"] = field(5)
    return sorted(
        (c, e["name"], e["source"], e["target"], e["kind"], e["deleted"], e["target"] in errors, errors.get(e["target"], "Null"))
        for c, e in entities.items()
    )


@pytest.mark.parametrize("seed", range(3))
def test_replication_equals_the_fold(spark, seed):
    random.seed(seed)
    lines, stamp = [], dt.datetime(2024, 1, 1)
    for _ in range(300):
        stamp += dt.timedelta(seconds=1)
        cuid, number, version = random.randrange(12), random.randrange(6), random.randrange(3)
        tail = f"SI_NAME: n{cuid}.{version}, SI_KIND: k{version}"
        text = random.choice(
            [
                f"INFO x: Exported SI_CUID: c{cuid}, SI_ID: {number}, {tail}",
                f"INFO x: Removing SI_CUID: c{cuid}, {tail}",
                f"INFO x: Imported SI_CUID: c{cuid}, SI_ID: {number}, {tail}",
                f"ERROR x: Import Error: message {number}",
                f"ERROR x: id: {random.choice([number, ''])}",
            ]
        )
        lines.append(f"{stamp:%Y-%m-%d %H:%M:%S} {text}")
    df = spark.createDataFrame([("f", i, line) for i, line in enumerate(lines)], "source_file string, i bigint, line string")
    state = replication.replication_state(ordering.with_blocks(df.repartition(4), "i", 37))
    assert rows(state) == fold(lines)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_numbers_of_files_in_many_splits(spark, tmp_path, end):
    rng = random.Random(7)
    written = {}
    for name, count in {"a": 900, "b": 3, "c": 400}.items():
        written[name] = [f"{name}{i} " + "x" * rng.choice([0, 3, 200]) if i % 5 else "" for i in range(count - 1)] + ["last"]
        (tmp_path / f"{name}.log").write_text(end.join(written[name]), newline="")
    (tmp_path / "empty.log").write_text("")
    reading = spark.newSession()
    reading.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    numbered = scan_numbered_lines(reading, str(tmp_path))
    assert numbered.filter(F.col("source_file").endswith("a.log")).select("block").distinct().count() >= 4
    found = {}
    for row in numbered.orderBy("source_file", "pos").collect():
        found.setdefault(row.source_file[-5], []).append((row.pos, row.line))
    assert found == {name: list(enumerate(lines, 1)) for name, lines in written.items()}
