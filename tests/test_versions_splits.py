from __future__ import annotations

import random

import duckdb
import pytest

from countermill.operators import splits, versions
from tests.helpers import dicts, rows


@pytest.fixture()
def three(spark):
    return {
        "v1": spark.createDataFrame([("k1", 1, 2)], "k string, a int, b int"),
        "v2": spark.createDataFrame([("k2", 1.5, "x")], "k string, a double, c string"),
        "v3": spark.createDataFrame([("k3", "t", [7, 8]), ("k4", "u", None)], "k string, a string, arr array<bigint>"),
    }


def test_merged_view(three):
    merged = versions.merge_versions(three)
    assert [(f.name, f.dataType.simpleString()) for f in merged.schema] == [
        ("version", "string"), ("k", "string"), ("a", "string"), ("b", "int"), ("c", "string"),
        ("arr_index", "int"), ("arr", "bigint"),
    ]
    assert rows(merged) == [
        ("v1", "k1", "1", 2, None, None, None),
        ("v2", "k2", "1.5", None, "x", None, None),
        ("v3", "k3", "t", None, None, 0, 7),
        ("v3", "k3", "t", None, None, 1, 8),
        ("v3", "k4", "u", None, None, None, None),
    ]


def test_version_without_any_view_column_is_left_out(three):
    assert {r["version"] for r in dicts(versions.merge_versions(three, ["b", "c"]))} == {"v1", "v2"}


def test_integers_widen_before_the_union(spark):
    parts = {"v1": spark.createDataFrame([(1,)], "a int"), "v2": spark.createDataFrame([(2**40,)], "a bigint")}
    assert rows(versions.merge_versions(parts)) == [("v1", 1), ("v2", 2**40)]
    mixed = {"v1": spark.createDataFrame([(1,)], "a int"), "v2": spark.createDataFrame([("x",)], "a string")}
    assert rows(versions.merge_versions(mixed)) == [("v1", "1"), ("v2", "x")]


def test_row_count_is_the_sum_without_arrays(spark):
    parts = {f"v{i}": spark.range(i * 10) for i in range(1, 4)}
    assert versions.merge_versions(parts).count() == 60


def test_several_arrays_multiply_or_zip(spark):
    df = spark.createDataFrame([("k", [1, 2], [3, 4, 5])], "k string, x array<int>, y array<int>")
    assert versions.merge_versions({"v": df}).count() == 6
    zipped = rows(versions.merge_versions({"v": df}, zip_arrays=True).select("x_index", "x", "y_index", "y"))
    assert zipped == [(0, 1, 0, 3), (1, 2, 1, 4), (2, None, 2, 5)]


def test_catalog_widening(spark):
    columns = spark.createDataFrame(
        [
            ("E", "v1", "a", "INT"), ("E", "v2", "a", "BIGINT"), ("E", "v3", "a", "MISSING"),
            ("E", "v1", "b", "MISSING"), ("E", "v2", "b", "VARCHAR(10)"), ("E", "v3", "b", "MISSING"),
        ],
        "entity string, version string, column string, type string",
    )
    assert rows(versions.widened_columns(columns)) == [("E", "a", "BIGINT"), ("E", "b", "VARCHAR")]
    assert rows(versions.usable_versions(columns)) == [("E", "v1", 1, 2), ("E", "v2", 0, 2)]
    assert rows(versions.column_versions(columns.replace("BIGINT", "INT")))[0] == ("E", "a", "INT", "v1::v2")


@pytest.mark.parametrize("unique", [False, True])
def test_stitch_with_unmatched_and_null_keys(spark, unique):
    t0 = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, x string")
    t1 = spark.createDataFrame([(1, "A"), (3, "B"), (None, "C")], "k int, y string")
    stitched = splits.stitch_splits([t0, t1], ["k"], unique_keys=unique)
    assert rows(stitched) == sorted(
        [(1, "a", "A"), (2, "b", None), (3, None, "B"), (None, "c", None), (None, None, "C")], key=repr
    )


def test_repeated_keys_multiply_in_the_join(spark):
    t0 = spark.createDataFrame([(1, "a"), (1, "b")], "k int, x string")
    t1 = spark.createDataFrame([(1, "A"), (1, "B")], "k int, y string")
    assert splits.stitch_splits([t0, t1], ["k"]).count() == 4


def test_repeated_keys_fail_where_promised_unique(spark):
    t0 = spark.createDataFrame([(1, "a"), (1, "b")], "k int, x string")
    t1 = spark.createDataFrame([(1, "A")], "k int, y string")
    with pytest.raises(Exception, match="repeats a key"):
        splits.stitch_splits([t0, t1], ["k"], unique_keys=True).collect()


def test_natural_full_join_like_the_database(spark):
    random.seed(7)
    sides = [[(random.choice([1, 2, 3, None]), random.choice("ab")) for _ in range(n)] for n in (9, 7, 5)]
    frames = [spark.createDataFrame(side, "p int, q string") for side in sides]
    con = duckdb.connect()
    for i, side in enumerate(sides):
        con.execute(f"CREATE TABLE t{i} (p INTEGER, q VARCHAR)")
        con.executemany(f"INSERT INTO t{i} VALUES (?, ?)", side)
    for n in (2, 3):
        joined = " NATURAL FULL JOIN ".join(f"t{i}" for i in range(n))
        expected = sorted(con.execute(f"SELECT p, q FROM {joined}").fetchall(), key=repr)
        assert rows(splits.natural_full_join(frames[:n])) == expected


def test_natural_full_join_with_very_many_copies(spark):
    many = spark.range(300).selectExpr("1 AS p")
    assert splits.natural_full_join([many, many]).count() == 300 * 300
