"""Cases where two ways to the same result once differed, or rows were lost."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from countermill.functions.types import widened, widened_column
from countermill.operators import entities, model_diff, models, routing, splits
from countermill.sinks.stores import write_long
from countermill.sources import counter_files as CF
from countermill.sources import node_models, stores
from tests.helpers import CELLS, mdc, rows

RULES = (
    "techpack_version_id STRING, target_package_name STRING, rule_name STRING, parent_rule_name STRING,"
    "execution_order INT, match_type STRING, match_argument STRING, match_value STRING, target_name STRING"
)
ATTRIBUTES = "mo_name STRING, name STRING, data_type STRING, properties MAP<STRING, STRING>"


@pytest.mark.parametrize("in_plan", [500, 0])
def test_rules_on_nulls_repeats_and_any_property(spark, in_plan):
    rules = spark.createDataFrame(
        [
            ("t", "P", "o", "BASE", 1, "ALL", None, None, None),
            ("t", "P", "a0", "o", 1, "equals", "dataType", None, "N"),
            ("t", "P", "a1", "o", 2, "equals", "colour", "red", "R"),
            ("t", "P", "a2", "o", 3, "ALL", None, None, "REST"),
        ],
        RULES,
    )
    attributes = spark.createDataFrame(
        [("M", "a", None, {}), ("M", "a", None, {}), ("M", "b", "long", {"colour": "red"}), ("M", "c", "long", None)], ATTRIBUTES
    )
    routed = routing.routed_attributes(attributes, rules, "BASE", in_plan)
    found = sorted((r["name"], r["table"]) for r in routed.collect())
    assert found == [("a", "P_MN"), ("a", "P_MN"), ("b", "P_MR"), ("c", "P_MREST")] or found == [
        ("a", "P_M_N"),
        ("a", "P_M_N"),
        ("b", "P_M_R"),
        ("c", "P_M_REST"),
    ]


def test_a_long_vector_fails(spark):
    raw = spark.createDataFrame([(1, "v", ",".join(map(str, range(300))))], "k INT, counter_name_raw STRING, counter_value_raw STRING")
    with pytest.raises(Exception, match="more than 256 values"):
        entities.to_vector_rows(raw, ["k"]).collect()
    assert entities.vector_long(raw, ["k"]).count() == 300


def test_batches_of_a_day_stay(spark, tmp_path):
    frame = lambda n: spark.createDataFrame([("M", "20240101", n)], "measurement STRING, date_id STRING, v INT")
    for batch, n in (("q1", 1), ("q2", 2), ("q2", 3)):
        write_long(frame(n), str(tmp_path / "long"), batch)
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "long")).collect()) == [1, 3]


def test_parts_of_several_documents(spark, tmp_path):
    text = "<files>" + mdc("N1", instances=CELLS) + mdc("N2", instances=CELLS[:1]) + "</files>"
    (tmp_path / "two.xml").write_text(text)
    parts = CF.scan_mdc_parts(spark, str(tmp_path / "two.xml")).collect()
    assert [r.nedn for r in sorted(parts, key=lambda r: r.part_pos)] == ["SubNetwork=X,MeContext=N1", "SubNetwork=X,MeContext=N2"]


@pytest.mark.parametrize(
    "types",
    [
        ["INT", "FLOAT"], ["FLOAT"], ["TINYINT", "FLOAT"], ["TIMESTAMP", "TIMESTAMP"], ["TIMESTAMP", "INT"], ["MISSING"],
        ["ARRAY<INT>:4", "ARRAY<BIGINT>:8"], ["ARRAY<BIGINT>:8", "ARRAY<DOUBLE>:2", "MISSING"], ["ARRAY<INT>", "INT"],
        ["VARCHAR(3)", "CHAR"], ["BIGINT", "DOUBLE"], ["ARRAY<BIGINT>:8", "ARRAY<BIGINT>:8"],
        ["VARCHAR(10)"], ["CHAR(4)", "CHAR(4)"], ["ARRAY<CHAR(3)>:2"], ["ARRAY<STRING>", "ARRAY<VARCHAR(4)>:2"],
    ],
)
def test_both_forms_of_widening_agree(spark, types):
    found = spark.createDataFrame([(types,)], "t ARRAY<STRING>").select(widened_column("t")).first()[0]
    assert found == widened(types)
    if types in (["VARCHAR(10)"], ["CHAR(4)", "CHAR(4)"]):
        assert found == "VARCHAR"
    if types == ["INT", "FLOAT"]:
        assert found == "DOUBLE"


def test_first_takes_the_first_value_there_is(spark):
    long = spark.createDataFrame(
        [("k", "a", 1, None), ("k", "a", 2, 5), ("k", "b", 1, None)], "k STRING, counter_name STRING, pos INT, counter_value BIGINT"
    )
    for limit in (0, 12):
        assert rows(entities.to_entity(long, ["a", "b"], keys=["k"], order_by=["pos"], conditional_limit=limit)) == [("k", 5, None)]


def test_a_repeated_key_of_a_snapshot_fails(spark):
    old, new = (spark.createDataFrame(r, "k INT, value STRING") for r in ([(1, "1"), (1, "2")], [(1, "2")]))
    with pytest.raises(Exception, match="repeats a key"):
        model_diff.model_diff(old, new, ["k"]).collect()


def test_unreadable_model_documents_are_told(spark):
    good = '<Entity name="m"><A>1</A></Entity>'
    documents = spark.createDataFrame([(good,), ("<broken",), (None,)], "value STRING")
    assert {r.model for r in node_models.model_rows(documents).collect()} == {"m"}
    assert {r.document for r in node_models.unreadable_models(documents).collect()} == {"<broken", None}


def test_slices_are_filled_evenly(spark):
    laid_out = stores.hash_sliced(spark.range(40000).withColumn("k", F.col("id").cast("string")), "k", 200)
    sizes = [r[1] for r in laid_out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 200 and max(sizes) < 2 * 200


def test_rows_that_match_nothing_are_not_shuffled(spark):
    left = spark.createDataFrame([(1, 1), (None, 2), (None, 2)], "k INT, a INT")
    right = spark.createDataFrame([(1, 3), (None, 4)], "k INT, b INT")
    found = splits.stitch_splits([left, right], ["k"])
    assert rows(found) == rows(spark.createDataFrame([(1, 1, 3), (None, 2, None), (None, 2, None), (None, None, 4)], "k INT, a INT, b INT"))
    attributes = spark.createDataFrame([("x", None, None), ("y", "E", None)], "name STRING, enum_ref STRING, struct_ref STRING")
    enums = spark.createDataFrame([("E", "m")], "enum_name STRING, member STRING")
    structs = spark.createDataFrame([], "struct_name STRING, member STRING, enum_ref STRING, struct_ref STRING")
    members = models.resolve_references(attributes, enums, structs)
    assert sorted((r["name"], r.member) for r in members.collect()) == [("x", None), ("y", "m")]
