"""Plans stay what they are meant to be: shuffles, pushdown, single evaluation."""

from __future__ import annotations

import datetime as dt

import pytest

from countermill.operators import ageing, entities, files, flatten, model_diff, splits
from countermill.plans.queries import QUERIES
from countermill.sources import counter_files as CF
from tests.helpers import CELLS, mdc

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture()
def plan(capsys):
    def text(df) -> str:
        capsys.readouterr()
        df.explain()
        return capsys.readouterr().out

    return text


@pytest.fixture()
def records(spark, tmp_path):
    (tmp_path / "a.xml").write_text(mdc(instances=CELLS))
    return CF.scan_mdc(spark, str(tmp_path))


def test_flattening_and_lookup_do_not_shuffle(plan, records):
    maps = flatten.mdc_counter_maps(records)
    for df in (
        flatten.flatten_mdc(records),
        entities.to_entity_from_map(maps, {"a": "pmA"}),
        entities.to_vector_entity(maps, ["pmVec"]),
    ):
        assert "Exchange" not in plan(df)


def test_few_counters_shuffle_once_many_twice(plan, records):
    long = flatten.flatten_mdc(records)
    few = [f"c{i}" for i in range(entities.CONDITIONAL_COUNTERS)]
    assert plan(entities.to_entity(long, few)).count("Exchange hashpartitioning") == 1
    assert plan(entities.to_entity(long, [*few, "x"])).count("Exchange hashpartitioning") == 2


def test_one_number_as_order_stays_hash_based(spark, plan):
    long = spark.createDataFrame([("k", "a", 1, 1)], "k string, counter_name string, counter_value bigint, id bigint")
    assert "SortAggregate" not in plan(entities.to_entity(long, ["a"], keys=["k"], order_by=["id"]))


def test_text_documents_are_parsed_once(spark, plan):
    documents = spark.createDataFrame([("f", mdc(instances=CELLS))], "file string, value string").repartition(2)
    parsed = CF.parse_mdc_text(documents, "value", "file")
    assert plan(flatten.flatten_mdc(parsed)).count("from_xml(") == 1
    assert flatten.flatten_mdc(parsed).count() == 6


def test_set_logic_takes_one_shuffle(spark, plan):
    paths = spark.createDataFrame([("a",)], "path string")
    backlog = spark.createDataFrame([("a", None)], "path string, status string")
    assert plan(files.reconcile(paths, backlog)).count("Exchange hashpartitioning") == 1
    both = spark.createDataFrame([("a", "p", "v")], "path string, prop string, value string")
    assert plan(model_diff.model_diff(both, both, ["path", "prop"])).count("Exchange hashpartitioning") == 1
    assert plan(splits.natural_full_join([both, both])).count("Exchange hashpartitioning") == 1
    stitched = splits.stitch_splits([both, both.withColumnRenamed("value", "w")], ["path", "prop"], unique_keys=True)
    assert plan(stitched).count("Exchange hashpartitioning") == 1


def test_ageing_prunes_folders_and_pushes_the_window(spark, plan, tmp_path):
    rows = [(dt.datetime(2024, 1, d), f"202401{d:02}") for d in (4, 5, 6)]
    spark.createDataFrame(rows, "ropendtime timestamp, date_id string").write.partitionBy("date_id").parquet(str(tmp_path / "t"))
    hot = spark.read.schema("ropendtime timestamp, date_id string").parquet(str(tmp_path / "t"))
    text = plan(ageing.age_out(hot, "2024-01-10")[0])
    assert "GreaterThanOrEqual(ropendtime" in text
    assert "date_id" in text.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"q_stream_ingest", "q_stream_mdc", "q_mdc_files"}))
def test_no_query_multiplies_its_inputs(spark, plan, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
