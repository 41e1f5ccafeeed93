from __future__ import annotations

from countermill.operators import models
from tests.helpers import rows

STRUCTS = "struct_name STRING, member STRING, enum_ref STRING, struct_ref STRING"
CHAIN = [
    ("a", "x", None, "b"), ("a", "y", None, None), ("b", "x", None, "c"), ("c", "x", None, "d"), ("d", "end", "E", None),
    ("p", "q", None, "q"), ("q", "p", None, "p"), ("q", "own", None, "q"), ("q", "leaf", None, None),
    ("u", "gone", None, "nowhere"), ("u", None, None, None), ("a", "y", None, None),
]


def test_chains_cycles_and_undefined_structs(spark):
    structs = spark.createDataFrame(CHAIN, STRUCTS)
    found = rows(models.struct_closure(structs, spark.createDataFrame([("a",), ("p",), ("u",), ("z",), (None,)], "struct_name STRING")))
    assert found == sorted(
        [
            ("a", "x.x.x.end", 4, "enum", "E"),
            ("a", "y", 1, "member", None),
            ("p", "q.leaf", 2, "member", None),
            ("p", "q.own", 2, "cycle", "q"),
            ("p", "q.p", 2, "cycle", "p"),
            ("u", "gone", 1, "undefined", "nowhere"),
            ("u", "", 1, "member", None),
            ("z", "", 0, "undefined", "z"),
        ],
        key=repr,
    )
    assert {r.root for r in models.struct_closure(structs).collect()} == {"a", "b", "c", "d", "p", "q", "u"}


def test_attributes_get_all_members(spark):
    attributes = spark.createDataFrame(
        [("s", None, "a"), ("e", "E", None), ("none", None, None), ("lost", "gone", None), ("s", None, "a")],
        "name STRING, enum_ref STRING, struct_ref STRING",
    )
    enums = spark.createDataFrame([("E", "one"), ("E", "two")], "enum_name STRING, member STRING")
    found = models.resolve_nested(attributes, enums, spark.createDataFrame(CHAIN, STRUCTS))
    assert rows(found.select("name", "path", "kind", "nested_ref")) == sorted(
        [("s", "x.x.x.end", "enum", "E"), ("s", "y", "member", None)] * 2
        + [("e", "one", "enum", None), ("e", "two", "enum", None), ("none", None, None, None), ("lost", None, None, None)],
        key=repr,
    )


def test_no_structs(spark):
    nothing = spark.createDataFrame([], STRUCTS)
    assert models.struct_closure(nothing).count() == 0


def test_rounds_do_not_add_partitions_to_partitions(spark, tmp_path):
    depth = 6
    chain = [(f"s{i}", "m", None, f"s{i + 1}" if i < depth else None) for i in range(depth + 1)]
    spark.createDataFrame(chain, STRUCTS).write.parquet(str(tmp_path / "structs"))
    structs = spark.read.parquet(str(tmp_path / "structs"))
    closure = models.struct_closure(structs)
    # As many for each round, not twice those of the round before.
    assert closure.rdd.getNumPartitions() <= 12 * (depth + 1)
    assert sorted(r.depth for r in closure.collect()) == list(range(1, depth + 2))


def test_members_of_few_references_are_broadcast(spark):
    attributes = spark.createDataFrame([("s", None, "a")] * 3, "name STRING, enum_ref STRING, struct_ref STRING")
    enums = spark.createDataFrame([("E", "one")], "enum_name STRING, member STRING")
    found = models.resolve_nested(attributes, enums, spark.createDataFrame(CHAIN, STRUCTS))
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 6
