from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from countermill.operators import catalog, kpi, model_diff, models, routing
from countermill.plans import standins as S
from countermill.schemas import CATALOG
from countermill.sinks.stores import write_catalog
from countermill.sources import node_models as NM
from countermill.sources.kpi_definitions import scan_kpi_definitions
from countermill.sources.stores import Catalog
from tests.helpers import dicts, rows

PACK = """<EntityDef name="BASE_X_R1">
<TECHPACK_NAME>BASE_X</TECHPACK_NAME><TECHPACK_RELEASE>R1</TECHPACK_RELEASE><TECHPACK_TYPE>BASE</TECHPACK_TYPE>
<VENDOR>V</VENDOR><TECHNOLOGY>T</TECHNOLOGY><DEPENDENCY>A,B</DEPENDENCY><DESCRIPTION>a &amp;lt; b</DESCRIPTION>
<Components section="REPORTABLE_ENTITIES">
 <EntityDef name="COMMON"><ENTITY_TYPE>BASE</ENTITY_TYPE><RETENTION_PLAN>SHORT</RETENTION_PLAN><MAPPED_MO>Cell</MAPPED_MO>
  <Components section="REPORTABLE_ENTITIES_COLUMNS">
   <EntityDef name="date_id"><ENTITY_COLUMN_ORDER>0</ENTITY_COLUMN_ORDER><ENTITY_COLUMN_TYPE>STRING</ENTITY_COLUMN_TYPE>
    <ENTITY_COLUMN_TYPE>key</ENTITY_COLUMN_TYPE><ENTITY_DATA_TYPE>STRING</ENTITY_DATA_TYPE><PARTITION_BY>1</PARTITION_BY>
    <ENTITY_DESCRIPTION>it's</ENTITY_DESCRIPTION></EntityDef>
   <EntityDef name="moid"><ENTITY_COLUMN_ORDER>1</ENTITY_COLUMN_ORDER><ENTITY_COLUMN_TYPE>key</ENTITY_COLUMN_TYPE>
    <ENTITY_DATA_TYPE>STRING</ENTITY_DATA_TYPE><PARTITION_BY>0</PARTITION_BY>
    <SOURCE_ENTITY_NAME>Cell</SOURCE_ENTITY_NAME><SOURCE_ENTITY_COLUMN_NAME>moid</SOURCE_ENTITY_COLUMN_NAME></EntityDef>
  </Components></EntityDef></Components>
<Components section="SUPPORTED_NODE_VERSIONS"><EntityDef name="L1"><MODEL_VERSION>1.2</MODEL_VERSION></EntityDef></Components>
<Components section="NODE_MO_STRUCTURE"><EntityDef name="r"><PARENT_MO_NAME>P</PARENT_MO_NAME><CHILD_MO_NAME>C</CHILD_MO_NAME>
 <CARDINALITY_MIN>0</CARDINALITY_MIN><CARDINALITY_MAX>None</CARDINALITY_MAX></EntityDef></Components>
<Components section="Flows"><EntityDef name="PM_X"><Components section="Actions">
 <EntityDef name="Collect"><WORKER_NAME>w</WORKER_NAME><REOCCURING>True</REOCCURING><ROP_INTERVAL>15</ROP_INTERVAL>
  <ROP_OFFSET>0</ROP_OFFSET><ENABLED>0</ENABLED><CONFIG_in>/data</CONFIG_in></EntityDef>
 <EntityDef name="Parse"><WORKER_NAME>p</WORKER_NAME><DEPENDENCY_FLOW_NAME>PM_X</DEPENDENCY_FLOW_NAME>
  <DEPENDENCY_ACTION_NAME>Collect</DEPENDENCY_ACTION_NAME><CONFIG_rowTag>mdc</CONFIG_rowTag><CONFIG_out>/o</CONFIG_out></EntityDef>
</Components></EntityDef></Components>
<Components section="DESIGNRULES"><EntityDef name="PM_X"><Components section="Rules">
 <EntityDef name="All"><MATCH_TYPE>ALL</MATCH_TYPE><Components section="Rules">
  <EntityDef name="Vector"><MATCH_TYPE>equals</MATCH_TYPE><MATCH_ARGUMENT>counterType</MATCH_ARGUMENT><MATCH_VALUE>PDF</MATCH_VALUE><TARGET>_V</TARGET></EntityDef>
  <EntityDef name="Rest"><MATCH_TYPE>startswith</MATCH_TYPE><MATCH_ARGUMENT>name</MATCH_ARGUMENT><MATCH_VALUE>pm</MATCH_VALUE></EntityDef>
 </Components></EntityDef></Components></EntityDef></Components>
<Components section="RETENTION_PLAN"><EntityDef name="SHORT"><RETENTION_PERIOD>7</RETENTION_PERIOD>
 <HOT_STORE_RETENTION_PERIOD>3</HOT_STORE_RETENTION_PERIOD></EntityDef></Components>
</EntityDef>"""


@pytest.fixture()
def pack(spark, tmp_path):
    (tmp_path / "p.xml").write_text(PACK)
    return models.catalog_from_model(NM.scan_model_rows(spark, str(tmp_path / "p.xml")))


def test_model_to_catalog(pack):
    assert rows(pack["techpack_versions"]) == [
        ("BASE_X_R1", "BASE_X", "R1", "BASE", "V", "T", "", "", "a < b", "", ["A", "B"])
    ]
    assert rows(pack["reportable_entity"]) == [("BASE_X_R1:COMMON", "BASE_X_R1", "COMMON", "BASE", "", "SHORT", "")]
    assert rows(pack["mo_table_mapping"]) == [("BASE_X_R1", "Cell", "COMMON")]
    columns = rows(pack["reportable_entity_columns"])
    assert columns[0] == (
        "BASE_X_R1", "BASE_X_R1:COMMON", "BASE_X_R1:COMMON:date_id", "date_id", 0, "key", "STRING", "", 1, "its",
    )
    assert columns[1][3:6] == ("moid", 1, "key")
    assert rows(pack["reportable_entity_column_source"])[1][3:] == ("Cell", "moid")
    assert rows(pack["supported_node_versions"]) == [("BASE_X_R1", "L1", "1.2", "")]
    assert rows(pack["node_mo_structure"]) == [("BASE_X_R1", "P", "C", 0, None)]
    assert rows(pack["retention_plan"]) == [("SHORT", 7, 3)]
    assert rows(pack["flow_scheduling"]) == [("BASE_X_R1", "PM_X", "Collect", "w", "True", 15, 0, 0)]
    assert rows(pack["flow_configuration"]) == [
        ("BASE_X_R1", "PM_X", "Collect", "w", "in=/data", "", ""),
        ("BASE_X_R1", "PM_X", "Parse", "p", "out=/o::rowTag=mdc", "PM_X", "Collect"),
    ]
    assert rows(pack["designrules"]) == [
        ("BASE_X_R1", "PM_X", "All", "BASE_X", 0, "ALL", "", "", ""),
        ("BASE_X_R1", "PM_X", "Rest", "All", 1, "startswith", "name", "pm", ""),
        ("BASE_X_R1", "PM_X", "Vector", "All", 0, "equals", "counterType", "PDF", "_V"),
    ]


def test_catalog_round_trip_and_joins(spark, pack, tmp_path):
    folder = str(tmp_path / "catalog")
    empty = {name: spark.createDataFrame([], ddl) for name, ddl in CATALOG.items() if name not in pack}
    write_catalog({**empty, **pack}, folder)
    stored = Catalog.from_parquet(spark, folder)
    assert rows(catalog.entity_columns(stored, "BASE_X_R1", "BASE").select("entity_column_name", "source_entity_column_name")) == [
        ("date_id", ""), ("moid", "moid"),
    ]
    assert rows(catalog.partition_columns(stored)) == [("COMMON", "date_id", 0)]
    assert rows(catalog.retention_locations(stored)) == [("COMMON", "COMMON_R1", "/BASE/X/R1/COMMON", 7, 3)]
    assert rows(catalog.tables_by_retention(stored)) == [(3, "COMMON")]
    assert rows(catalog.mapped_objects(stored)) == [("COMMON", "Cell")]
    assert catalog.entity_descriptor(catalog.entity_columns(stored), "COMMON") == {"key": {"date_id": "", "moid": "moid"}}


def test_model_rows_of_references(spark):
    document = (
        '<EntityDef name="M"><Components section="S"><EntityRef name="r" sourceName="self" sourceType="Node"'
        ' entityName="E" entityType="enumRef"/><EntityDef name="e"/></Components></EntityDef>'
    )
    got = rows(NM.model_rows(spark.createDataFrame([(document,)], "value string")).select("path", "section", "prop", "value"))
    assert ("M/S:r", "S", "entityType", "enumRef") in got
    assert ("M/S:e", "S", None, None) in got and ("M", None, None, None) in got


def test_upsert(spark):
    current = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(catalog.upsert(current, changes, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]


CLASS_MODEL = """<models><mim name="Foo_Bar_L17" version="1" release="9" revision="A2" date="d"><applicationTag>My Node L17B</applicationTag>
<enum name="E1"><enumMember name="A"><value>0</value></enumMember><enumMember name="B"><value>1</value></enumMember></enum>
<struct name="S1"><structMember name="m1"><dataType><enumRef name="E1"/></dataType></structMember></struct>
<class name="Cell"><attribute name="pmA"><description>x</description><counterType>PEG</counterType><dataType><long/></dataType></attribute>
<attribute name="pmV"><counterType>PDF</counterType><dataType><sequence><longlong><range><min>0</min></range></longlong><maxLength>4</maxLength></sequence></dataType></attribute>
<attribute name="e"><dataType><enumRef name="E1"><mimName>z</mimName></enumRef></dataType></attribute>
<attribute name="s"><dataType><structRef name="S1"/></dataType></attribute></class></mim>
<interMim><relationship name="R"><containment><parent><hasClass name="Node"><mimName>T</mimName></hasClass></parent>
<child><hasClass name="Cell"><mimName>T</mimName></hasClass><cardinality><min>0</min><max>12</max></cardinality></child></containment></relationship></interMim></models>"""


def test_class_model(spark, tmp_path):
    path = str(tmp_path / "m.xml")
    (tmp_path / "m.xml").write_text(CLASS_MODEL)
    header = NM.class_model_header(spark, path)
    assert rows(header) == [("Foo_Bar", "A2", "L17.1.9", "9", "d", "My Node L17B", "L17B")]
    attributes = NM.class_attributes(spark, path)
    assert rows(attributes) == [
        ("Cell", "e", None, None, None, "", "E1", None),
        ("Cell", "pmA", "long", "PEG", None, "x", None, None),
        ("Cell", "pmV", "longlong", "PDF", "4", "", None, None),
        ("Cell", "s", None, None, None, "", None, "S1"),
    ]
    resolved = models.resolve_references(attributes, NM.class_enums(spark, path), NM.class_structs(spark, path))
    assert rows(resolved.select("name", "member_type", "member", "nested_ref")) == [
        ("e", "enum", "A", None), ("e", "enum", "B", None), ("pmA", None, None, None), ("pmV", None, None, None),
        ("s", "struct", "m1", "E1"),
    ]
    edges = models.hierarchy_edges(NM.class_relationships(spark, path), "PM_X_A2")
    assert rows(edges) == [("PM_X_A2", "Node", "Cell", 0, 12)]
    assert rows(models.supported_node_versions(header, "PM_X_A2")) == [("PM_X_A2", "L17B", "L17.1.9", "My Node L17B")]
    base = spark.createDataFrame([("BASE_X", "V", "T", "p", "f", "l")], "techpack_version_id string, vendor string, technology string, product_number string, feature_name string, license string")
    pack = models.inherit_header(models.pack_header(header, "PM_X", "BASE_X"), base, "BASE_X")
    assert rows(pack) == [("PM_X_A2", "PM_X", "A2", "PM", "V", "T", "p", "f", "My Node L17B", "l", ["BASE_X"])]


INSTANCES = """<model><mib name="PmInstancesX" version="1" release="2">
<object parentDn="A=1,Pm=1"><slot name="pmGroupId"><value>Cell</value></slot></object>
<object parentDn="A=1,Pm=1,PmGroup=Cell"><slot name="measurementName"><value>pmA</value></slot>
 <slot name="measurementResult"><value>long</value></slot><slot name="collectionMethod"><value>CC</value></slot><slot name="empty"/></object>
<object parentDn="A=1,Pm=1,PmGroup=Lost"><slot name="measurementName"><value>pmB</value></slot></object></mib></model>"""


def test_instance_model(spark, tmp_path):
    (tmp_path / "i.xml").write_text(INSTANCES)
    header = NM.instance_model_header(spark, str(tmp_path / "i.xml"), "support")
    assert rows(header) == [("X", "1_2", "1_2", "2", "support")]
    attributes = NM.instance_attributes(NM.instance_objects(spark, str(tmp_path / "i.xml")))
    assert rows(attributes.select("mo_name", "name", "data_type", "counter_type", "declared")) == [
        ("Cell", "pmA", "long", "CC", True), ("Lost", "pmB", None, None, False),
    ]


ATTRIBUTES = [
    ("Cell-FDD", "pmB", "long", "PEG", None, ""),
    ("Cell-FDD", "pm.A-x", "longlong", "GAUGE", None, ""),
    ("Cell-FDD", "pmV", "long", "PDF", "12", "Compressed: True"),
    ("Cell-FDD", "pmW", "long", "PDF", "3", ""),
    ("Cell-FDD", "pmFlexC", "long", "PEG", None, ""),
    ("Cell-FDD", "other", "long", "PEG", None, ""),
]


def attributes(spark):
    return spark.createDataFrame(
        ATTRIBUTES, "mo_name string, name string, data_type string, counter_type string, max_length string, description string"
    )


@pytest.mark.parametrize("rules_in_plan", [0, routing.RULES_IN_PLAN])
def test_routing(spark, rules_in_plan):
    routed = routing.route_columns(attributes(spark), S.rules(spark), "BASE_X", rules_in_plan=rules_in_plan)
    got = rows(routed.select("table", "entity_column_name", "entity_column_order", "entity_data_type", "entity_counter_type"))
    assert got == [
        ("PM_X_CELL_FDD", "pm_a_x", 0, "BIGINT", "GAUGE"),
        ("PM_X_CELL_FDD", "pmb", 1, "BIGINT", "PEG"),
        ("PM_X_CELL_FDD_FLEX", "pmflexc", 0, "BIGINT", "PEG"),
        ("PM_X_CELL_FDD_V", "pmv", 0, "ARRAY<BIGINT>:12", "COMPRESSED_PDF"),
        ("PM_X_CELL_FDD_V", "pmw", 1, "ARRAY<BIGINT>:3", "PDF"),
    ]


@pytest.mark.parametrize("rules_in_plan", [0, routing.RULES_IN_PLAN])
def test_all_object_rules_apply_and_targets_rename(spark, rules_in_plan):
    rules = spark.createDataFrame(
        [
            ("P", "all", "B", 0, "ALL", None, None, None),
            ("P", "cells", "B", 1, "startswith", "name", "Cell", "special"),
            ("P", "never", "B", 2, "equals", "name", "Cell", ""),
            ("P", "unknown", "B", 3, "equals", "colour", "", ""),
            ("P", "any", "all", 0, "ALL", "", "", ""),
            ("P", "b", "cells", 0, "equals", "name", "pmB", "_b"),
            ("P", "any2", "never", 0, "ALL", "", "", ""),
            ("P", "any3", "unknown", 0, "ALL", "", "", ""),
        ],
        S.RULE_COLUMNS,
    )
    with pytest.warns(UserWarning, match="colour"):
        routed = routing.routed_attributes(attributes(spark), rules, "B", rules_in_plan)
    with pytest.raises(ValueError, match="colour"):
        routing.routed_attributes(attributes(spark), rules, "B", rules_in_plan, strict=True)
    assert rows(routed.groupBy("table").count()) == [("P_CELL_FDD", 6), ("P_SPECIAL_B", 1)]


def test_split_at_the_column_limit(spark):
    many = spark.range(10).select(
        F.lit("M").alias("mo_name"), F.format_string("pm%02d", "id").alias("name"), F.lit("long").alias("data_type"),
        F.lit("PEG").alias("counter_type"), F.lit("").alias("max_length"), F.lit("").alias("description"),
    )
    keys = S.base_keys(spark).filter("entity_column_order < 2")
    for limit, tables in ((6, {"PM_X_M_0", "PM_X_M_1", "PM_X_M_2"}), (12, {"PM_X_M"})):
        routed = dicts(routing.route_columns(many, S.rules(spark), "BASE_X", keys, limit))
        assert {r["table"] for r in routed} == tables
        for table in tables:
            mine = sorted((r["entity_column_order"], r["entity_column_name"], r["entity_column_type"]) for r in routed if r["table"] == table)
            assert [order for order, *_ in mine] == list(range(len(mine))) and len(mine) <= limit
            assert [kind for *_, kind in mine[:2]] == ["key", "key"]


def test_model_diff(spark):
    frame = lambda *r: spark.createDataFrame(r, "path string, section string, prop string, value string")
    old = frame(("a", None, "p", "1"), ("a", None, "q", None), ("a", "s", "r", "x"), ("b", None, "p", None))
    new = frame(("a", None, "p", "2"), ("a", None, "q", None), ("c", None, "p", "3"), ("b", None, "p", ""))
    diff = model_diff.model_diff(old, new, ["path", "section", "prop"])
    assert rows(diff.select("path", "prop", "old_value", "new_value", "change_type")) == [
        ("a", "p", "1", "2", "changed"), ("a", "q", None, None, "unchanged"), ("a", "r", "x", None, "removed"),
        ("b", "p", None, "", "changed"), ("c", "p", None, "3", "added"),
    ]
    assert model_diff.common_keys(diff).count() == 3


def test_kpi_document(spark, tmp_path):
    (tmp_path / "k.json").write_text(
        """{"source": "S", "kpi_definitions": [
        {"name": "rate", "alias": "a", "expression": "pm://T.x / pm://T.y", "object_type": "FLOAT", "aggregation_type": "SUM",
         "aggregation_period": 60, "aggregation_elements": ["ropendtime", "node"]},
        {"name": "cross", "alias": "a", "expression": "pm://T.x / pm://U.z", "object_type": "FLOAT", "aggregation_type": "SUM",
         "aggregation_period": 60, "aggregation_elements": ["ropendtime", "node"]}]}"""
    )
    kpis = kpi.read_kpis(scan_kpi_definitions(spark, str(tmp_path / "k.json")).orderBy("name"))
    time = lambda t: f"timestamp'2024-01-01 {t}:00'"
    t = spark.sql(
        f"SELECT * FROM VALUES ({time('10:15')}, 'n', 1, 2), ({time('10:30')}, 'n', 3, 2), ({time('11:00')}, 'n', 5, 0) AS t(ropendtime, node, x, y)"
    )
    u = spark.sql(f"SELECT * FROM VALUES ({time('10:45')}, 'n', 8), ({time('10:45')}, 'm', 9) AS u(ropendtime, node, z)")
    ((key, table),) = kpi.kpi_tables({"T": t, "U": u}, kpis).items()
    assert key == ("a", ("ropendtime", "node"), 60)
    got = {(r["ropendtime"].hour, r["node"]): (r["cross"], r["rate"]) for r in dicts(table)}
    # A zero divisor and a missing operand both give NULL.
    assert got == {(10, "n"): (0.5, 1.0), (11, "n"): (None, None), (10, "m"): (None, None)}


def test_kpi_refuses_what_it_cannot_compute():
    with pytest.raises(ValueError):
        kpi.parse_kpi("k", "pm://T.x / pm://T.y", ["node"], aggregation="AVG")
    with pytest.raises(ValueError):
        kpi.parse_kpi("k", "pm://T.x * 2", ["node"])
