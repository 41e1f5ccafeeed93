"""Models to catalog tables in one pass: all tables as one tagged row stream.

:func:`countermill.operators.models.catalog_from_model` makes each table by itself and so reads the model
documents once for each. Here an entity becomes one row with its properties as a map, knows its
parent and grandparent, and gives rows of the tables it belongs to; the stream of
(table, values) is written once, in a folder for each table.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countermill.functions.counters import last_entries
from countermill.functions.text import config_text
from countermill.operators.models import (
    ACTIONS,
    COLUMNS,
    CONFIG_PREFIX,
    ENTITIES,
    FLOWS,
    NODE_VERSIONS,
    RETENTION,
    RULE_GROUPS,
    RULES,
    STRUCTURE,
)
from countermill.schemas import CATALOG
from countermill.session import durable

# Catalog tables that a model fills.
MODEL_TABLES = [
    "techpack_versions",
    "supported_node_versions",
    "node_mo_structure",
    "mo_table_mapping",
    "retention_plan",
    "reportable_entity",
    "reportable_entity_columns",
    "reportable_entity_column_source",
    "flow_configuration",
    "flow_scheduling",
    "designrules",
]

TAGGED = "values MAP<STRING, STRING>, table STRING"


def model_entities(rows: DataFrame) -> DataFrame:
    """One row per entity of property rows: place, properties as a map, and what is above it.

    A property written twice keeps its last value. The entity above is found by its path, in
    the checkpointed entities: the documents are read once.
    """
    entry = F.struct("prop_pos", F.col("prop").alias("key"), "value")
    entities = rows.groupBy("model", "path", "parent_path", "section", "name").agg(
        F.min("entity_pos").alias("place"), F.array_sort(F.collect_list(F.when(F.col("prop").isNotNull(), entry))).alias("entries")
    )
    pairs = F.transform("entries", lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    entities = entities.select(
        "model", "path", "parent_path", "section", "name", "place", F.map_from_entries(last_entries(pairs)).alias("p")
    )
    entities = durable(entities)
    above = entities.select(
        F.col("path").alias("parent_path"), F.col("parent_path").alias("grand_path"), F.col("section").alias("parent_section"),
        F.col("name").alias("parent_name"),
    )
    grand = above.select(
        F.col("parent_path").alias("grand_path"), F.col("parent_section").alias("grand_section"), F.col("parent_name").alias("grand_name")
    )
    roots = entities.filter("section IS NULL").select("model", _property("TECHPACK_NAME").alias("pack"))
    return entities.join(above, "parent_path", "left").join(grand, "grand_path", "left").join(roots, "model", "left")


def _property(name: str) -> Column:
    return F.coalesce(F.try_element_at(F.col("p"), F.lit(name)), F.lit(""))


def _row(table: str, when: Column, values: Mapping[str, Column | str]) -> Column:
    """A tagged row where ``when`` holds; values are columns or names of properties."""
    pairs = [x for k, v in values.items() for x in (F.lit(k), _property(v) if isinstance(v, str) else v)]
    return F.when(when, F.struct(F.lit(table).alias("table"), F.create_map(*pairs).alias("values")))


def tagged_rows(rows: DataFrame) -> DataFrame:
    """(table, values) of all catalog tables, from property rows of entity trees."""
    section, name = F.col("section"), F.col("name")
    version = {"techpack_version_id": F.col("model")}
    entity_id = F.concat_ws(":", "model", "name")
    owner_id = F.concat_ws(":", "model", "parent_name")
    of_entity = (section == COLUMNS) & (F.col("parent_section") == ENTITIES)
    action = (section == ACTIONS) & (F.col("parent_section") == FLOWS)
    settings = F.transform_keys(
        F.map_filter("p", lambda k, _: k.startswith(CONFIG_PREFIX)), lambda k, _: F.replace(k, F.lit(CONFIG_PREFIX), F.lit(""))
    )
    column_id = F.concat_ws(":", owner_id, "name")
    of_package = (section == RULES) & (F.col("parent_section") == RULE_GROUPS) & F.col("pack").isNotNull()
    of_rule = (section == RULES) & (F.col("parent_section") == RULES) & (F.col("grand_section") == RULE_GROUPS) & F.col("pack").isNotNull()
    step = {**version, "flow_name": F.col("parent_name"), "action_name": name, "worker_name": "WORKER_NAME"}

    def rule(package: str, parent: str, when: Column) -> Column:
        return _row(
            "designrules",
            when,
            {
                **version, "target_package_name": F.col(package), "rule_name": name, "parent_rule_name": F.col(parent),
                "execution_order": F.col("place").cast("string"), "match_type": "MATCH_TYPE", "match_argument": "MATCH_ARGUMENT",
                "match_value": "MATCH_VALUE", "target_name": "TARGET",
            },
        )

    made = [
        _row(
            "techpack_versions",
            section.isNull(),
            {
                **version, "techpack_name": "TECHPACK_NAME", "techpack_release": "TECHPACK_RELEASE", "techpack_type": "TECHPACK_TYPE",
                "vendor": "VENDOR", "technology": "TECHNOLOGY", "product_number": "PRODUCT_NUMBER", "feature_name": "FEATURE_NAME",
                "description": "DESCRIPTION", "license": "LICENSE", "dependency": "DEPENDENCY",
            },
        ),
        _row(
            "supported_node_versions",
            section == NODE_VERSIONS,
            {**version, "node_version": name, "model_version": "MODEL_VERSION", "description": "DESCRIPTION"},
        ),
        _row(
            "node_mo_structure",
            section == STRUCTURE,
            {
                **version, "parent_mo_name": "PARENT_MO_NAME", "child_mo_name": "CHILD_MO_NAME",
                "cardinality_min": "CARDINALITY_MIN", "cardinality_max": "CARDINALITY_MAX",
            },
        ),
        _row(
            "mo_table_mapping",
            (section == ENTITIES) & (_property("MAPPED_MO") != ""),
            {**version, "mo_name": "MAPPED_MO", "reportable_entity_name": name},
        ),
        _row(
            "retention_plan",
            section == RETENTION,
            {"plan_name": name, "retention_period": "RETENTION_PERIOD", "hot_store_retention_period": "HOT_STORE_RETENTION_PERIOD"},
        ),
        _row(
            "reportable_entity",
            section == ENTITIES,
            {
                **version, "reportable_entity_id": entity_id, "reportable_entity_name": name, "entity_type": "ENTITY_TYPE",
                "partition_plan": "PARTITION_PLAN", "retention_plan": "RETENTION_PLAN", "description": "DESCRIPTION",
            },
        ),
        _row(
            "reportable_entity_columns",
            of_entity,
            {
                **version, "reportable_entity_id": owner_id, "entity_column_id": column_id, "entity_column_name": name,
                "entity_column_order": "ENTITY_COLUMN_ORDER", "entity_column_type": "ENTITY_COLUMN_TYPE",
                "entity_data_type": "ENTITY_DATA_TYPE", "entity_counter_type": "ENTITY_COUNTER_TYPE", "partition_by": "PARTITION_BY",
                "entity_column_description": F.replace(_property("ENTITY_DESCRIPTION"), F.lit("'"), F.lit("")),
            },
        ),
        _row(
            "reportable_entity_column_source",
            of_entity,
            {
                **version, "reportable_entity_id": owner_id, "entity_column_id": column_id,
                "source_entity_name": "SOURCE_ENTITY_NAME", "source_entity_column_name": "SOURCE_ENTITY_COLUMN_NAME",
            },
        ),
        _row(
            "flow_configuration",
            action,
            {
                **step, "worker_config": F.coalesce(config_text(settings), F.lit("")),
                "dependency_flow_name": "DEPENDENCY_FLOW_NAME", "dependency_action_name": "DEPENDENCY_ACTION_NAME",
            },
        ),
        _row(
            "flow_scheduling",
            action & (_property("ROP_INTERVAL") != ""),
            {**step, "reoccuring": "REOCCURING", "rop_interval": "ROP_INTERVAL", "rop_offset": "ROP_OFFSET", "enabled": "ENABLED"},
        ),
        rule("parent_name", "pack", of_package),
        rule("grand_name", "parent_name", of_rule),
    ]
    return model_entities(rows).select(F.inline(F.array_compact(F.array(*made))))


def write_model_catalog(rows: DataFrame, folder: str) -> dict[str, int]:
    """Write all catalog tables of the models in ``rows`` below ``folder``, in one job.

    Returns the rows of each table, counted while they are written.
    """
    seen = Observation()
    counts = [F.count_if(F.col("table") == t).alias(t) for t in MODEL_TABLES]
    tagged = tagged_rows(rows).observe(seen, *counts)
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("table").parquet(folder)
    return dict(seen.get)


def _typed(field: T.StructField) -> Column:
    value = F.try_element_at(F.col("values"), F.lit(field.name))
    if isinstance(field.dataType, T.ArrayType):
        return F.when(value != "", F.split(value, ",")).alias(field.name)
    return value.try_cast(field.dataType).alias(field.name)


def read_model_catalog(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables :func:`write_model_catalog` wrote, with their declared columns."""
    tagged = spark.read.schema(TAGGED).parquet(folder)
    return {
        table: tagged.filter(F.col("table") == table).select(*[_typed(f) for f in T.StructType.fromDDL(CATALOG[table])])
        for table in MODEL_TABLES
    }


def catalog_text(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, row) of all tables: columns in their order as text, joined by ``|``, NULL as ``~``."""

    def text(table: str, df: DataFrame) -> DataFrame:
        cells = [
            F.array_join(f.name, ",") if isinstance(f.dataType, T.ArrayType) else F.col(f.name).cast("string") for f in df.schema
        ]
        return df.select(F.lit(table).alias("table"), F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in cells]).alias("row"))

    return reduce(DataFrame.unionByName, [text(table, df) for table, df in tables.items()])
