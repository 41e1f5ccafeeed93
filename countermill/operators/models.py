"""Model documents turned into catalog tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countermill.functions.text import config_text
from countermill.session import durable, small_side

# Sections of a model document.
ENTITIES, COLUMNS = "REPORTABLE_ENTITIES", "REPORTABLE_ENTITIES_COLUMNS"
NODE_VERSIONS, STRUCTURE, RETENTION = "SUPPORTED_NODE_VERSIONS", "NODE_MO_STRUCTURE", "RETENTION_PLAN"
FLOWS, ACTIONS = "Flows", "Actions"
RULE_GROUPS, RULES = "DESIGNRULES", "Rules"
CONFIG_PREFIX = "CONFIG_"


def entity_properties(rows: DataFrame, properties: Sequence[str], section: str | None) -> DataFrame:
    """One row per entity of a section with the named properties as columns.

    A property written twice keeps its last value; a missing one is empty.
    """
    mine = rows.filter(F.col("section").isNull() if section is None else F.col("section") == section)

    def value(name: str) -> Column:
        return F.max_by("value", F.when(F.col("prop") == name, F.col("prop_pos")))

    entity = ["model", "path", "parent_path", "name"]
    if not properties:
        return mine.select(*entity).distinct()
    return mine.groupBy(*entity).agg(*[F.coalesce(value(p), F.lit("")).alias(p.lower()) for p in properties])


def _parents(entities: DataFrame, *columns: str) -> DataFrame:
    return entities.select(F.col("path").alias("parent_path"), *columns)


def _text(name: str) -> Column:
    return F.col(name)


def _number(name: str, kind: str = "int") -> Column:
    return F.col(name).try_cast(kind)


def _flow_actions(rows: DataFrame) -> DataFrame:
    flows = entity_properties(rows, [], FLOWS).select(
        F.col("path").alias("parent_path"), F.col("name").alias("flow_name")
    )
    actions = entity_properties(
        rows,
        [
            "WORKER_NAME",
            "REOCCURING",
            "ROP_INTERVAL",
            "ROP_OFFSET",
            "ENABLED",
            "DEPENDENCY_FLOW_NAME",
            "DEPENDENCY_ACTION_NAME",
        ],
        ACTIONS,
    )
    is_config = F.col("prop").startswith(CONFIG_PREFIX)
    settings = (
        rows.filter((F.col("section") == ACTIONS) & is_config)
        .groupBy("path", F.replace("prop", F.lit(CONFIG_PREFIX), F.lit("")).alias("key"))
        .agg(F.max_by("value", "prop_pos").alias("value"))
        .groupBy("path")
        .agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("settings"))
        .select("path", config_text("settings").alias("worker_config"))
    )
    return actions.join(flows, "parent_path").join(settings, "path", "left").withColumnRenamed("name", "action_name")


def _rules(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """Object rules under a package, attribute rules under an object rule, numbered from 0."""
    properties = ["MATCH_TYPE", "MATCH_ARGUMENT", "MATCH_VALUE", "TARGET"]
    rules = entity_properties(rows, properties, RULES)
    packages = entity_properties(rows, [], RULE_GROUPS).select(
        F.col("path").alias("package_path"), F.col("name").alias("target_package_name")
    )
    root = versions.select("model", "techpack_name")
    of_package = (
        rules.join(packages, rules["parent_path"] == packages["package_path"])
        .join(root, "model")
        .select(*rules.columns, "target_package_name", F.col("techpack_name").alias("parent_rule_name"))
    )
    owners = of_package.select(
        F.col("path").alias("parent_path"), "target_package_name", F.col("name").alias("parent_rule_name")
    )
    of_rule = rules.join(owners, "parent_path")
    order = rows.filter(F.col("section") == RULES).groupBy("path").agg(F.min("entity_pos").alias("execution_order"))
    return of_package.unionByName(of_rule).join(order, "path")


def catalog_from_model(rows: DataFrame) -> Mapping[str, DataFrame]:
    """Catalog tables of the models in ``rows`` (property rows of entity trees)."""
    versions = entity_properties(
        rows,
        [
            "TECHPACK_NAME",
            "TECHPACK_RELEASE",
            "TECHPACK_TYPE",
            "VENDOR",
            "TECHNOLOGY",
            "PRODUCT_NUMBER",
            "FEATURE_NAME",
            "DESCRIPTION",
            "LICENSE",
            "DEPENDENCY",
        ],
        None,
    )
    version_id = F.col("model").alias("techpack_version_id")
    entities = entity_properties(
        rows, ["ENTITY_TYPE", "PARTITION_PLAN", "RETENTION_PLAN", "DESCRIPTION", "MAPPED_MO"], ENTITIES
    ).withColumn("reportable_entity_id", F.concat_ws(":", "model", "name"))
    columns = entity_properties(
        rows,
        [
            "ENTITY_COLUMN_ORDER",
            "ENTITY_COLUMN_TYPE",
            "ENTITY_DATA_TYPE",
            "ENTITY_COUNTER_TYPE",
            "PARTITION_BY",
            "ENTITY_DESCRIPTION",
            "SOURCE_ENTITY_NAME",
            "SOURCE_ENTITY_COLUMN_NAME",
        ],
        COLUMNS,
    ).join(_parents(entities, "reportable_entity_id"), "parent_path")
    columns = columns.withColumn("entity_column_id", F.concat_ws(":", "reportable_entity_id", "name"))
    node_versions = entity_properties(rows, ["MODEL_VERSION", "DESCRIPTION"], NODE_VERSIONS)
    structure = entity_properties(
        rows, ["PARENT_MO_NAME", "CHILD_MO_NAME", "CARDINALITY_MIN", "CARDINALITY_MAX"], STRUCTURE
    )
    retention = entity_properties(rows, ["RETENTION_PERIOD", "HOT_STORE_RETENTION_PERIOD"], RETENTION)
    actions = _flow_actions(rows)
    rules = _rules(rows, versions)
    return {
        "techpack_versions": versions.select(
            version_id,
            "techpack_name",
            "techpack_release",
            "techpack_type",
            "vendor",
            "technology",
            "product_number",
            "feature_name",
            "description",
            "license",
            F.when(F.col("dependency") != "", F.split("dependency", ",")).alias("dependency"),
        ),
        "supported_node_versions": node_versions.select(
            version_id, F.col("name").alias("node_version"), "model_version", "description"
        ),
        "node_mo_structure": structure.select(
            version_id,
            "parent_mo_name",
            "child_mo_name",
            _number("cardinality_min").alias("cardinality_min"),
            _number("cardinality_max").alias("cardinality_max"),
        ),
        "mo_table_mapping": entities.filter(F.col("mapped_mo") != "").select(
            version_id, F.col("mapped_mo").alias("mo_name"), F.col("name").alias("reportable_entity_name")
        ),
        "retention_plan": retention.select(
            F.col("name").alias("plan_name"),
            _number("retention_period").alias("retention_period"),
            _number("hot_store_retention_period").alias("hot_store_retention_period"),
        ),
        "reportable_entity": entities.select(
            "reportable_entity_id",
            version_id,
            F.col("name").alias("reportable_entity_name"),
            "entity_type",
            "partition_plan",
            "retention_plan",
            "description",
        ),
        "reportable_entity_columns": columns.select(
            version_id,
            "reportable_entity_id",
            "entity_column_id",
            F.col("name").alias("entity_column_name"),
            _number("entity_column_order").alias("entity_column_order"),
            "entity_column_type",
            "entity_data_type",
            "entity_counter_type",
            _number("partition_by", "smallint").alias("partition_by"),
            F.replace("entity_description", F.lit("'"), F.lit("")).alias("entity_column_description"),
        ),
        "reportable_entity_column_source": columns.select(
            "entity_column_id", version_id, "reportable_entity_id", "source_entity_name", "source_entity_column_name"
        ),
        "flow_configuration": actions.select(
            version_id,
            "flow_name",
            "action_name",
            "worker_name",
            F.coalesce("worker_config", F.lit("")).alias("worker_config"),
            "dependency_flow_name",
            "dependency_action_name",
        ),
        "flow_scheduling": actions.filter(F.col("rop_interval") != "").select(
            version_id,
            "flow_name",
            "action_name",
            "worker_name",
            "reoccuring",
            _number("rop_interval").alias("rop_interval"),
            _number("rop_offset").alias("rop_offset"),
            _number("enabled").alias("enabled"),
        ),
        "designrules": rules.select(
            version_id,
            "target_package_name",
            F.col("name").alias("rule_name"),
            "parent_rule_name",
            F.col("execution_order").cast("int"),
            "match_type",
            "match_argument",
            "match_value",
            F.col("target").alias("target_name"),
        ),
    }


def resolve_references(attributes: DataFrame, enums: DataFrame, structs: DataFrame) -> DataFrame:
    """Attributes with the enum members or struct members they refer to.

    Columns ``member``, ``member_type`` (enum/struct) and ``nested_ref``, the
    enum or struct a struct member refers to in turn. Attributes without a
    reference, or with one that is not defined, keep one row of NULLs. Most have
    none: those are unioned aside, without a shuffle.
    """
    of_enum = enums.select(
        F.lit("enum").alias("member_type"), F.col("enum_name").alias("ref"), "member", F.lit(None).cast("string").alias("nested_ref")
    )
    of_struct = structs.select(
        F.lit("struct").alias("member_type"),
        F.col("struct_name").alias("ref"),
        "member",
        F.coalesce("enum_ref", "struct_ref").alias("nested_ref"),
    )
    reference = F.when(F.col("enum_ref").isNotNull(), F.lit("enum")).when(F.col("struct_ref").isNotNull(), F.lit("struct"))
    referring = attributes.withColumn("member_type", reference).withColumn("ref", F.coalesce("enum_ref", "struct_ref"))
    members = of_enum.unionByName(of_struct)
    found = referring.filter(F.col("ref").isNotNull()).join(members, ["member_type", "ref"], "left")
    return found.unionByName(referring.filter(F.col("ref").isNull()), allowMissingColumns=True)


def struct_closure(structs: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """Members that each struct has in the end, through structs in structs of any depth.

    ``structs`` is (struct_name, member, enum_ref, struct_ref); ``roots`` (struct_name) limits which
    structs are opened, a name without a definition included. Returns (root, path, depth, kind, ref):
    ``path`` joins the member names from the root with dots; kind is ``member``, ``enum``
    (``ref`` names it), ``undefined`` (``ref`` is no struct) or ``cycle`` (``ref`` is a
    struct that the path has passed already, which ends it).

    One join a level, over what the level before left open. A path passes a struct once, so the
    rounds end; each round is checkpointed, as the next one and the result read it. Known and
    undefined references take the same join, so a round has no more partitions than the one before.
    """
    members = durable(structs.select("struct_name", "member", "enum_ref", "struct_ref").distinct())
    start = (structs if roots is None else roots).select(F.col("struct_name").alias("root")).distinct()
    start = start.filter(F.col("root").isNotNull())
    nothing = F.array().cast("array<string>")
    open_paths = start.select("root", F.col("root").alias("open_ref"), nothing.alias("names"), F.array("root").alias("passed"))
    found = small_side(members.withColumnRenamed("struct_name", "open_ref").withColumn("_known", F.lit(True)))
    names = F.concat("names", F.array(F.coalesce("member", F.lit(""))))
    kind = (
        F.when(F.col("_known").isNull(), "undefined")
        .when(F.col("struct_ref").isNotNull() & F.array_contains("passed", F.col("struct_ref")), "cycle")
        .when(F.col("struct_ref").isNotNull(), "open")
        .when(F.col("enum_ref").isNotNull(), "enum")
        .otherwise("member")
    )
    known = F.col("_known").isNotNull()
    ref = F.when(known, F.coalesce("struct_ref", "enum_ref")).otherwise(F.col("open_ref"))
    closed = []
    while True:
        step = open_paths.join(found, "open_ref", "left")
        level = durable(
            step.select("root", F.when(known, names).otherwise(F.col("names")).alias("names"), "passed", kind.alias("kind"), ref.alias("ref"))
        )
        closed.append(level.filter("kind <> 'open'"))
        open_paths = level.filter("kind = 'open'").select(
            "root", F.col("ref").alias("open_ref"), "names", F.concat("passed", F.array("ref")).alias("passed")
        )
        if open_paths.isEmpty():
            break
    whole = reduce(DataFrame.unionByName, closed)
    return whole.select("root", F.array_join("names", ".").alias("path"), F.size("names").alias("depth"), "kind", "ref")


def resolve_nested(attributes: DataFrame, enums: DataFrame, structs: DataFrame) -> DataFrame:
    """Attributes with all members they refer to, through structs of any depth.

    As :func:`resolve_references`, with ``path`` and ``kind`` of :func:`struct_closure` for those
    of a struct; members of an enum have kind ``enum`` and their name as path. Members are sent to
    every executor as long as they are few (:func:`countermill.session.small_side`).
    """
    referring = attributes.withColumn("ref", F.coalesce("enum_ref", "struct_ref")).withColumn("_of_enum", F.col("enum_ref").isNotNull())
    roots = referring.filter(~F.col("_of_enum") & F.col("ref").isNotNull()).select(F.col("ref").alias("struct_name"))
    of_struct = struct_closure(structs, roots).select(F.lit(False).alias("_of_enum"), F.col("root").alias("ref"), "path", "kind", F.col("ref").alias("nested_ref"))
    of_enum = enums.select(
        F.lit(True).alias("_of_enum"), F.col("enum_name").alias("ref"), F.col("member").alias("path"), F.lit("enum").alias("kind"),
        F.lit(None).cast("string").alias("nested_ref"),
    )
    # A few references have many attributes each: dealt by reference, those would meet in a few tasks.
    members = small_side(durable(of_struct.unionByName(of_enum)))
    found = referring.filter(F.col("ref").isNotNull()).join(members, ["_of_enum", "ref"], "left")
    return found.unionByName(referring.filter(F.col("ref").isNull()), allowMissingColumns=True).drop("_of_enum")


def pack_header(header: DataFrame, package: str, base: str) -> DataFrame:
    """techpack_versions row of a package generated from a node model."""
    empty = F.lit("")
    return header.select(
        F.concat_ws("_", F.lit(package), "revision").alias("techpack_version_id"),
        F.lit(package).alias("techpack_name"),
        F.col("revision").alias("techpack_release"),
        F.lit("PM").alias("techpack_type"),
        empty.alias("vendor"),
        empty.alias("technology"),
        empty.alias("product_number"),
        empty.alias("feature_name"),
        F.col("application_tag").alias("description"),
        empty.alias("license"),
        F.array(F.lit(base)).alias("dependency"),
    )


def inherit_header(header: DataFrame, base_versions: DataFrame, base: str) -> DataFrame:
    """Take over vendor, technology, product, feature and license from the base pack."""
    inherited = ["vendor", "technology", "product_number", "feature_name", "license"]
    base_row = base_versions.filter(F.col("techpack_version_id") == base).select(
        F.col("techpack_version_id").alias("_base"), *inherited
    )
    rows = header.drop(*inherited).withColumn("_base", F.get("dependency", F.lit(0)))
    return rows.join(base_row, "_base", "left").select(*header.columns)


def supported_node_versions(header: DataFrame, version_id: str) -> DataFrame:
    """supported_node_versions row of a node model."""
    return header.select(
        F.lit(version_id).alias("techpack_version_id"),
        "node_version",
        F.col("version").alias("model_version"),
        F.col("application_tag").alias("description"),
    )


def hierarchy_edges(relationships: DataFrame, version_id: str) -> DataFrame:
    """node_mo_structure rows of a node model: relationships that name a parent."""
    return relationships.filter(F.col("parent").isNotNull()).select(
        F.lit(version_id).alias("techpack_version_id"),
        F.col("parent").alias("parent_mo_name"),
        F.col("child").alias("child_mo_name"),
        "cardinality_min",
        "cardinality_max",
    )
