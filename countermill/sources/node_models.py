"""Node model documents: class models, instance models and entity trees."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countermill.functions.counters import last_entries
from countermill.functions.text import last_value, last_word, unescape_xml, version_text

# Task code travels with its task, so workers need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

# Element names that stand for a data type.
DATA_TYPE_TAGS = ["long", "string", "longlong"]

# Slot names of an instance model and the property they hold.
SLOT_NAMES = ["pmGroupId", "measurementName"]
SLOT_PROPERTIES = {"measurementResult": "dataType", "collectionMethod": "counterType"}

MODEL_ROWS = (
    "model STRING, path STRING, parent_path STRING, section STRING, name STRING, entity_pos INT,"
    "prop_pos INT, prop STRING, value STRING"
)
MODEL_COLUMNS = [field.split()[0] for field in MODEL_ROWS.split(",")]


def _read(spark: SparkSession, paths: str | Sequence[str], tag: str, ddl: str) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", tag).schema(ddl)
    return reader.load(paths if isinstance(paths, str) else list(paths))


def _inner(markup: str, tag: str, attribute: str | None = None) -> Column:
    """Text or one attribute of the first ``tag`` inside raw markup, else NULL."""
    if attribute is None:
        pattern = rf"<{tag}\b[^>]*>([^<]*)</{tag}>"
    else:
        pattern = rf"<{tag}\b[^>]*?\b{attribute}=\"([^\"]*)\""
    return F.nullif(F.trim(F.regexp_extract(F.col(markup), pattern, 1)), F.lit(""))


def _data_type(markup: str) -> Column:
    pattern = rf"<({'|'.join(sorted(DATA_TYPE_TAGS, key=len, reverse=True))})\b"
    return F.nullif(F.regexp_extract(F.col(markup), pattern, 1), F.lit(""))


def class_model_header(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Name, version and application tag of each class model."""
    mim = _read(
        spark,
        paths,
        "mim",
        "_name STRING, _version STRING, _release STRING, _revision STRING, _date STRING, applicationTag STRING",
    )
    parts = F.split("_name", "_")
    return mim.select(
        F.array_join(F.slice(parts, 1, F.size(parts) - 1), "_").alias("model"),
        F.col("_revision").alias("revision"),
        version_text("_name", "_version", "_release").alias("version"),
        F.col("_release").alias("release"),
        F.col("_date").alias("date"),
        F.col("applicationTag").alias("application_tag"),
        last_word("applicationTag").alias("node_version"),
    )


def class_attributes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per attribute of a class, with the enum or struct it refers to."""
    classes = _read(
        spark,
        paths,
        "class",
        "_name STRING, attribute ARRAY<STRUCT<_name: STRING, description: STRING, counterType: STRING,"
        " maxLength: STRING, dataType: STRING>>",
    )
    attribute = classes.select(F.col("_name").alias("mo_name"), F.inline("attribute"))
    return attribute.select(
        "mo_name",
        F.col("_name").alias("name"),
        _data_type("dataType").alias("data_type"),
        F.col("counterType").alias("counter_type"),
        F.coalesce(F.col("maxLength"), _inner("dataType", "maxLength")).alias("max_length"),
        unescape_xml(F.trim("description")).alias("description"),
        _inner("dataType", "enumRef", "name").alias("enum_ref"),
        _inner("dataType", "structRef", "name").alias("struct_ref"),
    )


def class_enums(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per member of an enum."""
    enums = _read(spark, paths, "enum", "_name STRING, enumMember ARRAY<STRUCT<_name: STRING, value: STRING>>")
    members = enums.select(F.col("_name").alias("enum_name"), F.inline("enumMember"))
    return members.select("enum_name", F.col("_name").alias("member"), F.trim("value").alias("value"))


def class_structs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per member of a struct, with the enum or struct it refers to."""
    structs = _read(spark, paths, "struct", "_name STRING, structMember ARRAY<STRUCT<_name: STRING, dataType: STRING>>")
    members = structs.select(F.col("_name").alias("struct_name"), F.inline("structMember"))
    return members.select(
        "struct_name",
        F.col("_name").alias("member"),
        _data_type("dataType").alias("data_type"),
        _inner("dataType", "enumRef", "name").alias("enum_ref"),
        _inner("dataType", "structRef", "name").alias("struct_ref"),
    )


def class_relationships(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parent/child edges of the managed-object hierarchy with their cardinality."""
    side = "STRUCT<hasClass: STRUCT<_name: STRING>, cardinality: STRUCT<min: STRING, max: STRING>>"
    edges = _read(spark, paths, "relationship", f"_name STRING, containment STRUCT<parent: {side}, child: {side}>")
    return edges.select(
        F.col("_name").alias("name"),
        F.col("containment.parent.hasClass._name").alias("parent"),
        F.col("containment.child.hasClass._name").alias("child"),
        F.trim("containment.child.cardinality.min").try_cast("int").alias("cardinality_min"),
        F.trim("containment.child.cardinality.max").try_cast("int").alias("cardinality_max"),
    )


def instance_model_header(spark: SparkSession, paths: str | Sequence[str], description: str = "") -> DataFrame:
    """Name, version and description of each instance model."""
    mib = _read(spark, paths, "mib", "_name STRING, _version STRING, _release STRING")
    version = F.concat_ws("_", "_version", "_release")
    return mib.select(
        F.replace("_name", F.lit("PmInstances"), F.lit("")).alias("model"),
        version.alias("revision"),
        version.alias("version"),
        F.col("_release").alias("release"),
        F.lit(description).alias("description"),
    )


def instance_objects(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Objects of an instance model: parent, name, and their other slots as a map."""
    objects = _read(spark, paths, "object", "_parentDn STRING, slot ARRAY<STRUCT<_name: STRING, value: STRING>>")
    slots = F.filter("slot", lambda s: s["value"].isNotNull() & ~s["_name"].isin(SLOT_NAMES))
    names = F.filter("slot", lambda s: s["_name"].isin(SLOT_NAMES))

    def renamed(slot: Column) -> Column:
        name = slot["_name"]
        for old, new in SLOT_PROPERTIES.items():
            name = F.when(slot["_name"] == old, F.lit(new)).otherwise(name)
        return F.struct(name.alias("key"), F.trim(slot["value"]).alias("value"))

    return objects.select(
        F.col("_parentDn").alias("parent_dn"),
        F.trim(F.try_element_at(names, F.lit(-1))["value"]).alias("name"),
        F.map_from_entries(last_entries(F.transform(slots, renamed))).alias("properties"),
    )


def instance_attributes(objects: DataFrame, group_parent: str = "Pm=1") -> DataFrame:
    """Attributes of an instance model next to the measurement they belong to.

    Objects whose parent ends with ``group_parent`` are the measurements; every
    other object is an attribute of the measurement its parent names.
    """
    is_group = F.col("parent_dn").endswith(group_parent)
    groups = objects.filter(is_group).select(F.col("name").alias("mo_name")).distinct()
    attributes = objects.filter(~is_group).select(
        last_value("parent_dn").alias("mo_name"),
        "name",
        F.col("properties")["dataType"].alias("data_type"),
        F.col("properties")["counterType"].alias("counter_type"),
        F.col("properties")["maxLength"].alias("max_length"),
        F.coalesce(F.col("properties")["description"], F.lit("")).alias("description"),
    )
    return attributes.join(groups.withColumn("declared", F.lit(True)), "mo_name", "left").withColumn(
        "declared", F.coalesce("declared", F.lit(False))
    )


def _walk(text: str) -> Iterator[tuple]:
    """Rows of one entity-tree document. A path is ``root/section:name/...``."""
    root = ElementTree.fromstring(text)
    model = root.get("name")
    pending = [(root, None, None, model, 0)]
    while pending:
        node, parent, section, path, entity_pos = pending.pop()
        if node.tag == "EntityRef":
            properties = [(key, value) for key, value in node.attrib.items() if key != "name"]
        else:
            properties = [(child.tag, child.text) for child in node if child.tag != "Components"]
        for position, (prop, value) in enumerate(properties or [(None, None)]):
            yield model, path, parent, section, node.get("name"), entity_pos, position, prop, value
        for group in node.findall("Components"):
            section_name = group.get("section")
            for place, child in enumerate(group):
                pending.append((child, path, section_name, f"{path}/{section_name}:{child.get('name')}", place))


def _read_rows(documents: DataFrame, text: str) -> DataFrame:
    """Rows of all documents; one that cannot be read gives one row with ``error``."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for document in batch[text]:
                try:
                    found = [(*row, None) for row in _walk(document or "")]
                except ElementTree.ParseError as error:
                    found = [(None, None, None, None, None, 0, 0, None, document, str(error))]
                rows = pd.DataFrame(found, columns=[*MODEL_COLUMNS, "error"], dtype=object)
                yield rows.astype({"entity_pos": "int32", "prop_pos": "int32"})

    return documents.select(text).mapInPandas(walk, f"{MODEL_ROWS}, error STRING")


def model_rows(documents: DataFrame, text: str = "value") -> DataFrame:
    """Entity-tree documents, one per row, as property rows of any depth.

    The tree is recursive, which no declared schema can express; each document
    is walked by itself inside a task. Documents that cannot be read give no
    rows here, see :func:`unreadable_models`.
    """
    rows = _read_rows(documents, text).filter("error is null").drop("error")
    return rows.withColumn("value", F.when(F.col("prop").isNotNull(), unescape_xml("value")))


def unreadable_models(documents: DataFrame, text: str = "value") -> DataFrame:
    """(document, error) of entity-tree documents that are no well-formed XML, NULL ones too."""
    return _read_rows(documents, text).filter("error is not null").select(F.col("value").alias("document"), "error")


def scan_model_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Entity-tree files as property rows."""
    return model_rows(spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True))
