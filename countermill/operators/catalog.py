"""Joins over the metadata catalog.

Catalog tables are small, but nothing here forces a broadcast: Spark broadcasts
a side whose size it knows to be below ``autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countermill.functions.text import split_suffix_removed, store_path
from countermill.sources.stores import Catalog

ENTITY_KEYS = ["techpack_version_id", "reportable_entity_id"]


def entity_columns(catalog: Catalog, version: str | None = None, entity_type: str | None = None) -> DataFrame:
    """Entities with their columns and each column's source: J1, distinct."""
    entities = _entities(catalog, version, entity_type)
    columns = catalog["reportable_entity_columns"]
    sources = catalog["reportable_entity_column_source"].select(
        "entity_column_id", "source_entity_name", "source_entity_column_name"
    )
    return (
        entities.join(columns, ENTITY_KEYS)
        .join(sources, "entity_column_id")
        .select(
            "reportable_entity_name",
            "entity_column_name",
            "entity_column_order",
            "entity_column_type",
            "entity_data_type",
            "source_entity_name",
            "source_entity_column_name",
        )
        .distinct()
    )


def _entities(catalog: Catalog, version: str | None, entity_type: str | None) -> DataFrame:
    entities = catalog["reportable_entity"]
    if version is not None:
        entities = entities.filter(F.col("techpack_version_id") == version)
    if entity_type is not None:
        entities = entities.filter(F.col("entity_type") == entity_type)
    return entities


def partition_columns(catalog: Catalog, version: str | None = None, entity_type: str | None = None) -> DataFrame:
    """Entities with the columns they are partitioned by."""
    flagged = catalog["reportable_entity_columns"].filter(F.col("partition_by") == 1)
    return (
        _entities(catalog, version, entity_type)
        .join(flagged, ENTITY_KEYS)
        .select("reportable_entity_name", "entity_column_name", "entity_column_order")
        .distinct()
    )


def mapped_objects(catalog: Catalog, version: str | None = None) -> DataFrame:
    """Entities with the object class whose counters they hold."""
    return _entities(catalog, version, None).join(
        catalog["mo_table_mapping"], ["techpack_version_id", "reportable_entity_name"]
    ).select("reportable_entity_name", "mo_name")


def retention_locations(catalog: Catalog, name_like: str | None = None, version_like: str | None = None) -> DataFrame:
    """Entities with table name, cold folder and retention, filtered by LIKE patterns."""
    entities = catalog["reportable_entity"]
    if name_like is not None:
        entities = entities.filter(F.col("reportable_entity_name").like(name_like))
    if version_like is not None:
        entities = entities.filter(F.col("techpack_version_id").like(version_like))
    versions = catalog["techpack_versions"].select("techpack_version_id", "techpack_name", "techpack_release")
    plans = catalog["retention_plan"].withColumnRenamed("plan_name", "retention_plan")
    joined = entities.join(versions, "techpack_version_id").join(plans, "retention_plan")
    base = split_suffix_removed("reportable_entity_name")
    return joined.select(
        "reportable_entity_name",
        F.concat_ws("_", base, "techpack_release").alias("table_name"),
        store_path("techpack_name", "techpack_release", base).alias("location"),
        "retention_period",
        "hot_store_retention_period",
    )


def tables_by_retention(catalog: Catalog) -> DataFrame:
    """(hot_store_retention_period, table): which tables each period applies to.

    Long form: a list per period could hold any number of tables.
    """
    plans = catalog["retention_plan"].withColumnRenamed("plan_name", "retention_plan")
    return (
        catalog["reportable_entity"]
        .join(plans, "retention_plan")
        .select("hot_store_retention_period", F.col("reportable_entity_name").alias("table"))
        .distinct()
    )


def persistence_columns(catalog: Catalog, version_like: str) -> DataFrame:
    """Distinct column names of the stored entities of matching versions."""
    keys = [*ENTITY_KEYS]
    columns = catalog["reportable_entity_columns"].filter(F.col("techpack_version_id").like(version_like))
    return (
        catalog["reportable_entity"]
        .join(columns, keys)
        .select("reportable_entity_name", "entity_column_name", "entity_data_type")
        .distinct()
    )


def with_versions(df: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows whose version is among the given ones (IN subquery as a semi join)."""
    return df.join(versions.select("techpack_version_id"), "techpack_version_id", "left_semi")


def supported_versions(catalog: Catalog, pack: str) -> DataFrame:
    """Versions of a pack by name."""
    return catalog["techpack_versions"].filter(F.col("techpack_name") == pack).select("techpack_version_id").distinct()


def split_entities(catalog: Catalog) -> DataFrame:
    """Number of column splits per base entity name."""
    numbered = catalog["reportable_entity"].filter(F.col("reportable_entity_name").rlike(r"_\d+$"))
    base = split_suffix_removed("reportable_entity_name")
    return numbered.groupBy(base.alias("entity")).agg(F.count_distinct("reportable_entity_name").alias("splits"))


def column_groups(columns: DataFrame) -> DataFrame:
    """Per entity and column type the ordered ``name``/``source`` list.

    An entity has at most a table's column limit of them, so the lists are
    bounded; rows repeated in the catalog are removed first.
    """
    once = columns.select(
        "reportable_entity_name",
        "entity_column_type",
        F.struct(
            F.col("entity_column_order").alias("position"),
            F.col("entity_column_name").alias("name"),
            F.col("source_entity_column_name").alias("source"),
        ).alias("column"),
    ).distinct()
    ordered = F.array_sort(F.collect_list("column"))
    return once.groupBy("reportable_entity_name", "entity_column_type").agg(
        F.transform(ordered, lambda c: F.struct(c["name"].alias("name"), c["source"].alias("source"))).alias("columns")
    )


def entity_descriptor(columns: DataFrame, entity: str) -> dict[str, dict[str, str]]:
    """Column type -> {name: source} of one entity, for building its select list."""
    groups = column_groups(columns.filter(F.col("reportable_entity_name") == entity))
    return {
        row["entity_column_type"]: {c["name"]: c["source"] for c in row["columns"]} for row in groups.collect()
    }


def upsert(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows without those whose key changes, plus the changes."""
    return current.join(changes.select(*keys).distinct(), keys, "left_anti").unionByName(changes)
