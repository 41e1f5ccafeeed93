"""Counters routed to tables by rules, numbered, and split at the column limit."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from countermill.functions.text import column_name, table_name
from countermill.functions.types import counter_data_type
from countermill.operators.ordering import numbered
from countermill.schemas import TABLE_COLUMN_LIMIT

# Rules up to this number become one expression and need no join; more rules
# are matched with equi joins, same result.
RULES_IN_PLAN = 500

# Properties every attribute has, and the columns that hold them. Rules may name
# any other one that is a key of the map columns below.
OBJECT_PROPERTIES = {"name": "mo_name"}
ATTRIBUTE_PROPERTIES = {
    "name": "name",
    "dataType": "data_type",
    "counterType": "counter_type",
    "maxLength": "max_length",
    "description": "description",
}

OBJECT_MAP, ATTRIBUTE_MAP = "mo_properties", "properties"

TABLE_KEYS = ["target_package_name", "table"]


def _property(argument: str, properties: Mapping[str, str], more: str, columns: Sequence[str]) -> Column | None:
    """Value of a property, "" where a row has none; None without a column that could hold it.

    A rule on such a property matches nothing; :func:`unheld_properties` names them.
    """
    if argument in properties:
        return F.coalesce(F.col(properties[argument]), F.lit(""))
    if more in columns:
        return F.coalesce(F.try_element_at(F.col(more), F.lit(argument)), F.lit(""))
    return None


def match_rule(rule: Row, properties: Mapping[str, str], more: str = "", columns: Sequence[str] = ()) -> Column:
    """Condition of one rule: ALL, equals or startswith on a property; a NULL value is ""."""
    if rule["match_type"] == "ALL":
        return F.lit(True)
    if rule["match_type"] not in ("equals", "startswith"):
        return F.lit(False)
    value = _property(rule["match_argument"] or "", properties, more, columns)
    if value is None:
        return F.lit(False)
    wanted = F.lit(rule["match_value"] or "")
    return value == wanted if rule["match_type"] == "equals" else value.startswith(wanted)


def unheld_properties(rules: DataFrame, root: str, columns: Sequence[str]) -> list[str]:
    """Properties that a rule tests and no column of the attributes can hold.

    Only the distinct property names of the rules come to the driver.
    """
    tested = rules.filter(F.col("match_type").isin("equals", "startswith")).select(
        F.coalesce("match_argument", F.lit("")).alias("property"), (F.col("parent_rule_name") == root).alias("of_object")
    )

    def held(row: Row) -> bool:
        known, more = (OBJECT_PROPERTIES, OBJECT_MAP) if row["of_object"] else (ATTRIBUTE_PROPERTIES, ATTRIBUTE_MAP)
        return row["property"] in known or more in columns

    return sorted({row["property"] for row in tested.distinct().collect() if not held(row)})


def _table(package: Column, object_target: Column, attribute_target: Column) -> Column:
    base = F.when(F.coalesce(object_target, F.lit("")) != "", F.upper(object_target)).otherwise(F.upper("mo_name"))
    return table_name(F.concat(package, F.lit("_"), base, F.upper(F.coalesce(attribute_target, F.lit("")))))


def _routes_in_plan(attributes: DataFrame, rules: Sequence[Row], root: str) -> DataFrame:
    """Rules as one expression: every matching object rule, its first matching attribute rule."""
    ordered = sorted(rules, key=lambda r: (r["execution_order"], r["rule_name"]))

    def route(rule: Row, child: Row) -> Column:
        package = F.lit(rule["target_package_name"])
        return F.struct(
            package.alias("target_package_name"),
            _table(package, F.lit(rule["target_name"]), F.lit(child["target_name"])).alias("table"),
        )

    routes = []
    for rule in (r for r in ordered if r["parent_rule_name"] == root):
        children = [
            c
            for c in ordered
            if c["parent_rule_name"] == rule["rule_name"] and c["target_package_name"] == rule["target_package_name"]
        ]
        of_object = match_rule(rule, OBJECT_PROPERTIES, OBJECT_MAP, attributes.columns)
        cases = [
            (of_object & match_rule(c, ATTRIBUTE_PROPERTIES, ATTRIBUTE_MAP, attributes.columns), route(rule, c))
            for c in children
        ]
        if cases:
            routes.append(reduce(lambda w, case: w.when(*case), cases[1:], F.when(*cases[0])))
    if not routes:
        return attributes.limit(0).select("*", F.lit("").alias("target_package_name"), F.lit("").alias("table"))
    # Outer, so that no inferred filter evaluates all rules a second time.
    routed = attributes.select("*", F.inline_outer(F.array_compact(F.array(*routes))))
    return routed.filter(F.col("table").isNotNull())


def _probes(properties: Mapping[str, str], more: str, columns: Sequence[str], shapes: Sequence[Row]) -> Column:
    """All that rules of the given shapes could say about a row.

    A shape is (match_type, match_argument, length of the value); a row is probed
    with its whole property, or a prefix of that length.
    """

    def probe(kind: Column, argument: Column, value: Column) -> Column:
        return F.struct(kind.alias("match_type"), argument.alias("match_argument"), value.alias("match_value"))

    probes = {("ALL", "", 0): probe(F.lit("ALL"), F.lit(""), F.lit(""))}
    for kind, argument, length in shapes:
        value = _property(argument, properties, more, columns)
        if kind in ("equals", "startswith") and value is not None:
            if kind == "equals":
                probes[kind, argument, 0] = probe(F.lit(kind), F.lit(argument), value)
            else:
                prefix = F.when(F.length(value) >= length, F.substring(value, 1, length))
                probes[kind, argument, length] = probe(F.lit(kind), F.lit(argument), prefix)
    return F.array(*probes.values())


def _routes_by_join(attributes: DataFrame, rules: DataFrame, root: str) -> DataFrame:
    """The same routes for any number of rules: rows probe the rules by equality."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    everything = F.col("match_type") == "ALL"
    plain = rules.select(
        "target_package_name",
        "rule_name",
        "parent_rule_name",
        "execution_order",
        "match_type",
        F.when(everything, F.lit("")).otherwise(text("match_argument")).alias("match_argument"),
        F.when(everything, F.lit("")).otherwise(text("match_value")).alias("match_value"),
        text("target_name").alias("target_name"),
    )
    probe = ["match_type", "match_argument", "match_value"]
    # As many shapes as there are properties and different lengths of rule values.
    shape = F.col("match_type"), F.col("match_argument"), F.length("match_value")
    is_object = F.col("parent_rule_name") == root
    of_objects = plain.filter(is_object).select(*shape).distinct().collect()
    of_attributes = plain.filter(~F.coalesce(is_object, F.lit(False))).select(*shape).distinct().collect()
    objects = plain.filter(F.col("parent_rule_name") == root).select(
        *probe, "target_package_name", F.col("rule_name").alias("object_rule"), F.col("target_name").alias("object_target")
    )
    children = plain.select(
        *probe,
        "target_package_name",
        F.col("parent_rule_name").alias("object_rule"),
        "execution_order",
        "rule_name",
        F.col("target_name").alias("attribute_target"),
    )
    # Equal rows are kept apart by a number, so that each is routed for itself.
    columns = attributes.columns
    rows = attributes.select(F.monotonically_increasing_id().alias("_row"), "*")
    object_probes = _probes(OBJECT_PROPERTIES, OBJECT_MAP, columns, of_objects)
    by_object = rows.select("*", F.inline_outer(object_probes)).join(objects, probe).drop(*probe)
    attribute_probes = _probes(ATTRIBUTE_PROPERTIES, ATTRIBUTE_MAP, columns, of_attributes)
    by_attribute = (
        by_object.select("*", F.inline_outer(attribute_probes))
        .join(children, [*probe, "target_package_name", "object_rule"])
        .drop(*probe)
    )
    best = F.struct("attribute_target", F.struct(*columns).alias("own"))
    first = (
        by_attribute.groupBy("_row", "target_package_name", "object_rule", "object_target")
        .agg(F.min_by(best, F.struct("execution_order", "rule_name")).alias("best"))
        .select("target_package_name", "object_target", "best.attribute_target", "best.own.*")
    )
    return first.select(
        *attributes.columns,
        "target_package_name",
        _table(F.col("target_package_name"), F.col("object_target"), F.col("attribute_target")).alias("table"),
    )


def routed_attributes(
    attributes: DataFrame, rules: DataFrame, root: str, rules_in_plan: int = RULES_IN_PLAN, strict: bool = False
) -> DataFrame:
    """Attributes with the package and table each goes to; unmatched ones drop out.

    ``root`` is the parent name of the object rules. All object rules that match
    apply, and of each the first attribute rule that matches. A rule on a property that no
    column holds matches nothing: that is warned of, or with ``strict`` an error.
    """
    if unheld := unheld_properties(rules, root, attributes.columns):
        message = f"rules test properties that no column holds: {', '.join(unheld)}"
        if strict:
            raise ValueError(message)
        warnings.warn(message, stacklevel=2)
    few = rules.limit(rules_in_plan + 1).collect()
    if len(few) <= rules_in_plan:
        return _routes_in_plan(attributes, few, root)
    return _routes_by_join(attributes, rules, root)


def counter_columns(routed: DataFrame) -> DataFrame:
    """Catalog description of each routed counter, one row per table column.

    Two counters of one column name in one table: the later object class wins.
    """
    vector = F.col("counter_type") == "PDF"
    compressed = vector & F.coalesce(F.col("description"), F.lit("")).contains("Compressed: True")
    described = routed.select(
        *TABLE_KEYS,
        column_name("name").alias("entity_column_name"),
        F.struct(
            F.col("mo_name").alias("source_entity_name"),
            F.col("name").alias("source_entity_column_name"),
            counter_data_type("data_type", F.coalesce(vector, F.lit(False)), "max_length").alias("entity_data_type"),
            F.when(compressed, F.lit("COMPRESSED_PDF")).otherwise(F.col("counter_type")).alias("entity_counter_type"),
        ).alias("c"),
    )
    last = F.max_by("c", F.struct("c.source_entity_name", "c.source_entity_column_name"))
    return described.groupBy(*TABLE_KEYS, "entity_column_name").agg(last.alias("c")).select(
        *TABLE_KEYS, "entity_column_name", "c.*"
    )


def numbered_columns(columns: DataFrame, key_count: int, limit: int = TABLE_COLUMN_LIMIT) -> DataFrame:
    """Column order behind the keys, and ``<table>_<n>`` names where a table exceeds the limit."""
    capacity = limit - key_count
    counted = numbered(columns, TABLE_KEYS, ["entity_column_name"], "_number", "_total")
    part = F.floor(F.col("_number") / capacity).cast("string")
    split = F.col("_total") > capacity
    return counted.select(
        "target_package_name",
        F.when(split, F.concat_ws("_", "table", part)).otherwise(F.col("table")).alias("table"),
        "entity_column_name",
        (F.lit(key_count) + F.pmod(F.col("_number"), F.lit(capacity))).cast("int").alias("entity_column_order"),
        "source_entity_name",
        "source_entity_column_name",
        "entity_data_type",
        "entity_counter_type",
    )


def key_columns(columns: DataFrame, keys: Sequence[Row]) -> DataFrame:
    """The package's key columns for every table (``keys``: name, data type, in order)."""
    attached = F.array(
        *[
            F.struct(
                F.lit(key["entity_column_name"]).alias("entity_column_name"),
                F.lit(i).alias("entity_column_order"),
                F.lit(key["entity_data_type"]).alias("entity_data_type"),
                F.lit(key["entity_counter_type"]).alias("entity_counter_type"),
            )
            for i, key in enumerate(keys)
        ]
    )
    return columns.select("target_package_name", "table").distinct().select("*", F.inline(attached))


def route_columns(
    attributes: DataFrame,
    rules: DataFrame,
    root: str,
    keys: DataFrame | None = None,
    limit: int = TABLE_COLUMN_LIMIT,
    rules_in_plan: int = RULES_IN_PLAN,
) -> DataFrame:
    """All columns of all tables: keys first, then counters by name.

    ``keys`` lists the key columns of every table (entity_column_name,
    entity_column_order, entity_data_type, entity_counter_type).
    """
    key_rows = [] if keys is None else keys.orderBy("entity_column_order").limit(limit).collect()
    if len(key_rows) >= limit:
        raise ValueError(f"{len(key_rows)} key columns leave no room in a table of {limit} columns")
    counters = numbered_columns(
        counter_columns(routed_attributes(attributes, rules, root, rules_in_plan)), len(key_rows), limit
    ).withColumn("entity_column_type", F.lit("counter"))
    if not key_rows:
        return counters
    attached = key_columns(counters, key_rows).withColumn("entity_column_type", F.lit("key"))
    return counters.unionByName(attached, allowMissingColumns=True)
