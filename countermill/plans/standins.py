"""The driver tables in the shape of counter data.

The tables hold no counter files, so each query derives its input from them:
``events`` becomes counter rows, counter documents and logs, the star tables
become catalogs, backlogs and models. Everything is derived by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countermill.functions.text import escape_xml, last_value, rdn_class
from countermill.operators.ordering import with_blocks
from countermill.sources.stores import Catalog

COUNTERS = ["click", "error", "purchase", "signup", "view"]

# Keys of the stand-in long table; utc and local time equal ropendtime there.
STANDIN_KEYS = ["date_id", "granularity", "moid", "nedn", "node", "ropendtime"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scaled(value: str | Column = "value") -> Column:
    """A double as whole hundredths, so sums are exact."""
    return F.floor(F.col(value) * 100 if isinstance(value, str) else value * 100).cast("bigint")


def _object() -> Column:
    return F.concat(F.lit("ManagedElement=1,Cell"), (F.col("user_id") % 5).cast("string"), F.lit("="), F.col("user_id"))


def pm_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long counter rows: a user is a node, an event type a counter, a quarter hour a period."""
    events = table(spark, sf_dir, "events")
    rows = events.select(
        F.window("ts", "15 minutes")["start"].alias("ropendtime"),
        F.date_format("ts", "yyyyMMdd").alias("date_id"),
        F.concat(F.lit("SubNetwork=S,MeContext="), F.col("user_id")).alias("nedn"),
        F.lit("900").alias("granularity"),
        _object().alias("moid"),
        F.col("event_type").alias("counter_name"),
        scaled().alias("counter_value"),
        "event_id",
    )
    return rows.withColumn("node", last_value("nedn")).withColumn("measurement", rdn_class("moid"))


def _periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and period the counter names in order, and every event in its order.

    A document holds all that its user did in a period, so this is as long as
    the document.
    """
    events = table(spark, sf_dir, "events").withColumn("start", F.window("ts", "15 minutes")["start"])
    entry = F.struct("event_id", F.col("event_type").alias("name"), scaled().alias("value"))
    return events.groupBy("user_id", "start").agg(
        F.array_sort(F.collect_set("event_type")).alias("names"), F.array_sort(F.collect_list(entry)).alias("entries")
    )


def _results(index_base: int) -> Column:
    """Result elements, one for each event; a repeated counter has several."""

    def element(entry: Column) -> Column:
        place = F.array_position("names", entry["name"]).cast("int") - 1 + index_base
        return F.format_string('<r p="%d">%d</r>', place, entry["value"])

    return F.array_join(F.transform("entries", element), "")


def mdc_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, value): one ``mdc`` document per user and period."""
    names = F.array_join(F.transform("names", lambda n: F.concat(F.lit("<mt>"), n, F.lit("</mt>"))), "")
    document = F.concat(
        F.lit("<mdc><mfh><sn>SubNetwork=S,MeContext="),
        F.col("user_id"),
        F.lit("</sn></mfh><md><mi><mts>"),
        F.date_format("start", "yyyyMMddHHmmss"),
        F.lit("Z</mts><gp>900</gp>"),
        names,
        F.lit("<mv><moid>"),
        _object(),
        F.lit("</moid>"),
        _results(0),
        F.lit("</mv></mi></md></mdc>"),
    )
    file = F.concat_ws("/", "user_id", F.date_format("start", "yyyyMMddHHmm"))
    return _periods(spark, sf_dir).select(file.alias("file"), document.alias("value"))


def measdata_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, value): one ``measData`` document per user and period, counted from 1."""
    names = F.array_join(
        F.transform("names", lambda n, i: F.format_string('<measType p="%d">%s</measType>', i + 1, n)), ""
    )
    document = F.concat(
        F.lit('<measData><managedElement localDn="'),
        F.col("user_id"),
        F.lit('"><measInfo measInfoId="Session"><granPeriod duration="PT900S" endTime="'),
        F.date_format("start", "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit('Z"/>'),
        names,
        F.lit('<measValue measObjLdn="'),
        _object(),
        F.lit('">'),
        _results(1),
        F.lit("</measValue></measInfo></managedElement></measData>"),
    )
    file = F.concat_ws("/", "user_id", F.date_format("start", "yyyyMMddHHmm"))
    return _periods(spark, sf_dir).select(file.alias("file"), document.alias("value"))


def application_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one log per user; a signup opens a record, other events continue it."""
    events = table(spark, sf_dir, "events")
    header = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" [t"), F.col("user_id"), F.lit("] INFO Session - opened "), F.col("event_id")
    )
    more = F.concat(F.lit("  at "), F.col("event_type"), F.lit(" "), F.col("event_id"))
    lines = events.select(
        F.col("user_id").cast("string").alias("source_file"),
        F.when(F.col("event_type") == "signup", header).otherwise(more).alias("line"),
        "event_id",
    )
    return with_blocks(lines, "event_id").drop("event_id")


def replication_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one replication log per day.

    A signup exports the user, a view imports it, an error removes it; a click is
    an import error and a purchase line ends with an id.
    """
    events = table(spark, sf_dir, "events")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    number = F.floor("value").cast("string")
    user, kind = F.concat(F.lit("n"), F.col("user_id")), F.concat(F.lit("k"), F.col("user_id") % 3)
    cuid = F.concat(F.lit("c"), F.col("user_id"))
    head = F.concat(F.lit(" SI_CUID: "), cuid, F.lit(", "))
    tail = F.concat(F.lit("SI_NAME: "), user, F.lit(", SI_KIND: "), kind)
    si_id = F.concat(F.lit("SI_ID: "), number, F.lit(", "))
    text = (
        F.when(F.col("event_type") == "signup", F.concat(F.lit(" INFO x: Exported"), head, si_id, tail))
        .when(F.col("event_type") == "view", F.concat(F.lit(" INFO x: Imported"), head, si_id, tail))
        .when(F.col("event_type") == "error", F.concat(F.lit(" INFO x: Removing"), head, tail))
        .when(F.col("event_type") == "click", F.concat(F.lit(" ERROR x: Import Error: message "), F.col("event_id")))
        .otherwise(F.concat(F.lit(" ERROR x: id: "), number))
    )
    lines = events.select(
        F.date_format("ts", "yyyyMMdd").alias("source_file"), F.concat(stamp, text).alias("line"), "event_id"
    )
    return with_blocks(lines, "event_id").drop("event_id")


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """Nations as pack versions, regions as retention plans, suppliers as entities.

    The parts a supplier delivers by line number are its columns.
    """
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    supplier, lineitem = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "lineitem")
    versions = nation.select(
        F.col("n_name").alias("techpack_version_id"),
        F.concat(F.lit("PM_X_"), F.col("n_regionkey")).alias("techpack_name"),
        F.concat(F.lit("R"), F.col("n_nationkey")).alias("techpack_release"),
        F.lit("PM").alias("techpack_type"),
    )
    plans = region.select(
        F.col("r_name").alias("plan_name"),
        ((F.col("r_regionkey") + 1) * 7).alias("retention_period"),
        (F.col("r_regionkey") + 3).alias("hot_store_retention_period"),
    )
    homes = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    owned = supplier.join(homes, F.col("s_nationkey") == F.col("n_nationkey"))
    entity_id = F.concat_ws(":", "n_name", "s_name")
    entities = owned.select(
        entity_id.alias("reportable_entity_id"),
        F.col("n_name").alias("techpack_version_id"),
        F.concat(F.lit("E"), F.col("s_suppkey"), F.when(F.col("s_acctbal") < 0, "_1").otherwise("")).alias(
            "reportable_entity_name"
        ),
        F.lit("RAW").alias("entity_type"),
        F.col("r_name").alias("retention_plan"),
    )
    lines = lineitem.select("l_suppkey", "l_linenumber").distinct()
    described = lines.join(owned.select("s_suppkey", "n_name", entity_id.alias("eid")), F.col("l_suppkey") == F.col("s_suppkey"))
    name = F.concat(F.lit("pm"), F.col("l_linenumber"))
    columns = described.select(
        F.col("n_name").alias("techpack_version_id"),
        F.col("eid").alias("reportable_entity_id"),
        F.concat_ws(":", "eid", name).alias("entity_column_id"),
        name.alias("entity_column_name"),
        F.col("l_linenumber").alias("entity_column_order"),
        F.when(F.col("l_linenumber") <= 2, "key").otherwise("counter").alias("entity_column_type"),
        F.when(F.col("l_linenumber") == 1, "STRING").when(F.col("l_linenumber") == 7, "ARRAY<BIGINT>:16").otherwise("DOUBLE").alias("entity_data_type"),
        F.when(F.col("l_linenumber") == 1, 1).otherwise(0).alias("partition_by"),
    )
    sources = columns.select(
        "entity_column_id",
        F.lit("Cell").alias("source_entity_name"),
        F.concat(F.lit("src_"), F.col("entity_column_name")).alias("source_entity_column_name"),
    )
    return Catalog(
        {
            "techpack_versions": versions,
            "retention_plan": plans,
            "reportable_entity": entities,
            "reportable_entity_columns": columns,
            "reportable_entity_column_source": sources,
        }
    )


def version_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, version, column, type): order years as versions, priorities as entities."""
    orders = table(spark, sf_dir, "orders")
    version = F.concat(F.lit("v"), F.year("o_orderdate"))
    return orders.select(
        F.col("o_orderpriority").alias("entity"),
        version.alias("version"),
        F.col("o_orderstatus").alias("column"),
        F.when(F.year("o_orderdate") % 4 == 0, "BIGINT")
        .when(F.year("o_orderdate") % 4 == 1, "INT")
        .when((F.year("o_orderdate") % 4 == 2) & (F.col("o_orderstatus") == "P"), "VARCHAR")
        .when(F.col("o_orderpriority") == "5-LOW", "MISSING")
        .otherwise("DOUBLE")
        .alias("type"),
    ).distinct()


# Type names a catalog may hold: plain, sized, repeated in other words, arrays, times, missing.
CATALOG_TYPES = [
    "INT", "BIGINT", "FLOAT", "VARCHAR(10)", "CHAR(4)", "STRING", "TIMESTAMP", "MISSING",
    "ARRAY<INT>:8", "ARRAY<BIGINT>:16", "ARRAY<FLOAT>", "ARRAY<CHAR(2)>:4", "TINYINT", "DOUBLE",
]


def part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, version, column, type): parts as columns of few versions with types of all kinds."""
    place = F.pmod(F.col("p_partkey") * 7 + F.col("p_size"), F.lit(len(CATALOG_TYPES))).cast("int")
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("entity"),
        F.concat(F.lit("v"), F.col("p_partkey") % 3).alias("version"),
        F.concat(F.lit("c"), F.col("p_partkey") % 97).alias("column"),
        F.get(F.array(*[F.lit(t) for t in CATALOG_TYPES]), place).alias("type"),
    )


def backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as backlog rows: finished lines are processed files, open ones wait."""
    return table(spark, sf_dir, "lineitem").select(
        _path("l_orderkey").alias("path"),
        F.when(F.col("l_linestatus") == "F", F.lit("Parsed")).alias("status"),
        F.col("l_shipdate").cast("timestamp").alias("received_date"),
        F.lit(None).cast("timestamp").alias("processed_date"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that are not pending as the files found in the folder."""
    return table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P").select(_path("o_orderkey").alias("path"))


def _path(key: str) -> Column:
    return F.concat(F.lit("/in/"), F.col(key), F.lit(".xml"))


def order_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One backlog row per order: finished ones are parsed, the others wait."""
    return table(spark, sf_dir, "orders").select(
        _path("o_orderkey").alias("path"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Parsed")).alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("received_date"),
        F.lit(None).cast("timestamp").alias("processed_date"),
    )


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as counters of their brand's object class."""
    part = table(spark, sf_dir, "part")
    prefix = F.when(F.col("p_size") % 5 == 0, "pmFlex").when(F.col("p_size") % 7 == 0, "other").otherwise("pm")
    return part.select(
        F.replace("p_brand", F.lit("#"), F.lit("-")).alias("mo_name"),
        F.concat(prefix, F.lit("."), F.replace("p_name", F.lit(" "), F.lit("-")), F.col("p_partkey")).alias("name"),
        F.when(F.col("p_type") == "ECONOMY", "longlong").otherwise("long").alias("data_type"),
        F.when(F.col("p_type") == "PROMO", "PDF").otherwise("PEG").alias("counter_type"),
        F.col("p_size").cast("string").alias("max_length"),
        F.when(F.col("p_size") > 25, "Compressed: True").otherwise("").alias("description"),
    )


# The rule set of a radio pack in the shape of the catalog table.
RULE_COLUMNS = (
    "target_package_name string, rule_name string, parent_rule_name string, execution_order int,"
    "match_type string, match_argument string, match_value string, target_name string"
)
RULE_ROWS = [
    ("PM_X", "RuleForAllMOs", "BASE_X", 0, "ALL", "", "", ""),
    ("PM_X", "Vector", "RuleForAllMOs", 0, "equals", "counterType", "PDF", "_V"),
    ("PM_X", "Flex", "RuleForAllMOs", 1, "startswith", "name", "pmFlex", "_FLEX"),
    ("PM_X", "Gauge/Peg", "RuleForAllMOs", 2, "startswith", "name", "pm", ""),
]


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULE_ROWS, RULE_COLUMNS)


# Key columns of every entity table with their types.
KEY_ROWS = [
    ("date_id", 0, "STRING", "TEXT"),
    ("granularity", 1, "BIGINT", "TEXT"),
    ("moid", 2, "STRING", "TEXT"),
    ("nedn", 3, "STRING", "TEXT"),
    ("node", 4, "STRING", "TEXT"),
    ("ropendtime", 5, "TIMESTAMP", "TEXT"),
    ("utc_timestamp", 6, "TIMESTAMP", "TEXT"),
    ("local_timestamp", 7, "TIMESTAMP", "TEXT"),
]


def base_keys(spark: SparkSession) -> DataFrame:
    columns = "entity_column_name string, entity_column_order int, entity_data_type string, entity_counter_type string"
    return spark.createDataFrame(KEY_ROWS, columns)


def model_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(old, new) property rows of customers; the new one lacks those without orders.

    In the new snapshot one segment is renamed and nation 3 has no segment text;
    suppliers are added.
    """
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    supplier = table(spark, sf_dir, "supplier")

    def properties(df: DataFrame, name: str, nation: str, segment: Column) -> DataFrame:
        return df.select(
            F.concat(F.lit("Node/"), F.col(name)).alias("path"),
            F.inline(
                F.array(
                    F.struct(F.lit("nation").alias("prop"), F.col(nation).cast("string").alias("value")),
                    F.struct(F.lit("segment").alias("prop"), segment.alias("value")),
                )
            ),
        )

    old = properties(customer, "c_name", "c_nationkey", F.col("c_mktsegment"))
    renamed = F.when(F.col("c_nationkey") == 3, F.lit(None)).otherwise(
        F.replace("c_mktsegment", F.lit("MACHINERY"), F.lit("MACHINES"))
    )
    active = customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    new = properties(active, "c_name", "c_nationkey", renamed).unionByName(
        properties(supplier, "s_name", "s_nationkey", F.lit("SUPPLY"))
    )
    return old, new


def entity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, value): one entity tree per customer: its orders, and their lines as references.

    A document holds all orders of a customer. Texts are escaped, in CDATA sections or beside comments.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"))).alias("lines")
    )
    reference = F.transform(
        "lines", lambda n: F.format_string("<EntityRef name=\"%d\" line='%d' flag=\"%s\"/>", n["l_partkey"], n["l_linenumber"], n["l_returnflag"])
    )
    section = lambda name, parts: F.coalesce(
        F.concat(F.lit(f'<Components section="{name}">\n'), F.array_join(parts, "\n"), F.lit("</Components>")), F.lit("")
    )
    order = F.concat(
        F.lit('<EntityDef name="o'), F.col("o_orderkey"), F.lit('"><STATUS>'), F.col("o_orderstatus"),
        F.lit("</STATUS><!-- <hidden> --><PRIORITY><![CDATA[<"), F.col("o_orderpriority"), F.lit(">]]></PRIORITY>"),
        section("Lines", reference), F.lit("</EntityDef>"),
    )
    orders = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", order.alias("markup")
    )
    of_customer = orders.groupBy("c_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "markup"))).alias("orders"))
    document = F.concat(
        F.lit('<?xml version="1.0"?>\n<EntityDef name="'), F.col("c_name"), F.lit('"><SEGMENT>'),
        escape_xml(F.concat("c_mktsegment", F.lit(" & <co>"))), F.lit("</SEGMENT><NOTE/>"),
        section("Orders", F.transform("orders", lambda o: o["markup"])), F.lit("</EntityDef>\n"),
    )
    customers = table(spark, sf_dir, "customer").join(of_customer, "c_custkey", "left")
    return customers.select(F.col("c_custkey").alias("file"), document.alias("value"))


def nested_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sizes as structs with the part types as members: a promo refers to the struct of half
    the size, that of size 1 to size 48 and closes a cycle; sizes that divide by 9 refer to none there is."""
    part = table(spark, sf_dir, "part")
    half = F.when(F.col("p_size") == 1, 48).when(F.col("p_size") % 9 == 0, -1).otherwise(F.expr("p_size div 2"))
    return part.select(
        F.col("p_size").cast("string").alias("struct_name"),
        F.col("p_type").alias("member"),
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("e"), F.col("p_size") % 4)).alias("enum_ref"),
        F.when(F.col("p_type") == "PROMO", half.cast("string")).alias("struct_ref"),
    ).distinct()


def pack_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, value): one model document per supplier, with all that catalog tables are made of.

    Its entities are the return flags of its lines, their columns the line numbers.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linenumber").distinct()
    column = F.format_string(
        "<EntityDef name=\"c%d\"><ENTITY_COLUMN_ORDER>0</ENTITY_COLUMN_ORDER><ENTITY_COLUMN_ORDER>%d</ENTITY_COLUMN_ORDER>"
        "<ENTITY_DATA_TYPE>ARRAY&lt;BIGINT&gt;:4</ENTITY_DATA_TYPE><PARTITION_BY>%d</PARTITION_BY>"
        "<ENTITY_DESCRIPTION>it's %d</ENTITY_DESCRIPTION><SOURCE_ENTITY_NAME>Cell</SOURCE_ENTITY_NAME></EntityDef>",
        "l_linenumber", "l_linenumber", F.col("l_linenumber") % 2, "l_linenumber",
    )
    columns = lines.groupBy("l_suppkey", "l_returnflag").agg(F.array_join(F.array_sort(F.collect_list(column)), "").alias("columns"))
    entity = F.concat(
        F.lit('<EntityDef name="E'), F.col("l_returnflag"), F.lit('"><ENTITY_TYPE>RAW</ENTITY_TYPE><MAPPED_MO>'),
        F.when(F.col("l_returnflag") == "A", "Mo").otherwise(""),
        F.lit('</MAPPED_MO><Components section="REPORTABLE_ENTITIES_COLUMNS">'), F.col("columns"), F.lit("</Components></EntityDef>"),
    )
    entities = columns.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.array_join(F.array_sort(F.collect_list(entity)), "").alias("entities"))
    rest = F.format_string(
        "<Components section=\"SUPPORTED_NODE_VERSIONS\"><EntityDef name=\"L%1$d\"><MODEL_VERSION>%1$d.0</MODEL_VERSION></EntityDef></Components>"
        "<Components section=\"NODE_MO_STRUCTURE\"><EntityDef name=\"r\"><PARENT_MO_NAME>N%2$d</PARENT_MO_NAME>"
        "<CHILD_MO_NAME>C</CHILD_MO_NAME><CARDINALITY_MIN>0</CARDINALITY_MIN><CARDINALITY_MAX>%3$s</CARDINALITY_MAX></EntityDef></Components>"
        "<Components section=\"RETENTION_PLAN\"><EntityDef name=\"SHORT%1$d\"><RETENTION_PERIOD>%1$d</RETENTION_PERIOD></EntityDef></Components>"
        "<Components section=\"Flows\"><EntityDef name=\"F\"><Components section=\"Actions\"><EntityDef name=\"Collect\">"
        "<ROP_INTERVAL>%4$s</ROP_INTERVAL><ENABLED>1</ENABLED><CONFIG_out>/o</CONFIG_out><CONFIG_in>/d%1$d</CONFIG_in></EntityDef>"
        "</Components></EntityDef></Components>"
        "<Components section=\"DESIGNRULES\"><EntityDef name=\"PM\"><Components section=\"Rules\"><EntityDef name=\"All\">"
        "<MATCH_TYPE>ALL</MATCH_TYPE><Components section=\"Rules\"><EntityDef name=\"V\"><MATCH_TYPE>equals</MATCH_TYPE>"
        "<MATCH_ARGUMENT>name</MATCH_ARGUMENT><MATCH_VALUE>m%1$d</MATCH_VALUE><TARGET>_V</TARGET></EntityDef></Components>"
        "</EntityDef></Components></EntityDef></Components>",
        "s_suppkey", "s_nationkey",
        F.when(F.col("s_suppkey") % 5 == 0, "None").otherwise(F.col("s_suppkey").cast("string")),
        F.when(F.col("s_suppkey") % 2 == 0, "15").otherwise(""),
    )
    document = F.concat(
        F.lit('<EntityDef name="'), F.col("s_name"), F.lit('"><TECHPACK_NAME>T'), F.col("s_nationkey"),
        F.lit("</TECHPACK_NAME><DEPENDENCY>A,B"), F.col("s_suppkey"), F.lit("</DEPENDENCY>"),
        F.concat(F.lit('<Components section="REPORTABLE_ENTITIES">'), F.coalesce("entities", F.lit("")), F.lit("</Components>")),
        rest, F.lit("</EntityDef>"),
    )
    suppliers = table(spark, sf_dir, "supplier").join(entities, "s_suppkey", "left")
    return suppliers.select(F.col("s_suppkey").alias("file"), document.alias("value"))
