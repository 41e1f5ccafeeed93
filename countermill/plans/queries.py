"""The registered queries: every operator on data derived from the driver tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countermill.functions import counters as C
from countermill.functions import hashing as H
from countermill.functions import text as X
from countermill.functions import times as TM
from countermill.functions import types as TY
from countermill.operators import ageing, catalog, entities, files, flatten, kpi, log_records, model_diff, models
from countermill.operators.model_catalog import catalog_text, read_model_catalog, write_model_catalog
from countermill.operators import partitions, profiles, replication, routing, splits, versions
from countermill.plans import standins as S
from countermill.session import SETTINGS, durable, shared_folder
from countermill.sinks.stores import write_cold, write_long
from countermill.sources import counter_files as CF
from countermill.sources.kpi_definitions import scan_kpi_definitions
from countermill.sources.logs import scan_numbered_lines
from countermill.sources.model_trees import tree_rows
from countermill.sources.node_models import instance_attributes
from countermill.sources.stores import backlog_older_than
from countermill.streaming.fanout import Sink, commits, committed, start_fan_out
from countermill.streaming.ingest import file_states, start_ingest, start_long_sink

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Days the lifecycle queries run "on"; the current date never enters a query.
EVENT_DAY, ORDER_DAY = "2024-01-20", "2000-01-01"

# Documents that a file of a group holds, about; a file is read whole by one task.
DOCUMENTS_PER_FILE = 1_000_000


def query(function: Query) -> Query:
    QUERIES[f"q_{function.__name__}"] = function
    return function


# --- counter tables ---------------------------------------------------------


@query
def counter_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long rows to a wide entity; the first event of a period wins."""
    return entities.to_entity(S.pm_long(spark, sf_dir), S.COUNTERS, keys=S.STANDIN_KEYS, order_by=["event_id"])


@query
def counter_pivot_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by pivot, the way chosen for many counters."""
    return entities.to_entity(
        S.pm_long(spark, sf_dir), S.COUNTERS, keys=S.STANDIN_KEYS, order_by=["event_id"], conditional_limit=0
    )


@query
def counter_pivot_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """measData documents, index-joined names, summed per node and day."""
    records = CF.parse_measdata_text(S.measdata_documents(spark, sf_dir), "value", "file")
    return entities.to_entity(flatten.flatten_measdata(records), S.COUNTERS, "Session", "sum", ["date_id", "node"])


@query
def mdc_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mdc documents to long counter rows; the last of a repeated counter wins."""
    records = CF.parse_mdc_text(S.mdc_documents(spark, sf_dir), "value", "file")
    return flatten.flatten_mdc(records).select(
        "date_id",
        "granularity",
        "moid",
        "nedn",
        "node",
        "measurement",
        F.date_format("ropendtime", "yyyyMMddHHmmss").alias("ropendtime"),
        F.date_format("utc_timestamp", "yyyyMMddHHmmss").alias("utc_timestamp"),
        F.date_format("local_timestamp", "yyyyMMddHHmmss").alias("local_timestamp"),
        "counter_name",
        "counter_value",
    )


@query
def mdc_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mdc documents to wide rows per object and day."""
    records = CF.parse_mdc_text(S.mdc_documents(spark, sf_dir), "value", "file")
    keys = ["date_id", "measurement", "moid", "node"]
    return entities.to_entity(flatten.flatten_mdc(records), S.COUNTERS, agg="sum", keys=keys)


@query
def entity_map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide raw values straight from the counter map, no shuffle after the scan."""
    records = CF.parse_mdc_text(S.mdc_documents(spark, sf_dir), "value", "file")
    keys = {"day": "date_id", "object": "moid", "file": "source_file"}
    return entities.to_entity_from_map(flatten.mdc_counter_maps(records), {f"pm_{c}": c for c in S.COUNTERS}, keys=keys)


def _looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = CF.parse_mdc_text(S.mdc_documents(spark, sf_dir), "value", "file")
    keys = ["date_id", "node", "ropendtime"]
    return entities.to_entity_from_map(flatten.mdc_counter_maps(records), {c: c for c in S.COUNTERS}, keys=keys, integers=True)


@query
def entity_merge_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map lookups of all documents, merged to the first value per node and day."""
    return entities.merge_rows(_looked_up(spark, sf_dir), S.COUNTERS, ["date_id", "node"], order_by=["ropendtime"])


@query
def entity_merge_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map lookups of all documents, summed per node and day."""
    return entities.merge_rows(_looked_up(spark, sf_dir), S.COUNTERS, ["date_id", "node"], "sum")


@query
def counter_map_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter maps exploded for two wanted counters."""
    records = CF.parse_mdc_text(S.mdc_documents(spark, sf_dir), "value", "file")
    rows = flatten.explode_counters(flatten.mdc_counter_maps(records), ["view", "error"])
    return rows.select(F.col("source_file").alias("file"), "counter_name_raw", "counter_value_raw")


@query
def vector_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as text split into 256 bin columns, missing bins NULL."""
    return entities.to_vector_rows(_vectors(spark, sf_dir), ["vec_id"], bin_type="bigint")


@query
def vector_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors in long form: one row per filled bin."""
    rows = entities.vector_long(_vectors(spark, sf_dir), ["vec_id"])
    return rows.select("vec_id", "counter_name", "bin", F.col("value").cast("bigint").alias("value"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("string"))
    return S.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.lit("pmVec").alias("counter_name_raw"), F.array_join(whole, ",").alias("counter_value_raw")
    )


@query
def counter_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counters per object class over all documents."""
    records = CF.parse_mdc_text(S.mdc_documents(spark, sf_dir), "value", "file")
    covered = profiles.counter_coverage(records)
    return covered.select("measurement", "counter_count", F.array_join("counters", ",").alias("counters"))


@query
def path_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element paths of all documents with occurrence, text and attributes."""
    profile = profiles.xml_path_profile(S.mdc_documents(spark, sf_dir))
    return profile.select("path", "occurrence", "contains_text", F.array_join("attributes", ",").alias("attributes"))


def _written_documents(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(scratch folder, folder with the documents as files) in the shared folder."""
    scratch = f"{shared_folder(spark)}/countermill-{uuid.uuid4().hex}"
    records = CF.parse_mdc_text(S.mdc_documents(spark, sf_dir), "value", "file").select("mfh", "md")
    records.write.format("xml").option("rowTag", "mdc").option("rootTag", "files").save(f"{scratch}/in")
    return scratch, f"{scratch}/in"


def _counted(long: DataFrame) -> DataFrame:
    return long.groupBy("date_id", "measurement", "counter_name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("counter_value").alias("total")
    )


@query
def mdc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents written as files and scanned back, counted per day and class."""
    return _counted(flatten.flatten_mdc(CF.scan_mdc(spark, _written_documents(spark, sf_dir)[1])))


@query
def mdc_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, several documents each, split at block ends and parsed in parallel."""
    parts = CF.scan_mdc_parts(spark, _written_documents(spark, sf_dir)[1])
    return parts.groupBy("nedn").agg(F.count(F.lit(1)).alias("blocks"), F.min("info.mts").alias("first_mts"), F.max("info.mts").alias("last_mts"))


@query
def long_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each day written in two batches, the second one twice, then counted."""
    path = f"{shared_folder(spark)}/countermill-{uuid.uuid4().hex}"
    rows = S.pm_long(spark, sf_dir).select("measurement", "date_id", "counter_name", "counter_value", "event_id")
    odd = F.col("event_id") % 2 == 1
    write_long(rows.filter(~odd), path, "even")
    for _ in range(2):
        write_long(rows.filter(odd), path, "odd")
    schema = "counter_name STRING, counter_value BIGINT, event_id BIGINT, batch_id STRING, measurement STRING, date_id STRING"
    return _counted(spark.read.schema(schema).parquet(path))


@query
def stream_mdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files as a stream into a partitioned long table, counted from there."""
    scratch, folder = _written_documents(spark, sf_dir)
    stream = CF.stream_mdc(spark, folder)
    start_long_sink(stream, flatten.flatten_mdc, f"{scratch}/long", f"{scratch}/state").awaitTermination()
    schema = "counter_name STRING, counter_value BIGINT, measurement STRING, date_id STRING"
    return _counted(spark.read.schema(schema).parquet(f"{scratch}/long"))


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a file stream, written per batch, then counted from what was written."""
    out = f"{shared_folder(spark)}/countermill-{uuid.uuid4().hex}"
    schema = S.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(
            F.date_format("ts", "yyyyMMdd").alias("date_id"),
            F.col("event_type").alias("counter_name"),
            S.scaled().alias("counter_value"),
            F.lit(batch_id).alias("batch_id"),
        )
        write_cold(rows.hint("rebalance", "date_id"), f"{out}/rows", ["batch_id", "date_id"])

    start_ingest(stream, handle, f"{out}/state").awaitTermination()
    written = spark.read.schema("counter_name STRING, counter_value BIGINT, batch_id INT, date_id STRING")
    rows = written.parquet(f"{out}/rows")
    return rows.groupBy("date_id", "counter_name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("counter_value").alias("total")
    )


def _grouped_files(spark: SparkSession, sf_dir: str, folder: str, groups: int = 8) -> None:
    """The documents as one file for each group of users, several documents in each; a very big
    group is a folder of several files, with all documents of a user in one of them."""
    records = CF.parse_mdc_text(S.mdc_documents(spark, sf_dir), "value", "file")
    user = F.substring_index("source_file", "/", 1)
    group = user.cast("int") % groups
    # There are no more documents than events.
    parts = S.table(spark, sf_dir, "events").count() // (groups * DOCUMENTS_PER_FILE) + 1
    task = F.coalesce(F.pmod(group, F.lit(groups)) * parts, F.lit(0)) + F.pmod(F.xxhash64(user), F.lit(parts)).cast("int")
    grouped = records.select("mfh", "md", group.alias("group_id"), task.alias("_task")).repartitionById(groups * parts, "_task").drop("_task")
    grouped.write.format("xml").option("rowTag", "mdc").option("rootTag", "files").partitionBy("group_id").save(folder)


@query
def batch_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, an empty and a foreign file as a stream into three sinks; the second batch fails once
    between two sinks and is run again. Counts of what the committed batches hold."""
    scratch = f"{shared_folder(spark)}/countermill-{uuid.uuid4().hex}"
    _grouped_files(spark, sf_dir, f"{scratch}/in")
    for name, lines in {"empty": [], "foreign": [("<other>1</other>",)]}.items():
        spark.createDataFrame(lines, "value STRING").coalesce(1).write.text(f"{scratch}/in/kind={name}")
    failures = [RuntimeError("between two sinks")]

    def wide(records: DataFrame, files: DataFrame) -> DataFrame:
        if failures and not commits(spark, f"{scratch}/out").isEmpty():
            raise failures.pop()
        return entities.to_entity(flatten.flatten_mdc(records), S.COUNTERS, agg="sum", keys=["date_id", "moid", "measurement"])

    sinks = {
        "long": Sink(lambda records, files: flatten.flatten_mdc(records), ["measurement", "date_id"]),
        "entity": Sink(wide, ["date_id"]),
        "files": Sink(file_states),
    }
    for _ in range(2):
        stream = CF.stream_mdc(spark, f"{scratch}/in/*", max_files=3)
        try:
            start_fan_out(stream, sinks, f"{scratch}/out", f"{scratch}/state").awaitTermination()
        except StreamingQueryException as failed:
            if "between two sinks" not in str(failed):
                raise

    def seen(sink: str, schema: str) -> DataFrame:
        return committed(spark, f"{scratch}/out", sink, schema).withColumn("sink", F.lit(sink))

    rows = F.count(F.lit(1)).alias("rows")
    long = seen("long", "counter_name STRING, counter_value BIGINT, date_id STRING")
    entity = seen("entity", "measurement STRING, view BIGINT, date_id STRING")
    # A folder counts once, however many files it has, and again when any of them is seen again.
    name, folder = F.col("status").alias("name"), F.regexp_extract("path", "([^/]*)/[^/]*$", 1).alias("folder")
    paths = seen("files", "path STRING, status STRING").groupBy("sink", name, folder, "path").agg(rows)
    states = paths.groupBy("sink", "name", "folder").agg(F.max("rows").alias("rows")).groupBy("sink", "name").agg(F.sum("rows").alias("rows"))
    no_day, no_total = F.lit(None).cast("string").alias("date_id"), F.lit(None).cast("bigint").alias("total")
    return (
        long.groupBy("sink", "date_id", F.col("counter_name").alias("name")).agg(rows, F.sum("counter_value").alias("total"))
        .unionByName(entity.groupBy("sink", "date_id", F.col("measurement").alias("name")).agg(rows, F.sum("view").alias("total")))
        .unionByName(states.select("sink", no_day, "name", "rows", no_total))
    )


@query
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two levels with an empty and a foreign one, listed and set against the backlog."""
    scratch = f"{shared_folder(spark)}/countermill-{uuid.uuid4().hex}"
    orders = S.table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(
        F.concat(F.lit("<orders>"), F.count(F.lit(1)), F.lit("</orders>")).alias("value")
    )
    orders.repartition("o_orderstatus", "o_orderpriority").write.partitionBy("o_orderstatus", "o_orderpriority").text(f"{scratch}/in")
    spark.createDataFrame([], "value STRING").coalesce(1).write.text(f"{scratch}/in/o_orderstatus=O/empty")
    found = CF.found_files(spark, f"{scratch}/in", "part-*")
    known = found.filter(F.col("path").contains("o_orderstatus=F")).select(
        "path", F.lit("Parsed").alias("status")
    ).unionByName(spark.createDataFrame([("/gone/lost.xml", None)], "path STRING, status STRING"))
    outcomes = files.reconcile(found, known).join(found, "path", "left")
    folder = F.coalesce(F.nullif(F.url_decode(F.regexp_extract("path", "/in/(.*)/part-[^/]*$", 1)), F.lit("")), F.col("path"))
    return outcomes.select(folder.alias("folder"), "outcome", "size", F.col("modified").isNotNull().alias("dated"))


# --- scalar functions -------------------------------------------------------


@query
def rdn_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, days and values picked from text, one row per order."""
    orders = S.table(spark, sf_dir, "orders")
    moid = F.concat(F.lit("Net=1,Cust="), F.col("o_custkey"), F.lit(",OrderFDD="), F.col("o_orderkey"))
    mts = F.concat(F.date_format("o_orderdate", "yyyyMMddHHmmss"), F.lit("+0530"))
    raw = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(
        F.concat(F.floor("o_totalprice").cast("bigint"), F.lit(","), F.col("o_custkey"))
    )
    rows = orders.select("o_orderkey", moid.alias("moid"), mts.alias("mts"), raw.alias("raw"), "o_orderpriority")
    return rows.select(
        "o_orderkey",
        X.rdn_class("moid").alias("measurement"),
        X.last_value("moid").alias("node"),
        TM.date_id_of_text("mts").alias("date_id"),
        F.date_format(TM.rop_instant("mts"), "yyyyMMddHHmm").alias("instant"),
        F.date_format(TM.rop_wall_clock("mts"), "yyyyMMddHHmm").alias("wall_clock"),
        C.first_integer("raw").alias("first_value"),
        X.column_name("o_orderpriority").alias("column_name"),
        TM.duration_seconds(F.concat(F.lit("PT"), F.col("o_orderkey"), F.lit("S"))).alias("seconds"),
        TM.is_date(F.concat(F.lit("2023-"), F.col("o_orderkey") % 15, F.lit("-30"))).alias("valid_day"),
    )


@query
def config_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration text to a map and back; a value ends at its next equals sign."""
    orders = S.table(spark, sf_dir, "orders")
    text = F.concat(
        F.lit("status="), F.col("o_orderstatus"), F.lit("::priority="), F.col("o_orderpriority"),
        F.lit("=x::cust="), F.col("o_custkey"), F.lit("::empty="),
    )
    rows = orders.select("o_orderkey", X.config_map(text).alias("m"))
    return rows.select(
        "o_orderkey",
        F.col("m")["status"].alias("status"),
        F.col("m")["priority"].alias("priority"),
        F.col("m")["cust"].alias("cust"),
        F.col("m")["empty"].alias("empty"),
        F.col("m")["absent"].alias("absent"),
        X.config_text("m").alias("text"),
    )


@query
def markup_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents escaped for markup and turned back."""
    documents = S.table(spark, sf_dir, "documents").select("doc_id", X.escape_xml("text").alias("escaped"))
    return documents.select("doc_id", "escaped", X.unescape_xml("escaped").alias("unescaped"))


@query
def store_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cold folder, split suffix, version and last word of names."""
    part = S.table(spark, sf_dir, "part")
    entity = F.concat(F.lit("E_"), F.col("p_size"))
    return part.select(
        "p_partkey",
        X.store_path(F.lit("PM_X_CELL"), F.col("p_type"), entity).alias("location"),
        X.split_suffix_removed(entity).alias("base"),
        X.is_split(F.col("p_brand")).alias("is_split"),
        X.version_text(F.concat(F.lit("a_"), F.col("p_type")), F.col("p_size"), F.lit("9")).alias("version"),
        X.last_word("p_name").alias("last_word"),
        TY.hot_store_type_column(F.when(F.col("p_size") < 20, "ARRAY<BIGINT>:8").when(F.col("p_size") < 30, "STRING").otherwise("FLOAT")).alias("hot_type"),
    )


@query
def hash_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed key hash and slice of every customer."""
    return S.table(spark, sf_dir, "customer").select(
        "c_custkey", H.key_hash("c_name").alias("key_hash"), H.hash_slice("c_name").alias("slice")
    )


# --- file backlog -----------------------------------------------------------


@query
def backlog_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.reconcile(S.listing(spark, sf_dir), S.backlog(spark, sf_dir))


@query
def backlog_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = S.listing(spark, sf_dir)
    pending = S.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") != "5-LOW")
    known = S.order_backlog(spark, sf_dir).join(pending.select(S._path("o_orderkey").alias("path")), "path", "left_semi")
    after = files.register_files(known, listing, F.lit("2024-02-01 00:00:00"))
    return after.select(
        "path", "status", _day("received_date").alias("received"), _day("processed_date").alias("processed")
    )


def _day(column: str) -> Column:
    return F.date_format(column, "yyyyMMdd")


@query
def backlog_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    backlog = S.order_backlog(spark, sf_dir)
    requested = files.waiting_files(backlog)
    parsed = S.table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select(S._path("l_orderkey").alias("path"))
    after = files.close_batch(backlog, requested, parsed, F.to_timestamp(F.lit("2024-02-01 00:00:00")))
    return after.select("path", "status", _day("received_date").alias("received"), _day("processed_date").alias("processed"))


@query
def backlog_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    backlog = S.backlog(spark, sf_dir)
    waiting = files.waiting_files(backlog).withColumn("state", F.lit("waiting"))
    return waiting.unionByName(files.processed_files(backlog).withColumn("state", F.lit("processed")))


@query
def backlog_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    archived, kept = ageing.archive_backlog(S.order_backlog(spark, sf_dir), ORDER_DAY)
    parts = [
        archived.select("path", F.date_format("received_day", "yyyyMMdd").alias("received_day")),
        kept.select("path", F.lit(None).cast("string").alias("received_day")),
    ]
    return parts[0].unionByName(parts[1])


@query
def backlog_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog_older_than(S.order_backlog(spark, sf_dir), ORDER_DAY).select("path", "status")


# --- ageing and partitions --------------------------------------------------


def _hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("ropendtime"), F.date_format("ts", "yyyyMMdd").alias("date_id"), S.scaled().alias("counter_value")
    )


@query
def age_out_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ageing.age_out(_hot(spark, sf_dir), EVENT_DAY)[0].drop("ropendtime")


@query
def age_out_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ageing.age_out(_hot(spark, sf_dir), EVENT_DAY)[1].drop("ropendtime")


@query
def archive_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days moved from a partitioned hot table to cold Parquet, each checked before it is dropped."""
    name = f"countermill_{uuid.uuid4().hex}"
    folder = f"{shared_folder(spark)}/{name}"
    hot = _hot(spark, sf_dir)
    write_cold(hot.hint("rebalance", "date_id"), f"{folder}/hot")
    partitions.create_external_table(spark, name, hot.schema, ["date_id"], f"{folder}/hot")
    partitions.recover_partitions(spark, name, partitions.partition_drift(spark, name))
    for _ in range(2):
        ageing.archive_oldest(spark, name, f"{folder}/cold", EVENT_DAY)
    cold = spark.read.schema(hot.schema).parquet(f"{folder}/cold").withColumn("store", F.lit("cold"))
    both = spark.table(name).withColumn("store", F.lit("hot")).unionByName(cold)
    # Taken before the table goes: the result must not leave a table behind.
    result = durable(both.groupBy("store", "date_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("counter_value").alias("total")))
    spark.sql(f"DROP TABLE {name}")
    return result


@query
def retention_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = _hot(spark, sf_dir)
    kept = ageing.within_retention(hot, EVENT_DAY, 7).select("event_id", F.lit("kept").alias("state"))
    return kept.unionByName(ageing.beyond_retention(hot, EVENT_DAY, 7).select("event_id", F.lit("purged").alias("state")))


@query
def partition_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = S.table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct()
    return partitions.partition_locations(partitions.partition_calendar(days, 3), "/pm/cell")


@query
def expired_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = S.table(spark, sf_dir, "events").select(F.concat(F.lit("/pm/cell/date_id="), F.date_format("ts", "yyyyMMdd")).alias("location"))
    return partitions.expired_partitions(days.distinct(), EVENT_DAY, 7)


@query
def table_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table whose partitions are created, added, expired, moved in and refreshed:
    what the catalog and the folders hold in the end, with the rows the table shows."""
    name = f"countermill_{uuid.uuid4().hex}"
    location = f"{shared_folder(spark)}/{name}"
    rows = _hot(spark, sf_dir).select("event_id", "counter_value", "date_id")
    write_cold(rows.hint("rebalance", "date_id"), location)
    partitions.create_external_table(spark, name, rows.schema, ["date_id"], location)
    eve = rows.select(F.date_sub(F.to_date("date_id", "yyyyMMdd"), 1).alias("day")).distinct()
    partitions.add_partitions(spark, name, partitions.partition_calendar(eve))
    spark.table(name).count()
    partitions.purge_expired(spark, name, EVENT_DAY, 7)
    # Another job moves a day in, and adds files to one that the session has read already.
    later = rows.filter(F.col("date_id") == "20240120")
    write_cold(later.withColumn("date_id", F.lit("20990101")), location, append=True)
    write_cold(later.withColumn("date_id", F.lit("20240119")), location, append=True)
    drift = partitions.partition_drift(spark, name).filter("state = 'unlisted'")
    partitions.recover_partitions(spark, name, drift.filter("location > 'date_id=20240120'"))
    partitions.add_partitions(spark, name, spark.sql("SELECT '20991231' AS date_id"))
    partitions.refresh_days(spark, name)
    seen = spark.table(name).groupBy(F.concat(F.lit("date_id="), "date_id").alias("location")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("counter_value").alias("total")
    )
    # Taken before the table goes: the result must not leave a table behind.
    result = durable(partitions.partition_drift(spark, name).join(seen, "location", "left"))
    spark.sql(f"DROP TABLE {name}")
    return result


# --- versions and splits ----------------------------------------------------


@query
def merge_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status as three versions with retyped and missing columns."""
    orders = S.table(spark, sf_dir, "orders")
    whole = F.floor("o_totalprice")
    by = lambda s: orders.filter(F.col("o_orderstatus") == s)
    return versions.merge_versions(
        {
            "v1": by("F").select("o_orderkey", whole.cast("int").alias("a"), F.col("o_custkey").cast("int").alias("b")),
            "v2": by("O").select("o_orderkey", whole.cast("bigint").alias("a"), F.col("o_totalprice").alias("b")),
            "v3": by("P").select("o_orderkey", whole.cast("bigint").cast("string").alias("a"), F.col("o_orderpriority").alias("c")),
        }
    )


@query
def array_posexplode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version with an array column and one without it."""
    embeddings = S.table(spark, sf_dir, "embeddings")
    known = F.coalesce(F.col("label") < 4, F.lit(False))
    return versions.merge_versions(
        {"v1": embeddings.filter(known), "v2": embeddings.filter(~known).select("vec_id", "label")}
    )


@query
def widened_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.widened_columns(S.version_columns(spark, sf_dir))


@query
def widened_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Widening of sized text, arrays, times and numbers in all mixtures."""
    return versions.widened_columns(S.part_types(spark, sf_dir))


@query
def usable_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.usable_versions(S.version_columns(spark, sf_dir))


@query
def column_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.column_versions(S.version_columns(spark, sf_dir))


def _order_splits(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    orders = S.table(spark, sf_dir, "orders")
    key = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey")).alias("k")
    return [
        orders.filter(F.col("o_orderstatus") != "P").select(key, F.col("o_custkey").alias("x")),
        orders.filter(F.col("o_orderstatus") != "F").select(key, F.col("o_totalprice").alias("y")),
        orders.select(key, F.col("o_orderstatus").alias("z")),
    ]


@query
def stitch_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three column splits with unmatched and NULL keys, joined on the key."""
    return splits.stitch_splits(_order_splits(spark, sf_dir), ["k"])


@query
def stitch_splits_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by union and aggregation, as no split repeats a key."""
    return splits.stitch_splits(_order_splits(spark, sf_dir), ["k"], unique_keys=True)


@query
def natural_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables joined on all their columns, with repeated rows and NULLs."""
    part = S.table(spark, sf_dir, "part")
    columns = [F.nullif("p_brand", F.lit("Brand#2")).alias("p_brand"), F.col("p_type"), F.col("p_size")]
    return splits.natural_full_join(
        [part.filter(F.col("p_size") <= 30).select(*columns), part.filter(F.col("p_size") > 20).select(*columns)]
    )


# --- KPIs -------------------------------------------------------------------


def _kpi_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    long = S.pm_long(spark, sf_dir)
    wide = entities.to_entity(long, S.COUNTERS, agg="sum", keys=[*S.STANDIN_KEYS])
    return {"PM_X_CELL": wide, "PM_X_RAW": long.filter(F.col("counter_name") == "view").withColumnRenamed("counter_value", "all_views")}


@query
def kpi_ratio_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios of daily sums per node, one of them over two tables."""
    elements = ["date_id", "node"]
    definitions = [
        kpi.parse_kpi("click_rate", "pm://PM_X_CELL.click / pm://PM_X_CELL.view", elements),
        kpi.parse_kpi("error_share", "pm://PM_X_CELL.error / pm://PM_X_RAW.all_views", elements),
        kpi.parse_kpi("purchases", "pm://PM_X_CELL.purchase", elements),
    ]
    return kpi.kpi_table(_kpi_tables(spark, sf_dir), definitions)


@query
def kpi_ratio_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ratio grouped by the hour its periods lie in."""
    definition = kpi.parse_kpi("error_rate", "pm://PM_X_CELL.error / pm://PM_X_CELL.click", ["date_id", "ropendtime"], 60)
    rates = kpi.kpi_table(_kpi_tables(spark, sf_dir), [definition])
    return rates.withColumn("ropendtime", F.date_format("ropendtime", "yyyyMMddHHmm"))


# Definitions in the form of the KPI documents.
KPI_DOCUMENTS = [
    {
        "source": "day",
        "kpi_definitions": [
            ("click_share", "pm://PM_X_CELL.click / (pm://PM_X_CELL.click + pm://PM_X_CELL.view)", ["date_id", "node"]),
            ("margin", "100 * (pm://PM_X_CELL.purchase - pm://PM_X_CELL.error)/pm://PM_X_RAW.all_views", ["date_id", "node"]),
            ("error_rate", "pm://PM_X_CELL.error / pm://PM_X_CELL.view", ["date_id", "node"]),
        ],
    },
    {
        "source": "node",
        "kpi_definitions": [
            ("net", "-pm://PM_X_CELL.error + 2.5 * pm://PM_X_CELL.signup", ["node"]),
            ("no_divisor", "pm://PM_X_CELL.view / (pm://PM_X_RAW.all_views - pm://PM_X_CELL.view)", ["node"]),
        ],
    },
]


@query
def kpi_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs defined in JSON files, with brackets and constants, in long form."""
    folder = f"{shared_folder(spark)}/countermill-{uuid.uuid4().hex}"
    fields = ("name", "expression", "aggregation_elements")
    for document in KPI_DOCUMENTS:
        listed = [dict(zip(fields, d)) | {"aggregation_type": "SUM", "aggregation_period": 1440} for d in document["kpi_definitions"]]
        text = json.dumps({"source": document["source"], "kpi_definitions": listed}, indent=1)
        spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.text(f"{folder}/{document['source']}")
    definitions = kpi.read_kpis(scan_kpi_definitions(spark, f"{folder}/*"))
    parts = []
    for (_, elements, _), frame in kpi.kpi_tables(_kpi_tables(spark, sf_dir), definitions).items():
        names = [c for c in frame.columns if c not in elements]
        key = F.concat_ws("/", *elements)
        parts.append(frame.select(key.alias("key"), *names).unpivot(["key"], names, "kpi", "value"))
    return reduce(DataFrame.unionByName, parts)


# --- catalog and models -----------------------------------------------------


@query
def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.entity_columns(S.catalog(spark, sf_dir), entity_type="RAW")


@query
def catalog_partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.partition_columns(S.catalog(spark, sf_dir))


@query
def catalog_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.retention_locations(S.catalog(spark, sf_dir), name_like="E%", version_like="NATION_%")


@query
def catalog_tables_by_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.tables_by_retention(S.catalog(spark, sf_dir))


@query
def catalog_persistence_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.persistence_columns(S.catalog(spark, sf_dir), "NATION_1%")


@query
def catalog_versions_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = S.catalog(spark, sf_dir)
    chosen = catalog.supported_versions(tables, "PM_X_2")
    return catalog.with_versions(tables["reportable_entity"], chosen).select("techpack_version_id", "reportable_entity_name")


@query
def catalog_column_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = catalog.column_groups(catalog.entity_columns(S.catalog(spark, sf_dir)))
    listed = F.transform("columns", lambda c: F.concat_ws(":", c["name"], c["source"]))
    return groups.select("reportable_entity_name", "entity_column_type", F.array_join(listed, ",").alias("columns"))


@query
def catalog_split_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.split_entities(S.catalog(spark, sf_dir))


@query
def catalog_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = S.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("state"))
    finished = S.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    changes = finished.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderstatus").alias("state"))
    return catalog.upsert(current, changes, ["c_custkey"])


@query
def route_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts routed to tables by rules, numbered, split at 50 columns, keys attached."""
    return routing.route_columns(S.attributes(spark, sf_dir), S.rules(spark), "BASE_X", S.base_keys(spark), limit=50)


@query
def route_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routes alone, matched the way used for more rules than fit one expression."""
    routed = routing.routed_attributes(S.attributes(spark, sf_dir), S.rules(spark), "BASE_X", rules_in_plan=0)
    return routed.select("mo_name", "name", "target_package_name", "table")


@query
def model_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = S.model_snapshots(spark, sf_dir)
    return model_diff.model_diff(old, new, ["path", "prop"])


@query
def instance_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as model attributes under their brand; one brand is not declared."""
    part = S.table(spark, sf_dir, "part")
    declared = part.select("p_brand").distinct().filter(F.col("p_brand") != "Brand#3")
    groups = declared.select(F.lit("Me=1,Pm=1").alias("parent_dn"), F.col("p_brand").alias("name"), _properties(F.lit(""), F.lit("")))
    members = part.select(
        F.concat(F.lit("Me=1,Pm=1,Group="), F.col("p_brand")).alias("parent_dn"),
        F.concat_ws(".", "p_name", "p_partkey").alias("name"),
        _properties(F.col("p_type"), F.col("p_size").cast("string")),
    )
    return instance_attributes(groups.unionByName(members)).select("mo_name", "name", "data_type", "counter_type", "declared")


def _properties(data_type: Column, counter_type: Column) -> Column:
    return F.create_map(F.lit("dataType"), data_type, F.lit("counterType"), counter_type).alias("properties")


@query
def reference_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as attributes that refer to an enum or a struct, some undefined."""
    orders, lineitem, part = (S.table(spark, sf_dir, t) for t in ("orders", "lineitem", "part"))
    attributes = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("enum_ref"),
        F.when(F.col("o_orderstatus") == "P", F.replace("o_orderpriority", F.lit("5-LOW"), F.lit("-"))).alias("priority"),
    )
    attributes = attributes.select(
        "o_orderkey", "enum_ref", F.when(F.col("priority").isNotNull(), F.substring("priority", 1, 1)).alias("struct_ref")
    )
    enums = lineitem.select(F.col("l_linestatus").alias("enum_name"), F.col("l_returnflag").alias("member")).distinct()
    structs = part.select(
        F.col("p_size").cast("string").alias("struct_name"),
        F.col("p_type").alias("member"),
        F.when(F.col("p_type") == "PROMO", F.lit("F")).alias("enum_ref"),
        F.lit(None).cast("string").alias("struct_ref"),
    ).distinct()
    return models.resolve_references(attributes, enums, structs).select("o_orderkey", "member_type", "ref", "member", "nested_ref")


@query
def model_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model documents to all eleven catalog tables in one pass, written and read back as text."""
    folder = f"{shared_folder(spark)}/countermill-{uuid.uuid4().hex}"
    write_model_catalog(tree_rows(S.pack_models(spark, sf_dir), "file"), folder)
    return catalog_text(read_model_catalog(spark, folder))


@query
def model_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of all structs through structs in structs, with cycles and undefined ones."""
    return models.struct_closure(S.nested_structs(spark, sf_dir))


@query
def nested_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as attributes that refer to a struct, resolved to the end, counted by kind and depth."""
    lines = S.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.lit(None).cast("string").alias("enum_ref"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("int").cast("string")).alias("struct_ref"),
    )
    enums = S.table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("enum_name"), F.col("l_returnflag").alias("member")).distinct()
    found = models.resolve_nested(lines, enums, S.nested_structs(spark, sf_dir))
    return found.groupBy("ref", "kind").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("path").alias("paths"))


@query
def entity_tree_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity trees of three levels as property rows with their paths."""
    return tree_rows(S.entity_trees(spark, sf_dir), "file")


@query
def hierarchy_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers under nations as managed-object edges."""
    customer, nation = S.table(spark, sf_dir, "customer"), S.table(spark, sf_dir, "nation")
    edges = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("c_acctbal") > 0, F.col("n_name")).alias("parent"),
        F.col("c_name").alias("child"),
        F.lit(0).alias("cardinality_min"),
        F.col("n_regionkey").alias("cardinality_max"),
    )
    return models.hierarchy_edges(edges, "PM_X_R1")


# --- logs -------------------------------------------------------------------


@query
def log_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_records.stitch_log_records(S.application_log(spark, sf_dir)).drop("record")


def _log_files(spark: SparkSession, sf_dir: str) -> tuple[SparkSession, str]:
    """A log file for every ten days, and a session that reads them in some 32 splits."""
    folder = f"{shared_folder(spark)}/countermill-{uuid.uuid4().hex}"
    events = S.table(spark, sf_dir, "events")
    day = F.concat(F.date_format("ts", "yyyyMM"), F.floor(F.dayofmonth("ts") / 10)).alias("day")
    line = F.when(F.col("event_id") % 10 == 0, F.lit("")).otherwise(F.concat_ws(" ", "event_type", "event_id", "props"))
    lines = events.select(day, "event_id", line.alias("value"))
    ordered = lines.repartition("day").sortWithinPartitions("day", "event_id")
    ordered.select("day", "value").write.partitionBy("day").text(folder)
    reading = spark.newSession()
    for key, value in SETTINGS.items():
        reading.conf.set(key, value)
    reading.conf.set("spark.sql.files.maxPartitionBytes", max(256, events.count() * 20 // 32))
    return reading, folder


@query
def log_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of every line of log files that are read in many splits each."""
    reading, folder = _log_files(spark, sf_dir)
    lines = scan_numbered_lines(reading, f"{folder}/*")
    return lines.select(F.regexp_extract("source_file", "day=([0-9]+)", 1).alias("day"), F.col("pos").alias("number"), "line")


@query
def log_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_records.orphan_lines(S.application_log(spark, sf_dir)).select("source_file", "line")


@query
def replication_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replication.replication_state(S.replication_log(spark, sf_dir))
