"""Counter documents flattened to rows.

The map form has one row per object instance and period with all its counters in
one map. The long form has one row per counter. Both come from explodes and
native expressions only; neither shuffles.

Where an exploded expression is costly, the outer explode is used and its empty
rows are filtered after: for an inner explode Spark infers a filter on the
expression, which would evaluate it a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countermill.functions import counters as C
from countermill.functions import text as X
from countermill.functions import times as TM


def _origin(df: DataFrame) -> Column:
    return F.col("source_file") if "source_file" in df.columns else F.lit(None).cast("string").alias("source_file")


def mdc_instances(records: DataFrame) -> DataFrame:
    """One row per object instance and period: keys, name list, result list.

    ``source_pos`` is the instance's place in its document.
    """
    md = records.select(
        _origin(records),
        F.col("mfh.sn").alias("nedn"),
        F.posexplode("md").alias("md_pos", "element"),
    )
    return _instances(md.select("source_file", "nedn", "md_pos", F.posexplode("element.mi").alias("mi_pos", "info")))


def mdc_part_instances(parts: DataFrame) -> DataFrame:
    """The same rows from single info blocks, see :func:`scan_mdc_parts`."""
    place = [F.col("part_pos.block").alias("md_pos"), F.col("part_pos.id").alias("mi_pos")]
    return _instances(parts.select("source_file", "nedn", *place, "info"))


def _instances(info: DataFrame) -> DataFrame:
    # Only what the rows need travels beside the exploded list. Were the block
    # itself kept, every instance would carry a copy of all instances.
    kept = ["source_file", "nedn", "md_pos", "mi_pos", "mts", "gp", "names", "names_distinct"]
    mi = info.select(
        *kept[:4],
        "info.mts",
        "info.gp",
        F.col("info.mt").alias("names"),
        C.all_distinct("info.mt").alias("names_distinct"),
        "info.mv",
    )
    mv = mi.select(*kept, F.posexplode("mv").alias("mv_pos", "instance"))
    mts = F.col("mts")
    moid = F.col("instance.moid")
    return mv.select(
        TM.date_id_of_text(mts).alias("date_id"),
        F.col("gp").alias("granularity"),
        moid.alias("moid"),
        "nedn",
        X.last_value("nedn").alias("node"),
        TM.rop_instant(mts).alias("ropendtime"),
        TM.rop_instant(mts).alias("utc_timestamp"),
        TM.rop_wall_clock(mts).alias("local_timestamp"),
        X.rdn_class(moid).alias("measurement"),
        "source_file",
        F.struct("md_pos", "mi_pos", "mv_pos").alias("source_pos"),
        "names",
        "names_distinct",
        F.col("instance.r").alias("results"),
    )


def measdata_instances(records: DataFrame) -> DataFrame:
    """The same rows from ``measData`` records; every measInfo and measValue counts.

    The day follows the instant in UTC; the node has no separate ``nedn``, so its
    name stands for both.
    """
    element = F.col("managedElement")
    info = records.select(
        _origin(records),
        element["_localDn"].alias("node"),
        F.posexplode("managedElement.measInfo").alias("mi_pos", "info"),
    )
    kept = ["source_file", "node", "mi_pos", "end", "duration", "measurement", "names"]
    block = info.select(
        *kept[:3],
        F.col("info.granPeriod._endTime").alias("end"),
        F.col("info.granPeriod._duration").alias("duration"),
        F.col("info._measInfoId").alias("measurement"),
        F.col("info.measType").alias("names"),
        F.col("info.measValue").alias("values"),
    )
    value = block.select(*kept, F.posexplode("values").alias("mv_pos", "instance"))
    end = F.col("end")
    return value.select(
        TM.date_id(TM.iso_instant(end)).alias("date_id"),
        TM.duration_seconds("duration").alias("granularity"),
        F.col("instance._measObjLdn").alias("moid"),
        F.col("node").alias("nedn"),
        "node",
        TM.iso_instant(end).alias("ropendtime"),
        TM.iso_instant(end).alias("utc_timestamp"),
        TM.iso_wall_clock(end).alias("local_timestamp"),
        "measurement",
        "source_file",
        F.struct(F.lit(0).alias("md_pos"), "mi_pos", "mv_pos").alias("source_pos"),
        "names",
        F.col("instance.r").alias("results"),
    )


LIST_COLUMNS = ["names", "names_distinct", "results"]


def mdc_counter_maps(records: DataFrame, index_base: int = 0) -> DataFrame:
    """Map form of ``mdc`` records: raw names and raw values in ``counters``."""
    counters = C.counter_map("names", "results", index_base, F.col("names_distinct"))
    return mdc_instances(records).withColumn("counters", counters).drop(*LIST_COLUMNS)


def measdata_counter_maps(records: DataFrame) -> DataFrame:
    """Map form of ``measData`` records."""
    counters = C.indexed_counter_map("names", "results")
    return measdata_instances(records).withColumn("counters", counters).drop(*LIST_COLUMNS)


def raw_counters(instances: DataFrame, index_base: int = 0) -> DataFrame:
    """Rows of instances per counter: ``counter_name_raw``, ``counter_value_raw``.

    Explodes the result list and looks each name up by position, which stays in
    generated code; no map is built.
    """
    results = C.last_results("names", "results", index_base, F.col("names_distinct"))
    kept = [c for c in instances.columns if c not in LIST_COLUMNS]
    exploded = instances.select(*kept, "names", F.explode_outer(results).alias("result"))
    return exploded.select(
        *kept,
        C.counter_name_at("names", "result._p", index_base).alias("counter_name_raw"),
        F.col("result._VALUE").alias("counter_value_raw"),
    ).filter(F.col("counter_name_raw").isNotNull())


def explode_counters(maps: DataFrame, names: Sequence[str] | None = None, counters: str = "counters") -> DataFrame:
    """Map form to one row per counter; only ``names`` when given.

    Wanted counters are picked before the explode, so the others make no rows.
    """
    wanted = F.col(counters)
    if names is not None:
        wanted = F.map_filter(wanted, lambda name, _: name.isin(list(names)))
    kept = [c for c in maps.columns if c != counters]
    rows = maps.select(*kept, F.explode_outer(wanted).alias("counter_name_raw", "counter_value_raw"))
    return rows.filter(F.col("counter_name_raw").isNotNull())


def long_counters(raw: DataFrame) -> DataFrame:
    """Canonical long rows: lower-case ``counter_name``, BIGINT ``counter_value``."""
    kept = [c for c in raw.columns if c not in ("counter_name_raw", "counter_value_raw")]
    return raw.select(
        *kept,
        F.lower("counter_name_raw").alias("counter_name"),
        C.first_integer("counter_value_raw").alias("counter_value"),
    )


def flatten_mdc(records: DataFrame, index_base: int = 0) -> DataFrame:
    """``mdc`` records to the long counter table.

    ``index_base`` is the number the file gives its first counter; 0 unless the
    file counts from 1.
    """
    return long_counters(raw_counters(mdc_instances(records), index_base))


def flatten_measdata(records: DataFrame) -> DataFrame:
    """``measData`` records to the long counter table."""
    return long_counters(explode_counters(measdata_counter_maps(records)))
