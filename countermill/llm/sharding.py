"""Shards by fixed virtual slots.

Each record is hashed to one of ``VIRTUAL_SLOTS`` slots for good. Bytes are summed for each
slot; a versioned table says which shard holds a slot. Rebalancing edits that table: it moves
slots from the fullest to the emptiest shard and appends a new version. Records never move
between slots, so a map version and the record decide the shard.

Only the slot sums and the map (``VIRTUAL_SLOTS`` rows each, whatever the input) are seen by
the driver. All else is DataFrame operations.

Defined results: a null text has size 1 and the checksum of the empty one; a null doc_id is
hashed by its text alone; repeated rows share a slot and get places of their own, in any
order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from countermill.llm.common import cut, small_side

SHARDS = 16
VIRTUAL_SLOTS = 4096
#: Parts of a virtual slot whose rows are numbered together.
SLOT_PARTS = 64
BROADCAST_ROWS = 500_000


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size in bytes plus 1, checksum and virtual slot of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return rows.withColumn("virtual_slot", virtual_slot(F.lit(VIRTUAL_SLOTS)))


def virtual_slot(slots: Column) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text_crc32"))), slots).cast("int")


def slot_bytes(rows: DataFrame) -> dict[int, int]:
    """Bytes of each virtual slot that has any."""
    return {r[0]: r[1] for r in rows.groupBy("virtual_slot").agg(F.sum("size")).collect()}


def initial_map(shards: int, slots: int = VIRTUAL_SLOTS) -> list[int]:
    """Version 1: slots dealt in turn."""
    return [slot % shards for slot in range(slots)]


def rebalanced(shard_of: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """A new version with near-equal bytes: while a slot exists whose move from the fullest
    to the emptiest shard brings the two closer, the best such slot moves."""
    shard_of = list(shard_of)
    load = [0] * shards
    held: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in enumerate(shard_of):
        load[shard] += sizes.get(slot, 0)
        held[shard].add(slot)
    while True:
        full, empty = load.index(max(load)), load.index(min(load))
        gap = load[full] - load[empty]
        fitting = [s for s in held[full] if 0 < sizes.get(s, 0) < gap]
        if not fitting:
            return shard_of
        best = min(fitting, key=lambda s: (abs(2 * sizes[s] - gap), s))
        held[full].remove(best)
        held[empty].add(best)
        load[full] -= sizes[best]
        load[empty] += sizes[best]
        shard_of[best] = empty


def grown(shard_of: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """A new version with one more shard, which takes slots from the others up to its fair
    share; no slot moves between the old ones."""
    shard_of = list(shard_of)
    load = [0] * (shards + 1)
    for slot, shard in enumerate(shard_of):
        load[shard] += sizes.get(slot, 0)
    fair = sum(load) / (shards + 1)
    for slot in sorted(range(len(shard_of)), key=lambda s: (-sizes.get(s, 0), s)):
        size, shard = sizes.get(slot, 0), shard_of[slot]
        if size and load[shards] + size <= fair and load[shard] - size >= fair * 0.98:
            load[shard] -= size
            load[shards] += size
            shard_of[slot] = shards
    return shard_of


def map_table(spark: SparkSession, versions: list[list[int]]) -> DataFrame:
    """(version, virtual_slot, shard), versions numbered from 1, stored in the shared folder."""
    rows = [(v, slot, shard) for v, shard_of in enumerate(versions, 1) for slot, shard in enumerate(shard_of)]
    return cut(spark.createDataFrame(rows, "version int, virtual_slot int, shard int").coalesce(1))


def assign(rows: DataFrame, shard_map: DataFrame) -> DataFrame:
    """``rows`` with shard and a gapless place in it.

    Rows are numbered within parts of a virtual slot; the part counts give each part its
    first place in the shard, so no shard is sorted whole.
    """
    rows = rows.join(F.broadcast(shard_map.select("virtual_slot", "shard")), "virtual_slot")
    part = F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit(1)), F.lit(SLOT_PARTS)).cast("int")
    rows = rows.withColumn("_part", part)
    counts = cut(rows.groupBy("shard", "virtual_slot", "_part").agg(F.count("*").alias("n")))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("virtual_slot", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("virtual_slot", "_part").orderBy("doc_id", "text_crc32")
    numbered = rows.withColumn("_row", F.row_number().over(inside) - 1)
    placed = numbered.join(small_side(firsts, counts.count(), BROADCAST_ROWS), ["virtual_slot", "_part"])
    return placed.withColumn("slot", F.col("_first") + F.col("_row")).drop("_part", "_first", "_row")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All documents with shard and place under the newest of two map versions, the first
    dealt in turn and the second rebalanced by bytes."""
    rows = cut(sized(docs))
    sizes = slot_bytes(rows)
    first = initial_map(shards)
    versions = map_table(docs.sparkSession, [first, rebalanced(first, sizes, shards)])
    newest = versions.where("version = 2")
    return assign(rows, newest).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.lit(2).alias("map_version"),
    )
