"""Find benchmark items inside documents by SimHash of item-sized windows.

1. A window is a run of as many words as an item has. Windows that share no 5-word shingle
   with an item have similarity 0 with all of them, so only windows aligned with a shared
   shingle are taken; that loses no match.
2. Each window and item gets a 128-bit SimHash of its words, long words weighing more.
3. Fingerprints are cut into ``RADIUS + 1`` blocks. Two within ``RADIUS`` bits agree in one
   block at least, so an equi join on (words, block, value) finds all of them. Items under
   ``SHORT`` words, whose fingerprints move more with each word, have ``SHORT_RADIUS``.
4. Those pairs are verified by the exact weighted Jaccard similarity of their 5-word
   shingles, a shingle weighing 1 / (distinct item texts that hold it). One that no item holds
   weighs as much as a shingle of the compared item does on average.

Words are runs of letters and digits in lower case. Everything is DataFrame operations.

Defined results: null and empty texts, and those under five words, match nothing, on either
side; repeated documents each give their rows; a null doc_id is carried as it is; repeated
items match each for itself; an empty table on either side gives no match; of several places
the most similar counts, of equal ones the first; other columns of the input are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countermill.llm.common import cut, small_side

SHINGLE = 5
RADIUS = 23
SHORT, SHORT_RADIUS = 40, 31
MIN_SIMILARITY = 0.75
#: A word weighs its length, at most so much.
MAX_WORD_WEIGHT = 8
#: Rows sent to all executors, at most; larger sides are shuffled.
BROADCAST_ROWS = 2_000_000

_NOT_WORD = "[^\\p{L}\\p{N}]+"
#: Bits of the 12 blocks of each 64-bit half, and of the 16 for short items.
_BLOCK_BITS = (6, 6, 6, 6, 5, 5, 5, 5, 5, 5, 5, 5)
_SHORT_BLOCK_BITS = (4,) * 16


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _NOT_WORD), lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """A 64-bit hash for each run of five words; empty below five."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0))),
        lambda word, at: F.xxhash64(word, *(F.get(words, at + k) for k in range(1, SHINGLE))),
    )


def _with_key(docs: DataFrame) -> DataFrame:
    """Equal rows share a key; rows of one id with different texts do not."""
    return docs.withColumn("_key", F.xxhash64("doc_id", "text"))


def fingerprints(frame: DataFrame, keys: list[str], words: str) -> DataFrame:
    """``keys`` and the two halves of the weighted 128-bit SimHash of ``words``.

    Each sum holds the set-bit weights of two bits, in its lower and upper 32 bits.
    """
    rows = frame.select(*keys, F.explode(words).alias("_word")).select(
        *keys,
        F.least(F.length("_word"), F.lit(MAX_WORD_WEIGHT)).cast("long").alias("_weight"),
        F.xxhash64("_word").alias("_h0"),
        F.xxhash64("_word", F.lit(1)).alias("_h1"),
    )
    lanes = F.lit((1 << 32) + 1)
    sums = [
        F.sum(F.shiftrightunsigned(f"_h{half}", bit).bitwiseAND(lanes) * F.col("_weight")).alias(f"_s{half}_{bit}")
        for half in (0, 1)
        for bit in range(32)
    ]
    summed = rows.groupBy(*keys).agg(F.sum("_weight").alias("_all"), *sums)

    def half_of(half: int) -> Column:
        bits = []
        for bit in range(32):
            both = F.col(f"_s{half}_{bit}")
            low, high = both.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(both, 32)
            for at, weight in ((bit, low), (bit + 32, high)):
                value = -(1 << 63) if at == 63 else 1 << at
                bits.append(F.when(weight * 2 > F.col("_all"), F.lit(value).cast("long")).otherwise(F.lit(0).cast("long")))
        return reduce(lambda x, y: x.bitwiseOR(y), bits)

    return summed.select(*keys, half_of(0).alias("f0"), half_of(1).alias("f1"))


def _blocks() -> Column:
    """The 24 block values (32 below ``SHORT`` words), each with its number in the upper
    bits."""

    def values(widths: tuple[int, ...]) -> Column:
        out = []
        for half in ("f0", "f1"):
            at = 0
            for bits in widths:
                value = F.shiftrightunsigned(half, at).bitwiseAND(F.lit((1 << bits) - 1))
                out.append((value + F.lit(len(out) * 64)).cast("int"))
                at += bits
        return F.array(*out)

    return F.explode(F.when(F.col("length") < SHORT, values(_SHORT_BLOCK_BITS)).otherwise(values(_BLOCK_BITS)))


def matches(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """(_key, item_id, start, similarity) of the best place of each item in each distinct
    document."""
    given = (
        bench.select("item_id", word_array(F.col("text")).alias("words"))
        .where(F.size("words") >= SHINGLE)
        .withColumns({"length": F.size("words"), "item": F.xxhash64(F.array_join("words", " "))})
    )
    ids = cut(given.select("item", "item_id").distinct())
    items = cut(given.drop("item_id").dropDuplicates(["item"]).withColumn("shingles", shingle_hashes(F.col("words"))))
    places = cut(items.select("item", "length", F.posexplode("shingles").alias("place", "shingle")))
    n_places = places.count()
    anchors = places.select("shingle", "length", "place").distinct()
    docs = docs.select("doc_id", "text")
    keyed = _with_key(docs).select("_key", word_array(F.col("text")).alias("words"))
    hits = (
        keyed.select("_key", F.posexplode(shingle_hashes(F.col("words"))).alias("at", "shingle"))
        .join(small_side(anchors, n_places, BROADCAST_ROWS), "shingle")
        .select("_key", "length", (F.col("at") - F.col("place")).alias("start"))
    )
    found = cut(hits.groupBy("_key").agg(F.collect_set(F.struct("length", "start")).alias("spots")))
    keys = found.select("_key")
    texts = _with_key(docs).join(small_side(keys, keys.count(), BROADCAST_ROWS), "_key", "left_semi")
    texts = texts.dropDuplicates(["_key"]).select("_key", word_array(F.col("text")).alias("words"))
    fitted = F.greatest(F.lit(0), F.least(F.col("spot.start"), F.size("words") - F.col("spot.length")))
    windows = cut(
        texts.join(found, "_key")
        .select("_key", "words", F.explode("spots").alias("spot"))
        .select("_key", F.col("spot.length").alias("length"), fitted.alias("start"), "words")
        .select("_key", "length", "start", F.slice("words", F.col("start") + 1, F.col("length")).alias("words"))
        .dropDuplicates(["_key", "length", "start"])
    )
    prints = fingerprints(windows, ["_key", "length", "start"], "words")
    item_prints = fingerprints(items, ["item", "length"], "words").select(
        "item", "length", F.col("f0").alias("g0"), F.col("f1").alias("g1"), _blocks().alias("block")
    )
    distance = F.bit_count(F.col("f0").bitwiseXOR(F.col("g0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("g1")))
    near = cut(
        prints.select("*", _blocks().alias("block"))
        .join(small_side(cut(item_prints), n_places, BROADCAST_ROWS), ["length", "block"])
        .where(distance <= F.when(F.col("length") < SHORT, SHORT_RADIUS).otherwise(RADIUS))
        .select("_key", "length", "start", "item")
        .distinct()
    )
    held = places.groupBy("shingle").agg((1 / F.count_distinct("item")).alias("weight"))
    counted = places.groupBy("item", "shingle").agg(F.count("*").alias("k")).join(held, "shingle")
    of_item = cut(counted)
    totals = of_item.groupBy("item").agg(F.sum(F.col("k") * F.col("weight")).alias("item_weight"), F.sum("k").alias("item_shingles"))
    mine = (
        windows.select("_key", "length", "start", F.explode(shingle_hashes(F.col("words"))).alias("shingle"))
        .groupBy("_key", "length", "start", "shingle")
        .agg(F.count("*").alias("n"))
        .join(small_side(held, n_places, BROADCAST_ROWS), "shingle", "left")
    )
    own = small_side(of_item.select("item", "shingle", "k"), n_places, BROADCAST_ROWS)
    shared = (
        near.join(mine, ["_key", "length", "start"])
        .join(own, ["item", "shingle"], "left")
        .groupBy("_key", "start", "item")
        .agg(
            F.coalesce(F.sum(F.col("weight") * F.least("n", F.coalesce("k", F.lit(0)))), F.lit(0.0)).alias("both"),
            F.coalesce(F.sum(F.col("weight") * F.col("n")), F.lit(0.0)).alias("held_weight"),
            F.sum(F.when(F.col("weight").isNull(), F.col("n")).otherwise(0)).alias("foreign"),
        )
        .join(small_side(totals, n_places, BROADCAST_ROWS), "item")
        .withColumn("window_weight", F.col("held_weight") + F.col("foreign") * F.col("item_weight") / F.col("item_shingles"))
    )
    similarity = F.col("both") / (F.col("window_weight") + F.col("item_weight") - F.col("both"))
    return (
        shared.withColumn("similarity", F.round(similarity, 6))
        .where(F.col("similarity") >= MIN_SIMILARITY)
        .groupBy("_key", "item")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"))
        .join(small_side(ids, ids.count(), BROADCAST_ROWS), "item")
        .select("_key", "item_id", (-F.col("best.back")).cast("long").alias("start"), "best.similarity")
    )


def contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, similarity): each benchmark item found in a document, with
    the word its best window starts at."""
    found = cut(matches(docs, bench))
    rows = _with_key(docs.select("doc_id", "text")).select("_key", "doc_id")
    return rows.join(small_side(found, found.count(), BROADCAST_ROWS), "_key").drop("_key")


def decontaminate(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents in which no benchmark item was found."""
    keys = cut(matches(docs.select("doc_id", "text"), bench).select("_key").distinct())
    rows = docs.select(F.xxhash64("doc_id", "text").alias("_key"), F.struct("*").alias("_row"))
    kept = rows.join(small_side(keys, keys.count(), BROADCAST_ROWS), "_key", "left_anti")
    return kept.select(*(F.col("_row")[c].alias(c) for c in docs.columns))
