"""Exact Jaccard self-join of word n-gram sets, as classes of linked documents.

1. Equal sets become one node, so copies cost one row each.
2. Nodes meet where they share an n-gram of their prefixes. Prefixes hold the rarest
   n-grams (a bounded list of the most frequent ones only fixes the order, which any order
   may do without losing a pair); a single-node n-gram is dropped while its rows stream by.
   Prefixes are ``SHARED - 1`` longer than needed, so that a pair must share ``SHARED`` of
   their n-grams (or what its sets need, if fewer).
3. Each node of an n-gram is first compared with one hub of it. What is linked is one class,
   whose inner pairs need no comparison any more.
4. What then still meets from different classes is compared in size-banded tiles. An n-gram
   belongs to the first of its nodes by a fixed ranking, and a tile holds the nodes of all
   n-grams of one owner and size band, each once, in blocks of ``BLOCK_ROWS``: nodes that share
   many n-grams meet in few tiles.
5. Every comparison first takes the bitmaps: their differing bits bound the overlap from
   above. A tile says which of its nodes have a pair that may reach the threshold; only these
   get their sorted hash arrays, which decide. Of a tile's links those are given that join
   classes, fewer than it has nodes.

N-grams are 64-bit hashes, nodes 64-bit hashes of whole sets.

Defined results: a null or empty text, or one without words, has an empty set, n_shingles
0 and itself as class; fewer words than n make one n-gram; repeated rows are copies and
each gives a row; a null doc_id takes part but never names a class unless the class has no
other (then null); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countermill.llm.common import cut, small_side
from countermill.llm.components import components
from countermill.llm.wordhash import mix, ngram_sets

N = 5
PERCENT = 75
SHARED = 4
#: Numbers of hub rankings in the rounds before all remaining pairs are taken.
HUB_ROUNDS = (1,)
#: The most frequent n-grams whose counts order the prefixes: 16 bytes each.
ORDERING_NGRAMS = 1 << 17
#: N-grams gathered in a task before their counts are passed on.
COUNT_ROWS = 1 << 20
#: An n-gram with more rows is dealt to several tasks.
HOT_ROWS = 100_000
#: Rows and n-grams of a block; a tile holds two at most.
BLOCK_ROWS = 1024
BLOCK_GRAMS = 1 << 21
#: Bits for each n-gram where a tile has the n-grams themselves: hardly any pair passes that is no link.
WIDE_SPREAD = 16
#: Document ids that are sent to all executors, at most; more are joined by shuffle.
BROADCAST_IDS = 2_000_000
_FLUSH_ROWS = 10_000


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _node(found: np.ndarray) -> int:
    """Hash of a whole set, as signed long."""
    total = mix(found).sum(dtype=np.uint64) + np.uint64(len(found))
    return int(mix(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def _bitmap(found: np.ndarray, spread: int = 2) -> bytes:
    """One bit for each n-gram, in a width of at least ``spread`` times the set size."""
    width = max(128, 1 << int(spread * len(found) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(found & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _describe(n: int):
    """Per document its node, set size and bitmap (kind 0); per task n-grams found in several
    documents, with counts (kind 1)."""
    schema = pa.schema(
        [("kind", pa.int8()), ("doc_id", pa.int64()), ("x", pa.int64()), ("n", pa.int64()), ("bits", pa.binary())]
    )

    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(sets), return_counts=True)
        many = counts > 1
        k = int(many.sum())
        columns = [pa.array(np.ones(k, np.int8)), pa.nulls(k, pa.int64()), _signed(keys[many]), pa.array(counts[many])]
        return pa.RecordBatch.from_arrays([*columns, pa.nulls(k, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, seen = [], 0, set()
        for batch in batches:
            nodes, sizes = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            bits: list[bytes | None] = [None] * len(batch)
            for i, found in ngram_sets(batch.column("text"), n):
                if len(found):
                    nodes[i], sizes[i], bits[i] = _node(found), len(found), _bitmap(found)
                    if nodes[i] not in seen:
                        seen.add(nodes[i])
                        held.append(found)
                        rows += len(found)
                if rows >= COUNT_ROWS:
                    yield counted(held)
                    held, rows, seen = [], 0, set()
            kinds = pa.array(np.zeros(len(batch), np.int8))
            columns = [kinds, batch.column("doc_id"), pa.array(nodes), pa.array(sizes), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        if held:
            yield counted(held)

    return run, "kind tinyint, doc_id bigint, x bigint, n bigint, bits binary"


def _prefixes(n: int, percent: int, order):
    """(key, salt, node, size) of each prefix n-gram; salt is -1 but for hot ones."""
    schema = pa.schema([("key", pa.int64()), ("salt", pa.int32()), ("node", pa.int64()), ("size", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = order.value
        seen: set[int] = set()
        for batch in batches:
            keys, nodes, sizes = [], [], []
            for _, found in ngram_sets(batch.column("text"), n):
                if len(found) == 0:
                    continue
                node = _node(found)
                if node in seen:
                    continue
                seen.add(node)
                take = min(len(found), len(found) + (-percent * len(found)) // 100 + SHARED)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
                    count = np.where(frequent[at] == found, counts[at], 0)
                    if count.any():
                        found = found[np.argsort(count, kind="stable")]
                keys.append(found[:take])
                nodes.append(node)
                sizes.append((len(found), len(keys[-1])))
            if len(seen) > 2_000_000:
                seen.clear()
            if not keys:
                continue
            key = np.concatenate(keys)
            size, times = (np.array(x) for x in zip(*sizes))
            node = np.repeat(np.array(nodes, dtype=np.int64), times)
            salt = np.full(len(key), -1, dtype=np.int32)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)
                hot = (frequent[at] == key) & (counts[at] > HOT_ROWS)
                salt[hot] = node[hot] % (counts[at][hot] // HOT_ROWS + 1)
            yield pa.RecordBatch.from_arrays(
                [_signed(key), pa.array(salt), pa.array(node), pa.array(np.repeat(size, times).astype(np.int32))],
                schema=schema,
            )

    return run, "key bigint, salt int, node bigint, size int"


def _without_singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and node, without repeated rows and keys of one node only.
    Holds back one row between batches. Salted rows pass, their key is known to be hot."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("size", pa.int32())])
    held, met = None, False
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if held is not None:
            columns = [np.concatenate((h, c)) for h, c in zip(held, columns)]
        key, salt, node, size = columns
        if len(key) == 0:
            continue
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, salt, node, size = key[new], salt[new], node[new], size[new]
        same = key[1:] == key[:-1]
        keep = salt >= 0
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= met
        last = len(key) - 1
        held, met = [x[last:] for x in (key, salt, node, size)], bool(keep[last])
        keep[last] = False
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (key, node, size)], schema=schema)
    if held is not None and met:
        yield pa.RecordBatch.from_arrays([pa.array(held[i]) for i in (0, 2, 3)], schema=schema)


def _gram_lists(n: int):
    """Each distinct set of a task as its node and sorted hashes."""
    schema = pa.schema([("node", pa.int64()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows: list[tuple[int, bytes]] = []
            size = 0
            for _, found in ngram_sets(batch.column("text"), n):
                if len(found) and (node := _node(found)) not in seen:
                    seen.add(node)
                    rows.append((node, found.tobytes()))
                    size += len(found)
                if size >= COUNT_ROWS // 4:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
            if len(seen) > 2_000_000:
                seen.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), schema)], schema=schema)

    return run, "node bigint, grams binary"


def may_reach(bits_a: list[bytes], bits_b: list[bytes], a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the bitmaps leave room for the similarity; never false for a pair that has it.

    Each differing bit is an n-gram that only one side has, so the overlap is at most half
    of the sizes' sum less the differing bits. The wider bitmap is folded first.
    """
    out = np.zeros(len(bits_a), dtype=bool)
    widths_a, widths_b = np.array([len(x) for x in bits_a]), np.array([len(x) for x in bits_b])
    shapes = widths_a * (1 << 32) + widths_b
    for shape in np.unique(shapes):
        rows = np.flatnonzero(shapes == shape)
        sides = []
        for bits in (bits_a, bits_b):
            sides.append(np.frombuffer(b"".join([bits[i] for i in rows]), dtype=np.uint8).reshape(len(rows), -1))
        width = min(s.shape[1] for s in sides)
        x, y = (np.bitwise_or.reduce(s.reshape(len(rows), -1, width), axis=1) for s in sides)
        differing = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
        both = a[rows].astype(np.int64) + b[rows]
        out[rows] = (100 + percent) * ((both - differing) // 2) >= percent * both
    return out


def _prune(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(c).to_numpy() for c in ("size_a", "size_b")]
            keep = may_reach(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), *sizes, percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run, "a bigint, b bigint"


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have the similarity."""
    if len(x) > len(y):
        x, y = y, x
    shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _exact(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("grams_a"), batch.column("grams_b")):
                keep.append(_similar(*(np.frombuffer(side.as_buffer(), dtype=np.uint64) for side in (a, b)), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run, "a bigint, b bigint"


def _fits(i: int, size: np.ndarray, group: np.ndarray, part: np.ndarray, guest: np.ndarray, diagonal: bool, percent: int) -> np.ndarray:
    """Later rows of a tile that row i is to be compared with: of another class, of sizes that
    allow the similarity. Pairs are taken within a diagonal tile, else between its two parts;
    a guest (row of the next smaller band) only meets own rows."""
    fits = (group[i + 1 :] != group[i]) & ~(guest[i + 1 :] & guest[i])
    if not diagonal:
        fits &= part[i + 1 :] != part[i]
    small, large = np.minimum(size[i + 1 :], size[i]), np.maximum(size[i + 1 :], size[i])
    return np.flatnonzero(fits & (100 * small >= percent * large)) + i + 1


def _near(maps: np.ndarray, i: int, j: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """Those of rows j whose bitmaps leave room for the similarity with row i."""
    both = size[j] + size[i]
    differing = np.bitwise_count(maps[j] ^ maps[i]).sum(axis=1, dtype=np.int64)
    return j[(100 + percent) * ((both - differing) // 2) >= percent * both]


def _folded(bits: list[bytes]) -> np.ndarray:
    """Bitmaps of a tile in the width of its narrowest."""
    width = min(map(len, bits))
    return np.stack([np.bitwise_or.reduce(np.frombuffer(x, dtype=np.uint8).reshape(-1, width)) for x in bits])


_MEMBER = pa.schema(
    [("tile", pa.int64()), ("node", pa.int64()), ("size", pa.int32()), ("class", pa.int64())]
    + [("part", pa.int32()), ("guest", pa.bool_()), ("diagonal", pa.bool_())]
)
_MEMBER_COLUMNS = "tile bigint, node bigint, size int, class bigint, part int, guest boolean, diagonal boolean"


def _by_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of each tile with several; rows come sorted by tile."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if held and held[0][0] != row[0]:
                if len(held) > 1:
                    yield held
                held = []
            held.append(row)
    if len(held) > 1:
        yield held


def _tile_arrays(rows: list[tuple]) -> tuple:
    _, node, size, group, part, guest, diagonal, _ = zip(*rows)
    node, size, group = (np.array(x, dtype=np.int64) for x in (node, size, group))
    return node, size, group, np.array(part), np.array(guest), diagonal[0]


def _near_members(percent: int):
    """Rows of each tile, given with bitmaps, that have a partner there by their bitmaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for rows in _by_tile(batches):
            _, size, *place = _tile_arrays(rows)
            maps, met = _folded([r[-1] for r in rows]), np.zeros(len(rows), dtype=bool)
            for i in range(len(rows) - 1):
                j = _fits(i, size, *place, percent)
                j = _near(maps, i, j, size, percent) if len(j) else j
                met[j] = True
                met[i] |= len(j) > 0
            found += [rows[i][:-1] for i in np.flatnonzero(met)]
            if len(found) >= _FLUSH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*found), _MEMBER)], schema=_MEMBER)
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*found), _MEMBER)], schema=_MEMBER)

    return run, _MEMBER_COLUMNS


def _tile_links(percent: int):
    """Links of each tile, given with sorted hashes, that join classes not joined there yet."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        node, size, group, *place = _tile_arrays(rows)
        grams = [np.frombuffer(r[-1], dtype=np.uint64) for r in rows]
        maps = _folded([_bitmap(g, WIDE_SPREAD) for g in grams])
        for i in range(len(rows) - 1):
            j = _fits(i, size, group, *place, percent)
            for k in _near(maps, i, j, size, percent) if len(j) else j:
                if group[k] != group[i] and _similar(grams[i], grams[k], percent):
                    group[group == group[k]] = group[i]
                    yield int(node[i]), int(node[k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_tile(batches):
            if found := list(links(rows)):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], schema=schema)

    return run, "a bigint, b bigint"


def _sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    for side in ("a", "b"):
        named = table.select(F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))
        pairs = pairs.join(named, side)
    return pairs


def _grams_of(needed: DataFrame, nodes: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """Sorted hashes of some nodes; only the texts of these are read in again."""
    ids = cut(nodes.join(needed, "node", "left_semi").select("doc_id").distinct())
    chosen = texts.join(small_side(ids, ids.count(), BROADCAST_IDS), "doc_id", "left_semi").select("text")
    nameless = texts.where("doc_id is null").select("text")
    # Tasks give a node once each, so one that stands in several tasks comes several times.
    found = chosen.union(nameless).mapInArrow(*_gram_lists(n)).join(needed, "node", "left_semi")
    return cut(found.groupBy("node").agg(F.first("grams").alias("grams")))


def _verify(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that have the similarity, by the n-grams of their texts."""
    pairs = cut(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    grams = _grams_of(needed, nodes, texts, n)
    return cut(_sides(pairs, grams, "grams").mapInArrow(*_exact(percent)))


def _hub_pairs(rows: DataFrame, rankings: int, percent: int) -> DataFrame:
    """Nodes of an n-gram with its first node by one of the rankings, where classes differ."""
    rank = F.xxhash64("node", F.pmod(F.xxhash64("key"), F.lit(rankings)), F.lit(rankings))
    hubs = rows.groupBy("key").agg(F.min(F.struct(rank.alias("rank"), "node", "size", "class")).alias("hub"))
    larger = F.greatest("size", "hub.size")
    pairs = rows.join(hubs, "key").where(
        (F.col("class") != F.col("hub.class")) & (F.least("size", "hub.size") * 100 >= larger * percent)
    )
    ends = F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")
    # a hub meets a node at few of the n-grams they share: no count is asked for beyond two
    counted = pairs.select(*ends, larger.alias("size")).groupBy("a", "b").agg(F.count("*").alias("k"), F.max("size").alias("size"))
    return counted.where(F.col("k") >= F.least(F.lit(2), F.ceil(F.col("size") * percent / 100))).select("a", "b")


def _mixed(meets: DataFrame, classes: DataFrame | None, percent: int) -> DataFrame:
    """The rows of n-grams at which nodes of different classes meet, with their class.

    A node that meets others at fewer n-grams than any pair must share has no link left and goes.
    """
    if classes is None:
        rows = meets.withColumn("class", F.col("node"))
    else:
        rows = meets.drop("class").join(classes, "node", "left").select(
            "key", "node", "size", F.coalesce("component", "node").alias("class")
        )
    ends = rows.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    rows = cut(rows.join(ends.where("low < high").select("key"), "key"))
    counted = rows.groupBy("node").agg(F.count("*").alias("k"), F.max("size").alias("size"))
    needed = F.least(F.lit(SHARED), F.ceil(F.col("size") * percent / 100))
    return cut(rows.join(counted.where(F.col("k") >= needed).select("node"), "node"))


def _tiles(rows: DataFrame, percent: int) -> DataFrame:
    """Nodes dealt to tiles: by the owner of the n-grams they meet at and by size band, in
    blocks, each block with each. A node stands in its own band and, as a guest, in the next."""
    owners = rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("node").alias("rank"), "node"))["node"].alias("owner"))
    members = rows.join(owners, "key").select("owner", "node", "size", "class").distinct()
    band = F.floor(F.log(F.col("size").cast("double")) / float(np.log(100 / percent)) + 1e-9).cast("int")
    guests = F.explode(F.array(F.struct(F.lit(False).alias("guest"), band.alias("band")), F.struct(F.lit(True).alias("guest"), (band + 1).alias("band"))))
    members = cut(members.select("*", guests.alias("g")).select("owner", "node", "size", "class", "g.guest", "g.band"))
    counts = members.groupBy("owner", "band").agg(
        F.count("*").alias("n"), F.sum("size").alias("grams"), F.min("class").alias("low"), F.max("class").alias("high"),
        F.min("guest").alias("alone"),
    )
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("grams") / BLOCK_GRAMS))
    counts = counts.where("low < high and not alone").select("owner", "band", blocks.cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.join(counts, ["owner", "band"]).select("*", block.alias("block"), partner.alias("partner"))
    return dealt.select(
        F.xxhash64("owner", "band", F.least("block", "partner"), F.greatest("block", "partner")).alias("tile"),
        "node",
        "size",
        "class",
        (F.col("block") > F.col("partner")).cast("int").alias("part"),
        "guest",
        (F.col("block") == F.col("partner")).alias("diagonal"),
    )


def _rest_links(rows: DataFrame, nodes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Links that join all nodes of different classes that still meet and have the similarity."""

    def in_tiles(members: DataFrame) -> DataFrame:
        return members.repartition("tile").sortWithinPartitions("tile")

    tiles = _tiles(rows, percent).join(nodes.select("node", "bits"), "node").select(*_MEMBER.names, "bits")
    near = cut(in_tiles(tiles).mapInArrow(*_near_members(percent)))
    grams = _grams_of(near.select("node").distinct(), nodes, texts, n)
    found = near.join(grams, "node").select(*_MEMBER.names, "grams")
    return cut(in_tiles(found).mapInArrow(*_tile_links(percent)))


def linked_classes(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: documents link when the Jaccard
    similarity of their n-gram sets is at least ``percent``; the class is named by its
    smallest doc_id."""
    return _named_classes(docs, n, percent).drop("node")


def _named_classes(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """The same with the node of each row."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    described = cut(texts.mapInArrow(*_describe(n)))
    sets = described.where("kind = 0").select("doc_id", F.col("x").alias("node"), F.col("n").alias("n_shingles"), "bits")
    nodes = cut(
        sets.where("n_shingles > 0")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").cast("int").alias("size"), F.first("bits").alias("bits"))
    )
    frequent = (
        described.where("kind = 1")
        .groupBy("x")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "x")
        .limit(ORDERING_NGRAMS)
        .toArrow()
    )
    keys, counts = (c.to_numpy() for c in frequent.columns)
    by_key = np.argsort(keys.view(np.uint64))
    order = spark.sparkContext.broadcast((keys.view(np.uint64)[by_key], counts[by_key]))
    rows = texts.select("text").mapInArrow(*_prefixes(n, percent, order))
    meets = cut(
        rows.repartition("key", "salt")
        .sortWithinPartitions("key", "node")
        .mapInArrow(_without_singles, "key bigint, node bigint, size int")
    )
    classes, rows = None, meets
    for rankings in (*HUB_ROUNDS, 0):
        rows = _mixed(rows, classes, percent)
        if rankings:
            near = _sides(_hub_pairs(rows, rankings, percent), nodes, "size", "bits").mapInArrow(*_prune(percent))
            links = _verify(near, nodes, texts, n, percent)
        else:
            links = _rest_links(rows, nodes, texts, n, percent)
        if classes is not None:
            links = links.union(classes.select(F.col("node").alias("a"), F.col("component").alias("b")))
        classes = cut(components(links))
    named = sets.drop("bits").join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    class_of = classes.join(nodes.select("node", "doc_id"), "node").union(
        nodes.join(classes, "node", "left_anti").select("node", F.col("node").alias("component"), "doc_id")
    )
    names = cut(class_of.groupBy("component").agg(F.min("doc_id").alias("component_id")))
    names = small_side(names, names.count(), BROADCAST_IDS)
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return named.join(names, "component", "left").select("doc_id", "node", "n_shingles", own.alias("component_id"))


def _row_nodes(n: int):
    """Appends the node of each text; 0 without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = np.zeros(len(batch), np.int64)
            for i, found in ngram_sets(batch.column("text"), n):
                if len(found):
                    nodes[i] = _node(found)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes)], names=["doc_id", "text", "node"])

    return run, "doc_id bigint, text string, node bigint"


def one_of_each_class(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that another one of their class stands for.

    The one that stays has the class's smallest doc_id; of equal rows with that id one stays.
    Rows of one id with different texts are judged one by one. Rows without an id stay.
    """
    named = cut(_named_classes(docs, n, percent))
    gone = named.where("doc_id <> component_id").select("doc_id", "node").distinct()
    again = named.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1 and doc_id is not null").select("doc_id")
    gone, again = cut(gone), cut(again)
    again = small_side(again, again.count(), BROADCAST_IDS)
    single = gone.join(again, "doc_id", "left_anti").select("doc_id")
    once = docs.join(again, "doc_id", "left_anti")
    once = once.join(small_side(single, gone.count(), BROADCAST_IDS), "doc_id", "left_anti").select(*docs.columns)
    several = docs.join(again, "doc_id", "left_semi").select(*docs.columns)
    texts = several.select(F.col("doc_id").cast("long"), "text").distinct().mapInArrow(*_row_nodes(n))
    leaving = cut(texts.join(gone, ["doc_id", "node"], "left_semi").select("doc_id", "text"))
    kept = several.join(leaving, ["doc_id", "text"], "left_anti").select(*docs.columns)
    return once.union(kept.dropDuplicates(["doc_id", "text"]))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(
           regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM w WHERE len(w) > 0),
g AS (SELECT doc_id, unnest(s) AS g FROM s),
sizes AS (SELECT doc_id, len(s) AS n FROM s),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM g x JOIN g y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, b AS other FROM ways
  UNION
  SELECT r.doc_id, t.b FROM reach r JOIN ways t ON r.other = t.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(min(other), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach r ON r.doc_id = d.doc_id
GROUP BY d.doc_id, n
"""
