"""Toxicity by two class-conditional Kneser-Ney models of words and word pairs.

P(w | v, class) discounts the class's counts and gives the freed mass to P(w | class), which
does the same with the documents that hold w and gives its freed mass to one backoff shared by
both classes. An expression whose document counts do not tell the classes apart (a
log-likelihood ratio test below ``SIGNIFICANT``) is left to that backoff altogether, with the
same probability in both. All others form the model. Up to ``MODEL_ROWS`` of an order it is
broadcast; a larger one stays a table, to which the distinct word pairs of all texts are joined.
Counts cover all labelled training documents.

The score of a text is a logistic function of the difference of its two log-likelihoods per
word (with ``PRIOR_WORDS`` neutral words added, so short texts stay near neutral). That
function is fitted on labelled documents the models did not see. Folds are
``crc32(doc_id) % 4``: 0 and 1 are counted, 3 calibrates, 2 is held out.

Defined results: null and empty texts get the score of a text without evidence; a document
without a label, or with a null one, is scored but teaches nothing; one with several labels is
toxic if any says so; a null doc_id is scored, not held out; without documents of both classes
in the training folds every score is the labels' share of toxic ones (0 without labels); repeated
rows are scored one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countermill.llm.common import cut, small_side
from countermill.llm.wordhash import BY_PUNCTUATION, ngrams, words

FOLDS = 4
COUNTED, CALIBRATING, HELD_OUT = (0, 1), 3, 2
DISCOUNT = 0.75
SIGNIFICANT = 15.0
MODEL_ROWS = 1 << 19
PRIOR_WORDS = 20
THRESHOLD = 0.3
#: Bins of the calibration histogram, and the differences it covers.
BINS, REACH = 4000, 8.0
BROADCAST_ROWS = 2_000_000
_FLUSH = 1 << 20


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(FOLDS))


def _documents(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for part in words(column, BY_PUNCTUATION):
        for i in range(len(part.first) - 1):
            yield part.row + i, part.hashes[part.first[i] : part.first[i + 1]]


def _places(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted table, -1 where it is not there."""
    if len(table) == 0:
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _counts(order: int, vocabulary):
    """Per task: occurrences and documents of each word (or pair of words, of those in the
    vocabulary where one is given), by class."""
    names = ["key", "before", "after", "n1", "n0", "d1", "d0"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value if vocabulary is not None else None
        held: list[tuple] = []
        rows = 0

        def emptied() -> pa.RecordBatch:
            nonlocal rows
            key, before, after, toxic, first = (np.concatenate(x) for x in zip(*held))
            held.clear()
            rows = 0
            found, at, inverse = np.unique(key, return_index=True, return_inverse=True)
            sums = [np.bincount(inverse, w, len(found)) for w in (toxic, 1 - toxic, first * toxic, first * (1 - toxic))]
            arrays = [pa.array(found.view(np.int64)), pa.array(before[at].view(np.int64)), pa.array(after[at].view(np.int64))]
            return pa.RecordBatch.from_arrays([*arrays, *(pa.array(s.astype(np.int64)) for s in sums)], names=names)

        for batch in batches:
            labels = batch.column("toxic").to_pylist()
            for i, hashes in _documents(batch.column("text")):
                key, before, after = hashes, hashes, hashes
                if order == 2:
                    if len(hashes) < 2:
                        continue
                    key, before, after = ngrams(hashes, 2), hashes[:-1], hashes[1:]
                    if known is not None:
                        inside = _places(known, hashes) >= 0
                        both = inside[1:] & inside[:-1]
                        key, before, after = key[both], before[both], after[both]
                if len(key) == 0:
                    continue
                new = np.zeros(len(key))
                new[np.unique(key, return_index=True)[1]] = 1
                held.append((key, before, after, np.full(len(key), labels[i], dtype=float), new))
                rows += len(key)
                if rows >= _FLUSH:
                    yield emptied()
        if held:
            yield emptied()

    return run, "key bigint, before bigint, after bigint, n1 bigint, n0 bigint, d1 bigint, d0 bigint"


def _ratio_test(toxic: int, ordinary: int) -> Column:
    """Twice the log-likelihood ratio of document counts d1 and d0 against equal shares."""
    out = F.lit(0.0)
    both = F.col("d1") + F.col("d0")
    for own, n in (("d1", toxic), ("d0", ordinary)):
        without = F.lit(n) - F.col(own)
        expected = both * (n / (toxic + ordinary))
        for seen, due in ((F.col(own), expected), (without, F.lit(n) - expected)):
            out = out + F.when((seen > 0) & (due > 0), 2 * seen * F.log(seen / due)).otherwise(0.0)
    return out


def _count_table(texts: DataFrame, order: int, words_table: DataFrame, vocabulary, sizes: dict[int, int]) -> DataFrame:
    """All significant expressions with their counts; pairs are those of words in ``words_table``,
    which ``vocabulary`` has as an array where it is small."""
    sums = [F.sum(c).alias(c) for c in ("n1", "n0", "d1", "d0")]
    ends = [F.min(c).alias(c) for c in ("before", "after")]
    counted = texts.mapInArrow(*_counts(order, vocabulary)).groupBy("key").agg(*ends, *sums)
    tested = counted.withColumn("g", _ratio_test(sizes[1], sizes[0])).where(F.col("g") >= SIGNIFICANT).drop("g")
    if order == 2 and vocabulary is None:
        for end in ("before", "after"):
            tested = tested.join(words_table.select(F.col("key").alias(end)), end, "left_semi")
    return cut(tested.select(*counted.columns))


def _collected(table: DataFrame) -> dict[str, np.ndarray]:
    """The columns of a table, sorted by key."""
    found = {c: x.to_numpy() for c, x in zip(table.columns, table.toArrow().columns)}
    by_key = np.argsort(found["key"].view(np.uint64))
    found = {c: x[by_key] for c, x in found.items()}
    return found | {c: found[c].view(np.uint64) for c in ("key", "before")}


def _discounted(counts: np.ndarray, documents: int) -> tuple[np.ndarray, float]:
    """Discounted shares, and the share that was taken off. All expressions outside the model
    count as one more, which every document holds."""
    taken = np.minimum(counts, DISCOUNT)
    total = float(counts.sum()) + documents
    return (counts - taken) / total, (float(taken.sum()) + DISCOUNT) / total


class Model:
    """Log-ratios of the two models: of each word, of each pair, and of a word's backoff."""

    def __init__(self, single: dict[str, np.ndarray], pairs: dict[str, np.ndarray], sizes: dict[int, int]) -> None:
        self.words, self.pairs = single["key"], pairs["key"]
        shared = (single["d1"] + single["d0"]).astype(float)
        shared /= max(shared.sum(), 1.0)
        by_class = []
        for c in ("1", "0"):
            own, freed = _discounted(single[f"d{c}"].astype(float), sizes[int(c)])
            by_class.append(own + freed * shared)
        p1, p0 = by_class
        self.word_ratio = np.log(p1) - np.log(p0) if len(p1) else np.zeros(0)
        # pairs: the word after is not stored, so the ratio of pair and backoff is kept
        before = _places(self.words, pairs["before"])
        good = before >= 0
        left, self.left_mass = [], []
        for c in ("1", "0"):
            count = pairs[f"n{c}"].astype(float)
            total = np.maximum(single[f"n{c}"].astype(float), 1.0)
            kept = np.where(good, (count - np.minimum(count, DISCOUNT)) / total[before], 0.0) if len(count) else count
            used = np.bincount(before[good], kept[good], len(self.words))
            self.left_mass.append(np.clip(1.0 - used, 0.05, 1.0))
            left.append(kept)
        self.kept1, self.kept0 = left
        self.p1, self.p0 = p1, p0
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(self.pairs >> np.uint64(44)).astype(np.int64)] = True

    def difference(self, hashes: np.ndarray) -> np.ndarray:
        """Log P(toxic model) less log P(ordinary model) of each word of a sequence of words
        (callers cut sequences of several texts themselves)."""
        at = _places(self.words, hashes)
        known = at >= 0
        out = np.where(known, self.word_ratio[at], 0.0) if len(self.words) else np.zeros(len(hashes))
        if len(hashes) < 2 or len(self.pairs) == 0:
            return out
        key = ngrams(hashes, 2)
        after = np.flatnonzero(known[1:] & known[:-1])
        v, w = at[after], at[after + 1]
        back1, back0 = self.left_mass[0][v] * self.p1[w], self.left_mass[1][v] * self.p0[w]
        key = key[after]
        maybe = np.flatnonzero(self.filter[(key >> np.uint64(44)).astype(np.int64)])
        place = _places(self.pairs, key[maybe])
        hit = place >= 0
        back1[maybe[hit]] += self.kept1[place[hit]]
        back0[maybe[hit]] += self.kept0[place[hit]]
        out[after + 1] = np.log(back1) - np.log(back0)
        return out


def _per_word(model, columns: list[str]):
    """Appends the difference of log-likelihoods per word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer: Model = model.value
        for batch in batches:
            out = np.zeros(len(batch))
            for part in words(batch.column("text"), BY_PUNCTUATION):
                single = scorer.difference(part.hashes)
                # the first word of a text has no word before it
                firsts = part.first[:-1][part.first[:-1] < part.first[1:]]
                at = _places(scorer.words, part.hashes[firsts])
                single[firsts] = np.where(at >= 0, scorer.word_ratio[at], 0.0) if len(scorer.words) else 0.0
                sums = np.concatenate(([0.0], np.cumsum(single)))
                counts = part.first[1:] - part.first[:-1]
                rows = slice(part.row, part.row + len(counts))
                out[rows] = (sums[part.first[1:]] - sums[part.first[:-1]]) / (counts + PRIOR_WORDS)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(out)], names=[*columns, "x"])

    return run


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, key, first, before, word, n): distinct pairs of words that follow each other in a
    text, by their hash, and its first word, which has none before it."""
    for batch in batches:
        for i, hashes in _documents(batch.column("text")):
            if len(hashes) == 0:
                continue
            found, at, n = np.unique(ngrams(hashes, 2) if len(hashes) > 1 else hashes[:0], return_index=True, return_counts=True)
            numbers = [np.append(hashes[:1], found), np.append(hashes[:1], hashes[at]), np.append(hashes[:1], hashes[at + 1])]
            first = np.arange(len(found) + 1) == 0
            key, before, word = (x.astype(np.uint64).view(np.int64) for x in numbers)
            key, before, word, first = pa.array(key), pa.array(before, mask=first), pa.array(word), pa.array(first)
            digest = batch.column("digest").take(pa.array(np.full(len(key), i)))
            counts = pa.array(np.append(1, n).astype(np.int64))
            yield pa.RecordBatch.from_arrays([digest, key, first, before, word, counts], names=["digest", "key", "first", "before", "word", "n"])


def _model_tables(single: DataFrame, pairs: DataFrame, sizes: dict[int, int]) -> tuple[DataFrame, DataFrame]:
    """:class:`Model` as tables: words with their probabilities and backoff masses, pairs with
    what is kept of them."""
    totals = single.agg(
        F.sum(F.col("d1") + F.col("d0")).alias("all"),
        *[F.sum(f"d{c}").alias(f"sum{c}") for c in "10"],
        *[F.sum(F.least(f"d{c}", F.lit(DISCOUNT))).alias(f"taken{c}") for c in "10"],
    ).first()
    shared = (F.col("d1") + F.col("d0")) / max(totals["all"] or 0, 1)
    chances = []
    for c in "10":
        total = float(totals[f"sum{c}"] or 0) + sizes[int(c)]
        freed = ((totals[f"taken{c}"] or 0.0) + DISCOUNT) / total
        chances.append(((F.col(f"d{c}") - F.least(f"d{c}", F.lit(DISCOUNT))) / total + freed * shared).alias(f"p{c}"))
    owners = single.select(F.col("key").alias("before"), F.col("n1").alias("of1"), F.col("n0").alias("of0"))
    kept = [((F.col(f"n{c}") - F.least(f"n{c}", F.lit(DISCOUNT))) / F.greatest(f"of{c}", F.lit(1))).alias(f"kept{c}") for c in "10"]
    kept_pairs = cut(pairs.join(owners, "before").select("key", "before", *kept))
    used = kept_pairs.groupBy(F.col("before").alias("key")).agg(*[F.sum(f"kept{c}").alias(f"used{c}") for c in "10"])
    left = [F.greatest(F.lit(0.05), F.least(F.lit(1.0), 1 - F.coalesce(f"used{c}", F.lit(0.0)))).alias(f"left{c}") for c in "10"]
    return cut(single.select("key", *chances).join(used, "key", "left").select("key", "p1", "p0", *left)), kept_pairs.drop("before")


def _joined_per_word(frame: DataFrame, tables: tuple[DataFrame, DataFrame], columns: list[str]) -> DataFrame:
    """``columns`` and ``x`` as :func:`_per_word` gives it, by joins with tables of any size. Equal
    texts are scored together: every text has one first word, which tells how many there are."""
    model, kept = tables
    digest = F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")
    schema = "digest binary, key bigint, first boolean, before bigint, word bigint, n bigint"
    found = frame.select(digest, "text").mapInArrow(_occurrences, schema)
    after = model.select(F.col("key").alias("word"), "p1", "p0")
    before = model.select(F.col("key").alias("before"), "left1", "left0")
    distinct = found.groupBy("key").agg(F.min("before").alias("before"), F.min("word").alias("word"))
    known = distinct.join(after, "word").join(before, "before", "left").join(kept, "key", "left")
    # Without a known word before it, a word has the chances of the word alone. A pair that is kept
    # has a known word before it.
    back = [F.coalesce(f"left{c}", F.lit(1.0)) * F.col(f"p{c}") + F.coalesce(f"kept{c}", F.lit(0.0)) for c in "10"]
    differences = cut(known.select("key", (F.log(back[0]) - F.log(back[1])).alias("d")))
    sums = found.join(differences, "key", "left").groupBy("digest").agg(
        F.sum(F.col("n") * F.coalesce("d", F.lit(0.0))).alias("s"), F.sum("n").alias("size"), F.count_if("first").alias("copies")
    )
    x = (F.col("s") / F.col("copies")) / (F.col("size") / F.col("copies") + PRIOR_WORDS)
    per_text = sums.select("digest", x.alias("x"))
    return frame.select(*columns, digest).join(per_text, "digest", "left").select(*columns, F.coalesce("x", F.lit(0.0)).alias("x"))


def _logistic(x: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps on weighted counts, lightly held to (10, -2)."""
    design = np.stack([x, np.ones_like(x)])
    beta, prior = np.array([10.0, -2.0]), np.array([10.0, -2.0])
    hold = np.diag([1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ design, -30, 30)))
        n = toxic + ordinary
        gradient = design @ (toxic - n * p) - hold @ (beta - prior)
        step = np.linalg.solve((design * (n * p * (1 - p))) @ design.T + hold, gradient)
        beta = beta + np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    known = cut(
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .withColumn("fold", fold(F.col("doc_id")))
        .where(F.col("fold") != HELD_OUT)
    )
    learning = small_side(known, known.count(), BROADCAST_ROWS)
    labelled = cut(texts.join(learning, "doc_id").select("text", "toxic", "fold"))
    counted = labelled.where(F.col("fold").isin(*COUNTED)).select("text", "toxic")
    sizes = {r[0]: r[1] for r in counted.groupBy("toxic").count().collect()}
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    if len(sizes) < 2:
        share = labelled.agg(F.avg("toxic")).first()[0] or 0.0
        flat = F.lit(float(share))
        return texts.select("doc_id", held_out.alias("held_out"), flat.alias("score"), (flat >= THRESHOLD).cast("int").alias("predicted"))
    single = _count_table(counted, 1, None, None, sizes)
    few = single.count() <= MODEL_ROWS
    known = _collected(single) if few else None
    pairs = _count_table(counted, 2, single, spark.sparkContext.broadcast(known["key"]) if few else None, sizes)
    if few and pairs.count() <= MODEL_ROWS:
        model = spark.sparkContext.broadcast(Model(known, _collected(pairs), sizes))

        def per_word(frame: DataFrame, column: str, kind: str) -> DataFrame:
            return frame.mapInArrow(_per_word(model, [column]), f"{column} {kind}, x double")
    else:
        tables = _model_tables(single, pairs, sizes)

        def per_word(frame: DataFrame, column: str, kind: str) -> DataFrame:
            return _joined_per_word(frame, tables, [column])

    calibrating = labelled.where(F.col("fold") == CALIBRATING).select("text", "toxic")
    seen = per_word(calibrating, "toxic", "int")
    bin_of = F.floor((F.greatest(F.lit(-REACH), F.least(F.lit(REACH), F.col("x"))) + REACH) * (BINS / (2 * REACH)))
    found = seen.groupBy(bin_of.alias("bin")).agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).toArrow()
    at, toxic, ordinary = (np.asarray(c.to_numpy(), dtype=float) for c in found.columns)
    slope, intercept = _logistic((at + 0.5) * (2 * REACH / BINS) - REACH, toxic, ordinary)
    scored = per_word(texts, "doc_id", "bigint")
    p = F.round(1 / (1 + F.exp(-(F.col("x") * slope + intercept))), 6)
    return scored.select(
        "doc_id", held_out.alias("held_out"), p.alias("score"), (p >= THRESHOLD).cast("int").alias("predicted")
    )
