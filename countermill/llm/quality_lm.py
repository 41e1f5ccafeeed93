"""Quality by the perplexity of an interpolated modified Kneser-Ney model of bytes.

The model has orders 1 to ``ORDER`` over the bytes of trusted texts (label ``quality`` 1,
digits made equal). Counts of the highest order come from all of them; each lower order counts
the distinct n-grams of the next one that end in it. Counts are hash-partitioned tables:
grouped by suffix for the lower orders, by context for the totals, and joined on the context
for discounted shares. All n-grams are kept; a context's backoff weight is what their shares
leave.

Up to ``MODEL_ROWS`` n-grams of an order, the tables are broadcast and every text is scored
against them, with the distinct n-grams of a slice looked up once. Larger ones stay tables:
the distinct n-grams of all texts are joined to them order by order, and those of each text to
the log-probabilities found. A trusted text in ``HELD_OUT`` of ten folds is not counted; the quantile of
their perplexities, by language, is the threshold.

Defined results: a null or empty text has no perplexity and is not kept; a null language is a
language of its own; a language with fewer than ``MIN_TRUSTED`` held-out trusted texts takes
the threshold over all languages; without any such text there is no threshold and every text
with a perplexity is kept; repeated rows are scored one by one; several labels of a document
must all be 1; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countermill.llm.common import cut, small_side
from countermill.llm.wordhash import slices, text_buffers

ORDER = 5
MODEL_ROWS = 1 << 19
FOLDS, HELD_OUT = 10, 0
MIN_TRUSTED = 20
QUANTILE = 0.995
ACCURACY = 10_000
BROADCAST_ROWS = 2_000_000
_BEFORE = 0x02
_FLUSH = 1 << 21

_DIGITS = np.arange(256, dtype=np.uint64)
_DIGITS[0x30:0x3A] = 0x30


def _codes(raw: np.ndarray, offsets: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``ORDER`` bytes that end at each byte of some rows, as one number; a text is
    preceded by start bytes. With the rows' first positions."""
    at = offsets[begin : end + 1] - offsets[begin]
    data = raw[offsets[begin] : offsets[end]]
    pad = ORDER - 1
    padded = np.insert(_DIGITS[data], np.repeat(at[:-1], pad), _BEFORE)
    code = np.zeros(len(padded), dtype=np.uint64)
    for back in range(ORDER):
        code[back:] |= padded[: len(padded) - back] << np.uint64(8 * back)
    inside = np.ones(len(padded), dtype=bool)
    for k in range(pad):
        inside[at[:-1] + pad * np.arange(len(at) - 1) + k] = False
    return code[inside], at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        codes, counts = (np.concatenate(x) for x in zip(*held))
        found, inverse = np.unique(codes, return_inverse=True)
        return found, np.bincount(inverse, counts, len(found)).astype(np.int64)

    for batch in batches:
        offsets, raw = text_buffers(batch.column("text"))
        for begin, end in slices(offsets):
            found = np.unique(_codes(raw, offsets, begin, end)[0], return_counts=True)
            held.append(found)
            rows += len(found[0])
            if rows > _FLUSH:
                held = [merged()]
                rows = len(held[0][0])
                if rows > _FLUSH // 2:
                    codes, counts = held.pop()
                    rows = 0
                    yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(counts)], names=["code", "n"])
    if held:
        codes, counts = merged()
        yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(counts)], names=["code", "n"])


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ from how many n-grams occur one to four times."""
    n1, n2, n3, n4 = counts.agg(*(F.count_if(F.col("n") == i) for i in (1, 2, 3, 4))).first()
    if not (n1 and n2):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.1), k - 0.05) for k, d in enumerate(raw, 1)]


def count_tables(trusted: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order: n-grams with their discounted shares, (code, share), and contexts with
    their backoff weights, (context, left)."""
    counts = cut(trusted.select("text").mapInArrow(_count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")))
    tables = []
    for order in range(ORDER, 0, -1):
        d1, d2, d3 = _discounts(counts)
        context = F.shiftrightunsigned("code", 8)
        totals = counts.groupBy(context.alias("context")).agg(F.sum("n").alias("total"))
        kept = counts.withColumn("context", context)
        taken = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        shares = cut(kept.join(totals, "context").select("context", "code", ((F.col("n") - taken) / F.col("total")).alias("share")))
        left = cut(shares.groupBy("context").agg((1 - F.sum("share")).alias("left")))
        tables.append((shares.select("code", "share"), left))
        if order > 1:
            shorter = F.col("code").bitwiseAND(F.lit((1 << (8 * (order - 1))) - 1))
            counts = cut(counts.groupBy(shorter.alias("code")).agg(F.count("*").alias("n")))
    return tables[::-1]


def _collected(tables: list[tuple[DataFrame, DataFrame]]) -> list[tuple[np.ndarray, ...]]:
    out = []
    for pair in tables:
        table = []
        for frame in pair:
            keys, values = (c.to_numpy() for c in frame.toArrow().columns)
            by_key = np.argsort(keys)
            table += [keys[by_key].astype(np.uint64), values[by_key]]
        out.append(tuple(table))
    return out


def train(trusted: DataFrame) -> list[tuple[np.ndarray, ...]]:
    """For each order: n-grams and their discounted shares, contexts and their backoff weights;
    n-grams and contexts sorted."""
    return _collected(count_tables(trusted))


def _found(table: np.ndarray, values: np.ndarray, keys: np.ndarray, absent: float) -> np.ndarray:
    if len(table) == 0:
        return np.full(len(keys), absent)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], absent)


def log_probabilities(tables, codes: np.ndarray) -> np.ndarray:
    """Log-probability of the last byte of each code after the bytes before it."""
    p = np.full(len(codes), 1 / 256)
    for order, (grams, shares, contexts, left) in enumerate(tables, 1):
        code = codes & np.uint64((1 << (8 * order)) - 1)
        p = _found(grams, shares, code, 0.0) + _found(contexts, left, code >> np.uint64(8), 1.0) * p
    return np.log(np.maximum(p, 1e-12))


def _perplexities(model, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.value
        for batch in batches:
            offsets, raw = text_buffers(batch.column("text"))
            out = np.full(len(batch), np.nan)
            for begin, end in slices(offsets):
                codes, at = _codes(raw, offsets, begin, end)
                distinct, inverse = np.unique(codes, return_inverse=True)
                sums = np.concatenate(([0.0], np.cumsum(log_probabilities(tables, distinct)[inverse])))
                size = at[1:] - at[:-1]
                mean = (sums[at[1:]] - sums[at[:-1]]) / np.maximum(size, 1)
                out[begin:end] = np.where(size > 0, np.exp(-mean), np.nan)
            column = pa.array(out, from_pandas=True)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), column], names=[*columns, "perplexity"])

    return run


def _codes_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, code, n): distinct codes of each text."""
    for batch in batches:
        offsets, raw = text_buffers(batch.column("text"))
        for begin, end in slices(offsets):
            codes, at = _codes(raw, offsets, begin, end)
            rows = np.repeat(np.arange(begin, end), at[1:] - at[:-1])
            order = np.lexsort((codes, rows))
            codes, rows = codes[order], rows[order]
            new = np.flatnonzero(np.concatenate((np.ones(min(len(codes), 1), dtype=bool), (codes[1:] != codes[:-1]) | (rows[1:] != rows[:-1]))))
            counts = np.diff(np.append(new, len(codes)))
            arrays = [batch.column("digest").take(pa.array(rows[new])), pa.array(codes[new].view(np.int64)), pa.array(counts.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["digest", "code", "n"])


def _joined_perplexities(rows: DataFrame, tables: list[tuple[DataFrame, DataFrame]], columns: list[str]) -> DataFrame:
    """``columns`` and the perplexity of each text, by joins with tables of any size. Equal texts are
    scored together: their sums and sizes grow alike."""
    chances = rows.select("text").mapInArrow(_count, "code bigint, n bigint").select("code").distinct().withColumn("p", F.lit(1 / 256))
    for order, (shares, left) in enumerate(tables, 1):
        gram = F.col("code").bitwiseAND(F.lit((1 << (8 * order)) - 1))
        chances = chances.withColumn("_gram", gram).withColumn("_context", F.shiftrightunsigned(gram, 8))
        known = small_side(shares.withColumnRenamed("code", "_gram"), shares.count(), BROADCAST_ROWS)
        backoff = small_side(left.withColumnRenamed("context", "_context"), left.count(), BROADCAST_ROWS)
        chances = chances.join(known, "_gram", "left").join(backoff, "_context", "left")
        p = F.coalesce("share", F.lit(0.0)) + F.coalesce("left", F.lit(1.0)) * F.col("p")
        chances = chances.select("code", p.alias("p"))
    chances = cut(chances.select("code", F.log(F.greatest("p", F.lit(1e-12))).alias("logp")))
    digest = F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")
    of_texts = rows.select(digest, "text").mapInArrow(_codes_of_texts, "digest binary, code bigint, n bigint")
    sums = of_texts.join(chances, "code").groupBy("digest").agg(F.sum(F.col("n") * F.col("logp")).alias("s"), F.sum("n").alias("size"))
    found = sums.select("digest", F.exp(-F.col("s") / F.col("size")).alias("perplexity"))
    return rows.select(*columns, digest).join(found, "digest", "left").select(*columns, "perplexity")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, kept) of every document."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("_lang"), "lang")
    trust = cut(
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
        .select("doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == HELD_OUT).alias("held"))
    )
    trust = small_side(trust, trust.count(), BROADCAST_ROWS)
    tables = count_tables(rows.join(trust.where(~F.col("held")), "doc_id"))
    columns = ["doc_id", "_lang", "lang"]
    if max(shares.count() for shares, _ in tables) <= MODEL_ROWS:
        model = spark.sparkContext.broadcast(_collected(tables))
        found = rows.mapInArrow(_perplexities(model, columns), "doc_id bigint, _lang string, lang string, perplexity double")
    else:
        found = _joined_perplexities(rows, tables, columns)
    scored = cut(found.withColumn("perplexity", F.round("perplexity", 6)))
    held = cut(scored.join(trust.where("held"), "doc_id").where("perplexity is not null"))
    level = F.percentile_approx("perplexity", quantile, ACCURACY)
    overall = held.agg(level).first()[0]
    by_lang = held.groupBy("_lang").agg(level.alias("own"), F.count("*").alias("n")).where(F.col("n") >= MIN_TRUSTED)
    out = scored.join(small_side(by_lang, by_lang.count(), 10_000), "_lang", "left")
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))
    return out.select("doc_id", "lang", "perplexity", threshold.alias("threshold"), kept.alias("kept"))
