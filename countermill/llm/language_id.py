"""Language of texts by Bayesian fusion of four kinds of evidence.

1. Text: byte trigrams (hashed to ``BUCKETS``) under one multinomial for each language,
   counted over all texts that declare it. Trigrams overlap, so the log-likelihood is
   tempered.
2. Declared language: P(declared | language), from how often each is declared where the
   text alone says another.
3. Address suffix: P(suffix | language), likewise.
4. Host: a prior by host, smoothed towards its domain, and that towards all rows.

The last three are grouped aggregations, joined on their keys; hot hosts are combined before
the shuffle. Every value that ``MIN_ROWS`` rows declare is a language, whatever the size of the
table. Trigram counts are a table keyed by language; ``BLOCK`` languages at a time are read from
it, broadcast and scored.

Defined results: a text without letters (null and empty ones too) has language ``und``,
confidence 0 and is not kept, however declared; missing declaration, suffix or host is a
value of its own; equal posteriors give the alphabetically first language; repeated rows are
judged one by one; with no declared language at all every row is ``und``; an empty table gives
an empty result; columns of the input stay, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countermill.llm.common import cut, small_side
from countermill.llm.wordhash import slices, text_buffers

BUCKETS = 1 << 16
#: Rows that must declare a language.
MIN_ROWS = 5
#: Languages scored together.
BLOCK = 64
#: Languages a task counts at a time, and scores it holds at a time.
COUNTED_AT_ONCE = 128
HELD_SCORES = 1 << 21
#: Weight of the text's log-likelihood, as neighbouring trigrams say the same.
TEMPER = 0.3
#: Rows a host and a domain borrow from the level above.
BORROWED = 20.0
MIN_CONFIDENCE = 0.5
#: Rows times languages of a broadcast side, at most.
BROADCAST_ROWS = 1_000_000

RESULTS = ("language", "confidence", "kept")

# letters keep their byte in lower case; all else is one separator
_LETTER = np.zeros(256, dtype=np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def trigrams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram that starts at each byte, and whether it holds a letter in its
    middle; the last two bytes start none."""
    low = _LETTER[data].astype(np.uint32)
    if len(low) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    code = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
    code *= np.uint32(0x9E3779B1)
    return (code >> np.uint32(16)).astype(np.int64), low[1:-1] > 0


def _padded(raw: np.ndarray, offsets: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of some rows with a separator before, between and after them; the position of
    the separator before each row."""
    at = offsets[begin : end + 1] - offsets[begin]
    data = np.insert(raw[offsets[begin] : offsets[end]], at, 0x20)
    return data, at + np.arange(len(at))


def _counts(languages):
    """Trigram counts by number of the declared language; a task sends on the language it
    has not met for longest when it holds ``COUNTED_AT_ONCE``."""
    schema = pa.schema([("lang", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64())])

    def emptied(lang: int, counts: np.ndarray) -> pa.RecordBatch:
        found = np.flatnonzero(counts)
        columns = [np.full(len(found), lang, np.int32), found.astype(np.int32), counts[found]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {lang: i for i, lang in enumerate(languages.value)}
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            langs = np.array([number.get(x, -1) for x in batch.column("lang").to_pylist()], dtype=np.int64)
            offsets, raw = text_buffers(batch.column("text"))
            for begin, end in slices(offsets):
                data, at = _padded(raw, offsets, begin, end)
                bucket, good = trigrams(data)
                # rows of one language together
                for i in np.argsort(langs[begin:end], kind="stable").tolist():
                    lang = int(langs[begin + i])
                    if lang < 0:
                        continue
                    part = slice(at[i], max(at[i], at[i + 1] - 1))
                    counts = held.pop(lang, None)
                    if counts is None:
                        if len(held) >= COUNTED_AT_ONCE:
                            oldest = next(iter(held))
                            yield emptied(oldest, held.pop(oldest))
                        counts = np.zeros(BUCKETS, dtype=np.int64)
                    held[lang] = counts
                    one = bucket[part][good[part]]
                    if len(one) > BUCKETS // 16:
                        counts += np.bincount(one, minlength=BUCKETS)
                    else:
                        np.add.at(counts, one, 1)
        for lang, counts in held.items():
            yield emptied(lang, counts)

    return run, "lang int, bucket int, n bigint"


def _tables(blocks: list) -> Iterator[np.ndarray]:
    """The broadcast blocks one after the other; of several only one stays in memory."""
    for block in blocks:
        yield block.value
        if len(blocks) > 1 and getattr(block, "_path", None):
            vars(block).pop("_value", None)  # read from its file again for the next rows


def _scorer(blocks: list, n_languages: int, columns: list[str]):
    """Appends the log-likelihood of each language, and the likeliest by text alone (-1
    without letters)."""
    step = max(1, HELD_SCORES // n_languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for top in range(0, len(whole), step):
                yield scored(whole.slice(top, step))

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        offsets, raw = text_buffers(batch.column("text"))
        scores = np.zeros((len(batch), n_languages))
        letters = np.zeros(len(batch), dtype=np.int64)
        done = 0
        for table in _tables(blocks):
            for begin, end in slices(offsets):
                data, at = _padded(raw, offsets, begin, end)
                bucket, good = trigrams(data)
                sums = np.concatenate(([0], np.cumsum(good)))
                first, last = np.minimum(at[:-1], len(good)), np.maximum(at[:-1], np.minimum(at[1:] - 1, len(good)))
                letters[begin:end] = sums[last] - sums[first]
                for k, logs in enumerate(table, done):
                    sums = np.concatenate(([0.0], np.cumsum(np.where(good, logs[bucket], 0.0))))
                    scores[begin:end, k] = sums[last] - sums[first]
            done += len(table)
        best = np.where(letters > 0, scores.argmax(axis=1), -1)
        flat = pa.array(scores.ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * n_languages), flat)
        out = [batch.column(c) for c in columns] + [lists, pa.array(best.astype(np.int32))]
        return pa.RecordBatch.from_arrays(out, names=[*columns, "_ll", "_guess"])

    return run


def train(frame: DataFrame, declared: str) -> tuple[list[str], list]:
    """Languages in alphabetical order, and broadcast blocks of them with the log-probability
    of each bucket in each."""
    spread = frame.sparkSession.sparkContext.broadcast
    said = F.col(declared).isNotNull() & (F.length(declared) > 0)
    counted = frame.where(said).groupBy(declared).agg(F.count("*").alias("n")).where(F.col("n") >= MIN_ROWS)
    languages = sorted(r[0] for r in counted.collect())
    if not languages:
        return [], []
    texts = frame.where(said).select(F.col(declared).alias("lang"), "text")
    counts = cut(texts.mapInArrow(*_counts(spread(languages))).groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    blocks = []
    for begin in range(0, len(languages), BLOCK):
        size = min(BLOCK, len(languages) - begin)
        found = counts.where(F.col("lang").between(begin, begin + size - 1)).toArrow()  # at most BLOCK * BUCKETS rows
        smoothed = np.full((size, BUCKETS), 0.5)
        smoothed[found["lang"].to_numpy() - begin, found["bucket"].to_numpy()] += found["n"].to_numpy()
        blocks.append(spread(np.log(smoothed / smoothed.sum(axis=1, keepdims=True))))
    return languages, blocks


def _pairs(guessed: DataFrame, *keys: str) -> DataFrame:
    """Rows of each key by the language their text looks like."""
    return guessed.groupBy(*keys, "_guess").agg(F.count("*").alias("n"))


def _listed(pairs: DataFrame, keys: list[str], n_languages: int, name: str) -> DataFrame:
    """For each key, its rows by language, as an array over all languages."""
    found = F.collect_list(F.when(F.col("_guess") >= 0, F.struct("_guess", "n")))
    by_key = pairs.groupBy(*keys).agg(F.map_from_entries(found).alias("_map"))
    every = F.sequence(F.lit(0), F.lit(n_languages - 1))
    return by_key.select(
        *keys, F.transform(every, lambda i: F.coalesce(F.try_element_at("_map", i), F.lit(0).cast("long"))).alias(name)
    )


def _by_value(guessed: DataFrame, value: str, totals: list[int], name: str) -> DataFrame:
    """For each value, log P(value | language) of every language, add-half smoothed."""
    counted = cut(_listed(_pairs(guessed, value), [value], len(totals), "c"))
    kinds = counted.count()
    below = F.array(*(F.lit(total + 0.5 * kinds) for total in totals))
    logs = F.zip_with("c", below, lambda n, whole: F.log((n + 0.5) / whole))
    return small_side(counted.select(value, logs.alias(name)), kinds, BROADCAST_ROWS // len(totals))


def _host_priors(guessed: DataFrame, totals: list[int]) -> DataFrame:
    """For each host, the log prior of every language: host counts smoothed by the domain's,
    those by all rows'."""
    pairs = cut(_pairs(guessed, "_host", "_domain"))
    hosts = cut(_listed(pairs, ["_host", "_domain"], len(totals), "c"))
    by_domain = pairs.groupBy("_domain", "_guess").agg(F.sum("n").alias("n"))
    domains = _listed(by_domain, ["_domain"], len(totals), "d")
    whole = sum(totals) + 0.5 * len(totals)
    everywhere = F.array(*(F.lit((n + 0.5) / whole) for n in totals))

    def smooth(counts: str, above: Column) -> Column:
        n = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.zip_with(counts, above, lambda c, p: (c + BORROWED * p) / (n + BORROWED))

    domains = domains.select("_domain", smooth("d", everywhere).alias("p"))
    priors = hosts.join(domains, "_domain").select(
        "_host", "_domain", F.transform(smooth("c", F.col("p")), lambda x: F.log(x)).alias("_prior")
    )
    return small_side(priors, hosts.count(), BROADCAST_ROWS // len(totals))


def identify(
    docs: DataFrame,
    declared: Column,
    host: Column | None = None,
    suffix: Column | None = None,
) -> DataFrame:
    """``docs`` with the language, its posterior probability, and whether it is kept.

    ``docs`` has a ``text`` column; the other evidence is given as columns of ``docs``. The
    domain of a host is its last two labels.
    """
    columns = [c for c in docs.columns if c not in RESULTS]
    missing = F.lit("")
    host = F.coalesce(host.cast("string"), missing) if host is not None else missing
    suffix = F.coalesce(F.lower(suffix.cast("string")), missing) if suffix is not None else missing
    evidence = {
        "_declared": F.coalesce(F.lower(declared.cast("string")), missing),
        "_host": host,
        "_domain": F.when(host.contains("."), F.substring_index(host, ".", -2)).otherwise(missing),
        "_suffix": suffix,
    }
    full = docs.withColumns(evidence).select(*columns, *evidence)
    languages, blocks = train(full.select("text", "_declared"), "_declared")
    und = F.lit("und")
    if not languages:
        return docs.select(*columns, und.alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("kept"))

    def scored(frame: DataFrame) -> DataFrame:
        new = T.StructType([T.StructField("_ll", T.ArrayType(T.DoubleType())), T.StructField("_guess", T.IntegerType())])
        return frame.mapInArrow(_scorer(blocks, len(languages), frame.columns), T.StructType([*frame.schema.fields, *new.fields]))

    guessed = cut(scored(full.select("text", *evidence)).drop("text", "_ll"))
    counts = {r[0]: r[1] for r in guessed.groupBy("_guess").count().collect()}
    totals = [counts.get(i, 0) for i in range(len(languages))]
    out = scored(full)
    keys = {"_declared": "_d", "_suffix": "_s"}
    for value, name in keys.items():
        out = out.join(_by_value(guessed, value, totals, name), value)
    out = out.join(_host_priors(guessed, totals), ["_host", "_domain"])
    posts = F.transform("_ll", lambda x: x * TEMPER)
    for name in (*keys.values(), "_prior"):
        posts = F.zip_with(posts, F.col(name), lambda x, y: x + y)
    out = out.withColumn("_post", posts)
    out = out.withColumn("_top", F.array_max("_post"))
    out = out.withColumn("_sum", F.aggregate("_post", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_top"))))
    best = F.array(*map(F.lit, languages))[F.array_position("_post", F.col("_top")).cast("int") - 1]
    text_says = F.col("_guess") >= 0
    confidence = F.when(text_says, 1 / F.col("_sum")).otherwise(0.0)
    return out.select(
        *columns,
        F.when(text_says, best).otherwise(und).alias("language"),
        F.round(confidence, 6).alias("confidence"),
        (text_says & (confidence >= MIN_CONFIDENCE)).alias("kept"),
    )


def identify_documents(docs: DataFrame) -> DataFrame:
    """Documents: ``lang`` is declared, ``source`` is the host."""
    return identify(docs, F.col("lang"), F.col("source"))


def identify_pages(pages: DataFrame) -> DataFrame:
    """Raw pages: the ``lang`` of the markup is declared, host and suffix are the address's,
    tags are taken out of the text. All columns of the input stay, but for those called like
    a result. A script without an end runs to the end of the page, and a tag ends at the next
    angle bracket of either kind, so that no expression reads a page twice."""
    text = F.regexp_replace(F.coalesce("html", F.lit("")), "(?is)<(script|style)[^<>]*+>.*?(?:</\\1>|\\z)|<[^<>]*+>", " ")
    host = F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1)
    declared = F.regexp_extract("html", "(?i)<html[^<>]*?\\slang=\"?([a-z]+)", 1)
    frame = pages.select(F.struct("*").alias("_row"), text.alias("text"), host.alias("_address_host"), declared.alias("_markup"))
    out = identify(frame, F.col("_markup"), F.col("_address_host"), F.substring_index("_address_host", ".", -1))
    return out.select(*(F.col("_row")[c].alias(c) for c in pages.columns if c not in RESULTS), *RESULTS)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents kept, with the language found as ``lang``; all columns of the input,
    whatever they are called."""
    kept = identify_documents(docs.select("text", "lang", "source", F.struct("*").alias("_row"))).where("kept")
    return kept.select(*((F.col("language") if c == "lang" else F.col("_row")[c]).alias(c) for c in docs.columns))
