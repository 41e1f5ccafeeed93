"""Importance resampling of documents towards the benchmark's distribution of word runs.

Words come from an untrained pre-tokenizer: a Regex Split over the ASCII-lowered bytes returns
them with byte offsets. Runs of 1 to 3 offset pairs are features; a run's bucket is the CRC-32 of
its words joined by spaces, computed from the words' checksums and lengths (``crc``) for whole
arrays, which hold the words of many short texts.

One pass over the texts writes each row's buckets, two bytes a feature, to a table. Its counts
are added inside each task, so ``BUCKETS`` rows a task are shuffled; the gains of all buckets
(a list of ``BUCKETS`` numbers, whatever the input) travel with the second pass, which sums them
for each row. The draw ranks narrow rows over ranges of the score, nothing is collected.

Defined results: a null or empty text has no features, weight 0 and takes no part in the draw,
nor does a text of under ``LEAST_WORDS`` words; a null doc_id draws by the hash of its empty
decimal and stands before all others in ties; rows that repeat a doc_id are ranked one by one,
ties between them by n_features and weight; a very long text is read whole, in parts cut between words;
an empty table gives an empty result and an empty benchmark counts as no features; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countermill.llm.common import cut
from countermill.llm.crc import checksums, followed, joined
from countermill.llm.sql_parts import CRC_TABLE, ascii_lower, crc32
from countermill.operators.ordering import numbered

BUCKETS = 10000
RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes read by the pre-tokenizer at once, texts whose words share arrays, and buckets sent to Spark at once.
PART_BYTES = 1 << 14
GROUP_BYTES = 1 << 18
BATCH_BYTES = 16 << 20

#: Bytes as the pre-tokenizer sees them: those from 128 up are word characters, each as good as any.
_SEEN = bytes(range(128)) + b"z" * 128
_BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


class WordRuns:
    """Buckets of all runs of consecutive words of a text."""

    def __init__(self, longest: int = RUN, buckets: int = BUCKETS, part_bytes: int = PART_BYTES) -> None:
        from tokenizers import PreTokenizedString, Regex, pre_tokenizers

        self.pieces = PreTokenizedString
        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self.longest, self.buckets, self.part_bytes = longest, buckets, part_bytes

    def _parts(self, text: bytes) -> Iterator[bytes]:
        """The text in parts that end between words, unless one word is longer than a part."""
        start = 0
        while len(text) - start > self.part_bytes:
            gap = _BETWEEN.search(text, start + self.part_bytes)
            end = gap.end() if gap else len(text)
            yield text[start:end]
            start = end
        yield text[start:]

    def _offsets(self, part: bytes) -> np.ndarray:
        """(start, end) of each word, in bytes."""
        pieces = self.pieces(part.translate(_SEEN).decode("ascii"))
        self.split.pre_tokenize(pieces)
        pairs = pieces.get_splits(offset_referential="original", offset_type="byte")
        return np.fromiter(chain.from_iterable(map(itemgetter(1), pairs)), np.int64, 2 * len(pairs)).reshape(-1, 2)

    def buckets_of(self, text: bytes) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of every run."""
        return next(self.buckets_of_all([text]))

    def buckets_of_all(self, texts: Sequence[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """Number of words, and the bucket of every run, of each text."""
        data = b"\n".join(texts).lower()  # of bytes, so A to Z alone
        found, begin = [], 0
        for part in self._parts(data):
            found.append(self._offsets(part) + begin)
            begin += len(part)
        offsets = np.concatenate(found)
        starts, length = offsets[:, 0], offsets[:, 1] - offsets[:, 0]
        own = checksums(data, starts, length)
        runs, run = [own], own
        for extra in range(1, min(self.longest, len(own))):
            run = joined(followed(run[:-1], 0x20), own[extra:], length[extra:])
            runs.append(run)
        runs = [(r % np.uint32(self.buckets)).astype("<u2") for r in runs]
        ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])).tolist()
        for first, end in zip([0, *ends], ends):
            # Runs of a text end before the next one: no run goes over both.
            yield end - first, np.concatenate([r[first : max(first, end - extra)] for extra, r in enumerate(runs)])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Consecutive doc_ids and texts of about ``GROUP_BYTES``, one at least."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            ids.append(doc_id.as_py())
            texts.append(text.as_py() or b"")
            size += len(texts[-1]) + 1
            if size > GROUP_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _reader(longest: int, buckets: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("buckets", pa.large_binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = WordRuns(longest, buckets)
        held: list[tuple] = []
        size = 0
        for ids, texts in _groups(batches):
            for doc_id, (words, found) in zip(ids, runs.buckets_of_all(texts)):
                held.append((doc_id, words, found.tobytes()))
                size += len(held[-1][2]) + 32
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)

    return read


def features(rows: DataFrame, longest: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """n_words and the buckets of each row's features (``doc_id``, ``text``), written to the shared folder."""
    texts = rows.select(F.col("doc_id").cast("bigint"), F.encode("text", "UTF-8").alias("text"))
    return cut(texts.mapInArrow(_reader(longest, buckets), "doc_id bigint, n_words bigint, buckets binary"))


def _counter(buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in batch.column("buckets"):
                total += np.bincount(np.frombuffer(found.as_py(), "<u2"), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], schema=schema)

    return count


def histogram(found: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Features in each bucket, over all rows."""
    parts = found.select("buckets").mapInArrow(_counter(buckets), "bucket int, n bigint")
    counts = [0] * buckets
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(source: list[int], target: list[int]) -> list[int]:
    """Gain of each bucket: thousandths of the logarithm of how much likelier it is in the target."""
    size, held, wanted = len(source), sum(source), sum(target)
    return [
        math.floor(1000 * math.log(float(t + 1) * float(held + size) / (float(s + 1) * float(wanted + size))))
        for s, t in zip(source, target)
    ]


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of a document in thousandths, from a hash of its id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scorer(gain: list[int], seed: int):
    kinds = [(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight", "score")]
    schema = pa.schema(kinds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(gain, np.int64)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            found = [np.frombuffer(x.as_py(), "<u2") for x in batch.column("buckets")]
            weight = [int(table[x].sum()) for x in found]
            total = [w + noise(i, seed) for w, i in zip(weight, ids)]
            columns = [ids, batch.column("n_words"), [len(x) for x in found], weight, total]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return score, ", ".join(f"{c} bigint" for c, _ in kinds)


def scored(found: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of each row."""
    return found.mapInArrow(*_scorer(gain, seed))


def drawn(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Add ``rank``: 1, 2, 3, ... for the highest scores, null for rows not drawn."""
    rows = cut(rows)
    able = rows.n_words >= least_words
    keys = rows.where(able).withColumn("_draw", F.lit(0)).withColumn("_down", -F.col("score"))
    order = ["_down", "doc_id", "n_features", "weight"]
    ranked = numbered(keys, ["_draw"], order, "_place", "_able")
    taken = F.col("_place") < F.expr(f"{percent} * _able div 100")
    ranked = ranked.withColumn("rank", F.when(taken, F.col("_place") + 1))
    rest = rows.where(F.coalesce(~able, F.lit(True))).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.select(*rest.columns).unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED
) -> DataFrame:
    """n_features, weight, score and rank of each document; ``target`` has a ``text``."""
    found = features(docs)
    wanted = features(target.select(F.lit(None).cast("bigint").alias("doc_id"), "text"))
    rows = scored(found, gains(histogram(found), histogram(wanted)), seed)
    return drawn(rows, percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")


def _features_sql(name: str, words: str) -> str:
    """(id, bucket) of every feature of a table of (id, words)."""
    runs = " UNION ALL ".join(
        f"SELECT id, unnest(list_transform(range(1, greatest(len(words) - {n - 2}, 1)), "
        f"lambda i: array_to_string(words[i:i + {n - 1}], ' '))) AS feature FROM {words}"
        for n in range(1, RUN + 1)
    )
    return f"{name} AS MATERIALIZED ({runs})"


def _words_sql(name: str, table: str, key: str) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT row_number() OVER () AS id, {key} AS doc_id, "
        rf"regexp_extract_all({ascii_lower('coalesce(text, ' + repr('') + ')')}, '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS words FROM {table})"
    )


ORACLE_SQL = f"""
WITH {CRC_TABLE},
{_words_sql("docs", "documents", "doc_id")},
{_words_sql("items", "benchmark", "item_id")},
{_features_sql("doc_features", "docs")},
{_features_sql("item_features", "items")},
texts AS (SELECT feature FROM doc_features UNION SELECT feature FROM item_features),
crcs AS MATERIALIZED (SELECT feature, {crc32("feature")} % {BUCKETS} AS bucket FROM texts, crc_table),
held AS (SELECT bucket, count(*) AS n FROM doc_features JOIN crcs USING (feature) GROUP BY bucket),
wanted AS (SELECT bucket, count(*) AS n FROM item_features JOIN crcs USING (feature) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM held)::DOUBLE AS s, (SELECT coalesce(sum(n), 0) FROM wanted)::DOUBLE AS t),
gain AS (
  SELECT b.i AS bucket, floor(1000 * ln((coalesce(w.n, 0) + 1)::DOUBLE * (s + {BUCKETS})
    / ((coalesce(h.n, 0) + 1)::DOUBLE * (t + {BUCKETS}))))::BIGINT AS gain
  FROM range({BUCKETS}) b(i) CROSS JOIN sums LEFT JOIN held h ON h.bucket = b.i LEFT JOIN wanted w ON w.bucket = b.i),
weights AS (
  SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM doc_features JOIN crcs USING (feature) JOIN gain USING (bucket) GROUP BY id),
scores AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS place,
    count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () AS able
  FROM scores)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_words >= {LEAST_WORDS} AND place <= {PERCENT} * able // 100 THEN place END AS rank
FROM ranked
"""
