from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from countermill.llm import crc, importance
from tests.helpers import rows
from tests.llm.data import clashing_documents, edge_documents, no_documents

UPPER = {c: c + 32 for c in range(65, 91)}


def buckets(text, longest: int = 3, size: int = 10000) -> list[int]:
    words = re.findall(importance.WORD, (text or "").translate(UPPER))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return [zlib.crc32(r.encode()) % size for r in runs]


def n_words(text) -> int:
    return len(re.findall(importance.WORD, (text or "").translate(UPPER)))


def brute(docs, items) -> list[tuple]:
    held, wanted = Counter(), Counter()
    for row in docs:
        held.update(buckets(row.text))
    for row in items:
        wanted.update(buckets(row.text))
    s, t = sum(held.values()), sum(wanted.values())
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1.0) * (s + 10000) / ((held[b] + 1.0) * (t + 10000)))) for b in range(10000)
    ]
    scored = []
    for row in docs:
        found = buckets(row.text)
        weight = sum(gain[b] for b in found)
        name = "" if row.doc_id is None else row.doc_id
        h = int(hashlib.sha256(f"42:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((row.doc_id, len(found), weight, score, n_words(row.text)))
    able = sorted((r for r in scored if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    taken = 5 * len(able) // 100
    out = [(*r[:4], i + 1 if i < taken else None) for i, r in enumerate(able)]
    return sorted(out + [(*r[:4], None) for r in scored if r[4] < 20], key=repr)


def test_joined_checksums_equal_whole_ones():
    rng = random.Random(5)
    parts = [(rng.randbytes(rng.choice([0, 1, 3, 63, 64, 65, 200, 1000])), rng.randbytes(rng.choice([0, 1, 64, 130, 999]))) for _ in range(300)]
    first = np.array([zlib.crc32(a) for a, _ in parts], np.uint32)
    second = np.array([zlib.crc32(b) for _, b in parts], np.uint32)
    found = crc.joined(first, second, np.array([len(b) for _, b in parts]))
    assert found.tolist() == [zlib.crc32(a + b) for a, b in parts]


@pytest.mark.parametrize("part_bytes", [1, 7, 1 << 20])
def test_buckets_do_not_depend_on_parts(part_bytes):
    runs = importance.WordRuns(part_bytes=part_bytes)
    for text in ("", "One", "one TWO", "é, İk-9 ÀB\x00c\x7fd  你好 " * 20, "x" * 300 + " y", " a b Ⅷ K"):
        words, found = runs.buckets_of(text.encode())
        assert words == n_words(text)
        assert sorted(found.tolist()) == sorted(buckets(text))


def test_checksums_of_words_equal_whole_ones():
    rng = random.Random(6)
    sizes = [rng.choice([0, 1, 2, 5, 31, 32, 33, 34, 300]) for _ in range(500)]
    for some in ([], [7], [0], [40], sizes):
        data = rng.randbytes(sum(some))
        starts = np.cumsum([0, *some])[:-1].astype(np.int64)
        words = [data[a : a + n] for a, n in zip(starts, some)]
        found = crc.checksums(data, starts, np.array(some, np.int64))
        assert found.tolist() == [zlib.crc32(w) for w in words]
        assert crc.followed(found, 0x20).tolist() == [zlib.crc32(w + b" ") for w in words]


def test_many_short_texts_share_arrays(monkeypatch):
    rng = random.Random(7)
    texts = [rng.choice([None, "", "One", "a b", "é-x  Y\n", "x" * 90, "one TWO three 4 " * rng.randrange(9)]) for _ in range(900)]
    calls = []
    monkeypatch.setattr(importance, "joined", lambda *columns: calls.append(1) or crc.joined(*columns))
    batches = [
        pa.record_batch({"doc_id": pa.array(range(a, a + 300)), "text": pa.array([t and t.encode() for t in texts[a : a + 300]], pa.binary())})
        for a in (0, 300, 600)
    ]
    out = [r for b in importance._reader(3, 10000)(iter(batches)) for r in b.to_pylist()]
    assert [r["doc_id"] for r in out] == list(range(900))
    for text, row in zip(texts, out):
        assert row["n_words"] == n_words(text)
        assert np.frombuffer(row["buckets"], "<u2").tolist() == buckets(text)
    assert len(calls) <= 4


def test_bytes_that_are_no_text_are_word_characters():
    texts = [b"\xff\xfe A", b"", b"b\x80\xc3 \xff"]
    found = [(n, b.tolist()) for n, b in importance.WordRuns(part_bytes=2).buckets_of_all(texts)]
    crcs = [[zlib.crc32(w) % 10000 for w in ws] for ws in ([b"\xff\xfe", b"a", b"\xff\xfe a"], [], [b"b\x80\xc3", b"\xff", b"b\x80\xc3 \xff"])]
    assert found == [(2, crcs[0]), (0, []), (2, crcs[2])]


@pytest.mark.parametrize("make", [edge_documents, clashing_documents, no_documents])
def test_edges_equal_brute_force(spark, make):
    items = spark.createDataFrame([(1, "one two three"), (2, None), (3, "One, two")], "item_id bigint, text string")
    docs = make(spark)
    assert rows(importance.resample(docs, items)) == brute(docs.collect(), items.collect())


def test_draw_follows_the_target(spark):
    rng = random.Random(3)
    table = [(i, " ".join(rng.choice("abcdefghij" if i % 4 else "klmnopqrst") for _ in range(60)), "en", "s", 1) for i in range(400)]
    docs = spark.createDataFrame(table, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    items = spark.createDataFrame([(1, " ".join(rng.choice("klmnopqrst") for _ in range(300)))], "item_id bigint, text string")
    out = importance.resample(docs, items)
    assert rows(out) == brute(docs.collect(), items.collect())
    taken = [r.doc_id for r in out.where("rank is not null").collect()]
    assert len(taken) == 20 and all(i % 4 == 0 for i in taken)


def test_empty_target_gives_finite_weights(spark):
    docs = edge_documents(spark)
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert rows(importance.resample(docs, items)) == brute(docs.collect(), [])
