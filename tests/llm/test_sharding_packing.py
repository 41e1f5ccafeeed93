from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from countermill.llm import packing, sharding
from countermill.llm.common import tokenizer_file
from countermill.llm.partition import differencing, fill_windows
from countermill.llm.tokens import TextTokens
from tests.llm.data import SCHEMA, clashing_documents, edge_documents, edge_rows, no_documents, prose


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def test_short_way_gives_the_tokenizers_ids(tokenizer):
    rng = random.Random(1)
    wide = "aAzZ09 .,!'\n\tséÉñß×÷µÿÀ€你İſ́<|>'s't're\x85\xa0\x1c中٣½"
    plain = "aAzZ09 .,!'\n\tsmtéÉñß"
    texts = [None, "", "it's don't 'reed", "<|endoftext|> a", "a<|startoftext|>", "É Àé ÿ x×y"]
    for letters in (wide, plain):
        texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    found = [ids.tolist() for ids in TextTokens(tokenizer_file()).rows(pa.array(texts))]
    assert found == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_differencing_balances():
    rng = random.Random(2)
    for windows in (1, 2, 7, 40):
        sizes = [rng.randint(1, 500) for _ in range(200)]
        parts = differencing(sizes, windows)
        assert sorted(i for part in parts for i in part) == list(range(200))
        sums = [sum(sizes[i] for i in part) for part in parts]
        assert max(sums) - min(sums) <= max(2, sum(sizes) / windows * 0.1)
    assert fill_windows([], 10) == []
    assert sorted(map(sorted, fill_windows([10, 10, 1], 10))) == [[0], [1], [2]]


def whole(frame, tokenizer, rows):
    """Pieces put together again are the ids of every row; windows are gapless."""
    pieces = frame.collect()
    windows: dict[int, list] = {}
    for p in pieces:
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    joined: dict = {}
    for p in sorted(pieces, key=lambda p: p.start):
        joined.setdefault((p.doc_id, p.start), []).append(tuple(p.ids))
    want: dict = {}
    for row in rows:
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [1]
        want.setdefault(row[0], []).extend(ids)
    found: dict = {}
    for (doc_id, _), parts in joined.items():
        found.setdefault(doc_id, []).extend(i for part in parts for i in part)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def test_packing_edges(spark, tokenizer):
    whole(packing.pack_documents(edge_documents(spark), tokenizer_file()), tokenizer, edge_rows())
    whole(packing.pack_documents(clashing_documents(spark), tokenizer_file()), tokenizer, edge_rows())
    assert packing.pack_documents(no_documents(spark), tokenizer_file()).count() == 0


def test_little_padding(spark):
    rows = [(i, prose(i, 40 + 13 * (i % 90)), "en", "s", 0) for i in range(400)]
    packed = packing.pack_documents(spark.createDataFrame(rows, SCHEMA).coalesce(1), tokenizer_file(), with_ids=False)
    total, windows = packed.selectExpr("sum(length)", "count(distinct sequence_id)").first()
    assert total / (2048 * windows) > 0.97


def test_shards_are_even_and_gapless(spark):
    rng = random.Random(4)
    rows = [(i, "é" * rng.randint(0, 300) if i % 5 else None, "en", "s", 0) for i in range(3000)]
    out = sharding.shard_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 3000
    load = [0] * 16
    for r in out:
        text = (rows[r.doc_id][1] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "bytes", None)
        load[r.shard] += r.size
    assert max(load) - min(load) <= 0.01 * max(load)
    for shard in range(16):
        places = sorted(r.slot for r in out if r.shard == shard)
        assert places == list(range(len(places)))


def test_sharding_edges(spark):
    out = sharding.shard_documents(clashing_documents(spark)).collect()
    assert len(out) == len(edge_rows())
    for shard in {r.shard for r in out}:
        places = sorted(r.slot for r in out if r.shard == shard)
        assert places == list(range(len(places)))
    assert sharding.shard_documents(no_documents(spark)).count() == 0
    plan = sharding.shard_documents(edge_documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_map_edits():
    rng = random.Random(6)
    sizes = {slot: rng.randint(1, 1000) for slot in range(4096)}
    first = sharding.initial_map(16)
    even = sharding.rebalanced(first, sizes, 16)
    moved = sum(a != b for a, b in zip(first, even))
    assert 0 < moved < 600
    grown = sharding.grown(even, sizes, 16)
    assert all(b in (a, 16) for a, b in zip(even, grown))
    load = [sum(sizes[s] for s in range(4096) if grown[s] == shard) for shard in range(17)]
    assert load[16] > 0.9 * sum(load) / 17
