from __future__ import annotations

import random
import re

import numpy as np
import pytest

from countermill.llm import ngram_join
from countermill.llm.components import components
from tests.llm.data import SCHEMA, clashing_documents, edge_documents, edge_rows, no_documents, prose


def shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    """(doc_id, set size, class name) by comparing all pairs of rows."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * len(a | sets[j]):
                group[root(i)] = root(j)
    out = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((row[0], len(sets[i]), min(ids) if sets[i] and ids else row[0]))
    return sorted(out, key=repr)


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def near_copies(count: int, seed: int):
    """Copies of one text with a few words changed, and chains of ever more changes."""
    rng = random.Random(seed)
    base = prose(seed, 120).split()
    rows = []
    for i in range(count):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(50)}"
        rows.append((1000 * seed + i, " ".join(words), "en", "s", 0))
    chain = list(base)
    for i in range(count // 2):
        chain[(7 * i) % len(chain)] = f"x{i}"
        rows.append((1000 * seed + 500 + i, " ".join(chain), "en", "s", 0))
    return rows


def test_edges(spark):
    assert result(ngram_join.linked_classes(edge_documents(spark))) == brute_force(edge_rows())


def test_extra_columns_change_nothing(spark):
    assert result(ngram_join.linked_classes(clashing_documents(spark))) == brute_force(edge_rows())


def test_no_documents(spark):
    assert result(ngram_join.linked_classes(no_documents(spark))) == []


@pytest.mark.parametrize("blocks", [1024, 3])
def test_near_copies_and_chains(spark, monkeypatch, blocks):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", blocks)
    rows = near_copies(30, 1) + near_copies(20, 2) + [(9000 + i, prose(i + 50), "en", "s", 0) for i in range(10)]
    assert result(ngram_join.linked_classes(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_order_of_prefixes_is_free(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "ORDERING_NGRAMS", 0)
    rows = near_copies(12, 3)
    assert result(ngram_join.linked_classes(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_hot_ngrams_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_ROWS", 2)
    rows = near_copies(12, 4)
    assert result(ngram_join.linked_classes(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_bitmaps_never_hide_a_pair():
    rng = np.random.default_rng(1)
    for _ in range(300):
        common = rng.integers(0, 2**63, rng.integers(1, 400), dtype=np.uint64)
        a, b = (
            np.unique(np.concatenate((common, rng.integers(0, 2**63, rng.integers(0, 90), dtype=np.uint64)))) for _ in "ab"
        )
        both = len(np.intersect1d(a, b))
        similar = 100 * both >= 75 * (len(a) + len(b) - both)
        found = ngram_join.may_reach(
            [ngram_join._bitmap(a)], [ngram_join._bitmap(b)], np.array([len(a)]), np.array([len(b)]), 75
        )[0]
        assert found or not similar


def test_one_of_each_class_keeps_other_columns(spark):
    kept = ngram_join.one_of_each_class(clashing_documents(spark))
    assert kept.columns == clashing_documents(spark).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([1, 4, 5, 6, 7, 9, 10, 11, None, None], key=repr)
    assert {r.language for r in kept.collect()} == {"own"}


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 3), (10, 9), (9, 8), (8, 7), (7, 6), (20, 21), (20, 21), (30, 30)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    want = {1: 1, 2: 1, 3: 1, 10: 6, 9: 6, 8: 6, 7: 6, 6: 6, 20: 20, 21: 20}
    assert {r.node: r.component for r in found.collect()} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rows_of_one_id_with_different_texts(spark):
    rows = [(1, prose(1)), (5, prose(1)), (5, prose(2)), (5, prose(2)), (6, prose(3)), (7, prose(2))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    kept = sorted((r.doc_id, r.text) for r in ngram_join.one_of_each_class(docs).collect())
    assert kept == sorted([(1, prose(1)), (5, prose(2)), (6, prose(3))])
