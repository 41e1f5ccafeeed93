from __future__ import annotations

import importlib
import random
import zlib

import pytest

from countermill.llm import quality_lm, toxicity
from tests.llm.data import SCHEMA, clashing_documents, edge_documents, edge_rows, no_documents, prose

LABELS = "doc_id bigint, quality int, toxic int"


def test_toxic_words_are_learned_and_held_out(spark):
    rng = random.Random(8)
    bad = ["idiot", "scum", "trash"]
    rows, labels = [], []
    for i in range(900):
        words = prose(i, 60).split()
        toxic = i % 4 == 0
        for _ in range(5 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    out = toxicity.score(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == 900
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    unseen = [r for r in out if r.held_out]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in unseen) >= 0.97 * len(unseen)
    assert all(r.predicted == int(r.score >= 0.3) for r in out)


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, None), (None, 0, 1), (1, 0, 0), (3, 1, 0), (99, 1, 1)], LABELS)
    for docs in (edge_documents(spark), clashing_documents(spark)):
        out = toxicity.score(docs, labels).collect()
        assert len(out) == len(edge_rows()) and all(0 <= r.score <= 1 for r in out)
        assert {r.held_out for r in out if r.doc_id is None} == {False}
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.score(edge_documents(spark), none).collect()} == {0.0}
    assert toxicity.score(no_documents(spark), labels).count() == 0


def test_perplexity_against_plain_counts(spark):
    texts = [prose(i, 30) for i in range(20)] + ["a1b2", "é ß"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    tables = quality_lm.train(docs)
    counts = [{} for _ in range(quality_lm.ORDER + 1)]
    for t in texts:
        data = bytes([2] * 4) + bytes(0x30 if 0x30 <= b < 0x3A else b for b in t.encode())
        for i in range(4, len(data)):
            gram = data[i - 4 : i + 1]
            counts[5][gram] = counts[5].get(gram, 0) + 1
    for order in range(4, 0, -1):
        for gram in counts[order + 1]:
            counts[order][gram[1:]] = counts[order].get(gram[1:], 0) + 1

    def discounts(c):
        n1, n2, n3, n4 = (sum(v == k for v in c.values()) for k in (1, 2, 3, 4))
        if not (n1 and n2):
            return [0.5, 0.75, 0.9]
        y = n1 / (n1 + 2 * n2)
        raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        return [min(max(d, 0.1), k - 0.05) for k, d in enumerate(raw, 1)]

    taken = [None] + [discounts(counts[k]) for k in range(1, 6)]

    def chance(gram):
        if not gram:
            return 1 / 256
        order = len(gram)
        same = {g: n for g, n in counts[order].items() if g[:-1] == gram[:-1]}
        lower = chance(gram[1:])
        if not same:
            return lower
        total = sum(same.values())
        share = {g: (n - taken[order][min(n, 3) - 1]) / total for g, n in same.items()}
        return share.get(gram, 0.0) + (1 - sum(share.values())) * lower

    import math

    import numpy as np

    for gram in [b"\x02\x02\x02\x02a", b"abcde", texts[0].encode()[10:15], texts[3].encode()[7:12], b"zzzzz"]:
        code = np.array([int.from_bytes(gram, "big")], dtype=np.uint64)
        assert math.isclose(quality_lm.log_probabilities(tables, code)[0], math.log(chance(gram)), rel_tol=1e-9)


def test_junk_is_rejected_and_trusted_text_kept(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(600):
        text = prose(i, 60)
        if i % 10 == 9:
            text = "".join(rng.choice("#$%&*|<>{}QWXZ") for _ in range(300))
        rows.append((i, text, ("en", "de")[i % 2], "s", 0))
        labels.append((i, int(i % 10 != 9), 0))
    out = quality_lm.classify(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == 600
    assert not any(r.kept for r in out if r.doc_id % 10 == 9)
    assert sum(r.kept for r in out if r.doc_id % 10 != 9) >= 0.97 * 540


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 1), (None, 1, 1), (9, 1, 0), (1, 1, 0)], LABELS)
    for docs in (edge_documents(spark), clashing_documents(spark)):
        out = quality_lm.classify(docs, labels).collect()
        assert len(out) == len(edge_rows())
        assert all((r.perplexity is None) <= (not r.kept) for r in out)
    assert quality_lm.classify(no_documents(spark), labels).count() == 0
    none = spark.createDataFrame([], LABELS)
    assert quality_lm.classify(edge_documents(spark), none).count() == len(edge_rows())


def _labelled(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        words = prose(i, 40).split()
        for _ in range(5 if i % 4 == 0 else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "stupid trash"]))
        rows.append((i, " ".join(words), ("en", "de")[i % 2], "s", 0))
        labels.append((i, int(i % 7 != 0), int(i % 4 == 0)))
    rows += [(500, rows[8][1], "en", "s", 0), (501, rows[8][1], "en", "s", 0), (502, None, "en", "s", 0), (503, "", "en", "s", 0), (504, "scum", None, "s", 0), (None, "x y", "en", "s", 0)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize("operator", [toxicity.score, quality_lm.classify])
def test_a_model_beyond_the_bound_loses_nothing(spark, monkeypatch, operator):
    docs, labels = _labelled(spark)
    plain = lambda: sorted(([round(v, 4) if isinstance(v, float) else v for v in r] for r in operator(docs, labels).collect()), key=repr)
    whole = plain()
    monkeypatch.setattr(importlib.import_module(operator.__module__), "MODEL_ROWS", 3)
    assert plain() == whole
