from __future__ import annotations

import hashlib
import zlib

import pytest

from countermill.llm import merkle
from tests.helpers import rows
from tests.llm.data import clashing_documents, edge_documents, no_documents

UPPER = {c: c + 32 for c in range(65, 91)}


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text) -> str:
    fields = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return digest(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels_of(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def path_of(levels, pos: int) -> list[tuple[int, list[str]]]:
    path = []
    for nodes in levels[:-1]:
        start = pos // 8 * 8
        run = nodes[start : start + 8]
        path.append((pos - start, run[: pos - start] + run[pos - start + 1 :]))
        pos //= 8
    return path


def brute(docs) -> list[tuple]:
    """Whole trees in memory."""
    trees: dict = {}
    for row in docs:
        changed = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0
        text = row.text.translate(UPPER) if changed and row.text is not None else row.text
        trees.setdefault(row.lang, []).append((row.doc_id, leaf(row, row.text), leaf(row, text)))
    languages = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {}
    for lang in languages:
        trees[lang].sort(key=lambda x: (x[0] is not None, x))
        levels[lang] = levels_of([x[1] for x in trees[lang]])
    over = levels_of([levels[lang][-1][0] for lang in languages]) if languages else []
    out = []
    for at, lang in enumerate(languages):
        for pos, (doc_id, own, claimed) in enumerate(trees[lang]):
            path = path_of(levels[lang], pos) + path_of(over, at)
            node = claimed
            for place, others in path:
                node = digest(*others[:place], node, *others[place:])
            proof = digest(*(x for _, others in path for x in others))
            out.append((doc_id, own, levels[lang][-1][0], over[-1][0], proof, node, node == over[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("make", [edge_documents, clashing_documents, no_documents])
def test_edges_equal_whole_trees(spark, tmp_path, make):
    docs = make(spark)
    assert rows(merkle.prove(docs, str(tmp_path / "m"))) == brute(docs.collect())


@pytest.mark.parametrize("size", [1, 9, 64, 600])
def test_sizes_around_full_subtrees(spark, tmp_path, size):
    docs = spark.range(size).selectExpr(
        "id as doc_id", "concat('Text ', id) as text", "if(id % 50 = 7, 'fr', 'en') as lang", "'s' as source", "id as n_chars"
    )
    assert rows(merkle.prove(docs, str(tmp_path / "m"))) == brute(docs.collect())


def test_more_languages_than_one_run(spark, tmp_path):
    docs = spark.range(300).selectExpr(
        "id as doc_id", "'A' as text", "concat('l', id % 90) as lang", "cast(null as string) as source", "1 as n_chars"
    )
    out = merkle.prove(docs, str(tmp_path / "m"))
    assert rows(out) == brute(docs.collect())
    assert out.select("subroot").distinct().count() == 90


def test_only_every_second_level_is_stored(spark, tmp_path):
    docs = spark.range(5000).selectExpr(
        "id as doc_id", "'a' as text", "'en' as lang", "'s' as source", "1 as n_chars"
    )
    merkle.manifest(docs, str(tmp_path))
    stored = sorted(p.name for p in (tmp_path / "documents").iterdir())
    assert stored == ["level_00", "level_02", "level_04", "level_06"]
    counts = [spark.read.parquet(str(tmp_path / "documents" / s)).count() for s in stored]
    assert counts == [5000, 79, 2, 1]


def test_unchanged_documents_verify(spark, tmp_path):
    docs = edge_documents(spark)
    out = {(r.doc_id, r.leaf): r.verified for r in merkle.prove(docs, str(tmp_path / "m")).collect()}
    for row in docs.collect():
        changed = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0
        changed = changed and row.text is not None and row.text != row.text.translate(UPPER)
        assert out[(row.doc_id, leaf(row, row.text))] is not changed
