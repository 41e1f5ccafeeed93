from __future__ import annotations

import pytest

import corpus_pipeline
from countermill.llm.common import cut
from countermill.llm.queries import ORACLE, QUERIES
from tests.llm.data import clashing_documents, no_documents
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    assert compare(spark, connect(SF), QUERIES[name], ORACLE[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_queries_run_whole(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_pipeline_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = cut(stage(spark, before, SF))
        assert after.columns == docs.columns
        assert 0 < after.count() <= before.count()
        before = after
    texts = [r.text for r in before.collect()]
    assert len(set(texts)) == len(texts)
    assert not any(item in text for item in bench for text in texts)
    whole = corpus_pipeline.run(spark, SF)
    assert whole.select("doc_id").distinct().count() == len(texts)


def test_stages_on_edges(spark):
    for docs in (clashing_documents(spark), no_documents(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()


def test_all_pages_are_identified(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = QUERIES["op10_language_id_pages"](spark, SF)
    assert out.columns == ["page_id", "url", "language", "confidence", "kept"]
    assert out.count() == pages.count()
    assert out.where("kept").count() > 0
