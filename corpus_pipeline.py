"""Stages that turn raw documents into packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of the documents. Nulls, empty and repeated rows and empty tables are handled as the
operator of each stage says in its module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from countermill.llm import decontamination, language_id, ngram_join, packing, quality_rules
from countermill.llm.common import cut, tokenizer_file


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return quality_rules.clean(docs)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is sure enough; ``lang`` is the language found."""
    return language_id.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked documents."""
    return ngram_join.one_of_each_class(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_file(), with_ids=False)


STAGES = [
    ("quality_rules", rules),
    ("language_id", languages),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("sequence_packing", packed),
]

#: Packing and the class search have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
