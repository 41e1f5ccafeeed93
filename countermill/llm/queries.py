"""The operators of this package as registered queries on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from countermill.llm import (
    chat_format,
    decontamination,
    html_extract,
    importance,
    language_id,
    license_scan,
    merkle,
    ngram_join,
    packing,
    quality_lm,
    quality_rules,
    sharding,
    toxicity,
)
from countermill.llm.common import documents, tokenizer_file


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in all documents."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated(documents(spark, sf_dir), bench)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of all documents linked by shared 5-word shingles."""
    return ngram_join.linked_classes(documents(spark, sf_dir))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes."""
    return sharding.shard_documents(documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return toxicity.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning of all documents."""
    return quality_rules.judge(documents(spark, sf_dir)).select(
        "doc_id", *(c for c in quality_rules.RESULTS if c != "clean_text")
    )


def op7_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_file(), with_ids=False)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of all documents."""
    return quality_lm.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in all documents."""
    return license_scan.scan(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    return language_id.identify_documents(documents(spark, sf_dir)).select(
        "doc_id", "lang", "source", *language_id.RESULTS
    )


def op10_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all pages, by markup, address suffix and host as well."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return language_id.identify_pages(pages).select("page_id", "url", *language_id.RESULTS)


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back."""
    rows = chat_format.with_hostile(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return chat_format.read_back(chat_format.format_conversations(rows), in_order=True)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed against the benchmark, the drawn ones ranked."""
    return importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, each verified by its proof."""
    return merkle.prove(documents(spark, sf_dir))


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_html_extraction": op3_html_extraction,
    "op4_sharding": op4_sharding,
    "op5_toxicity": op5_toxicity,
    "op6_quality_rules": op6_quality_rules,
    "op7_sequence_packing": op7_sequence_packing,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_license_scan": op9_license_scan,
    "op10_language_id": op10_language_id,
    "op10_language_id_pages": op10_language_id_pages,
    "op11_chat_formatting": op11_chat_formatting,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE = {
    "op2_ngram_jaccard_join": ngram_join.ORACLE_SQL,
    "op6_quality_rules": quality_rules.ORACLE_SQL,
    "op11_chat_formatting": chat_format.ORACLE_SQL,
    "op12_importance_resampling": importance.ORACLE_SQL,
    "op13_merkle_manifest": merkle.ORACLE_SQL,
}
