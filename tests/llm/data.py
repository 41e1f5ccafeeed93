"""Small documents with the awkward cases every operator must define a result for."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = "kept boolean, language string, component_id int, _row string, _key string, node string, shard string"


def prose(seed: int, words: int = 80) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(words)]
    lines = [" ".join(made[i : i + 20]).capitalize() + "." for i in range(0, words, 20)]
    return "\n".join(lines)


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, ties and repeated rows."""
    base = prose(1)
    rows = [
        (1, base, "en", "s1"),
        (2, base, "en", "s1"),
        (2, base, "en", "s1"),
        (3, base.replace(base.split()[3], "changed", 1), "en", "s2"),
        (4, None, "en", "s1"),
        (5, "", "en", None),
        (6, " \t\n ", None, "s1"),
        (7, "one two", "en", "s1"),
        (8, "ONE  two", "en", "s1"),
        (None, prose(2), "de", "s2"),
        (None, None, None, None),
        (9, prose(3, 6000), "de", "s2"),
        (10, prose(4) + "\n" + prose(5), "en", "s1"),
        (11, "é ß ñ 你好 #*$%", "fr", "s3"),
    ]
    return [(*row, len(row[1]) if row[1] is not None else None) for row in rows]


def edge_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(edge_rows(), SCHEMA)


def clashing_documents(spark: SparkSession) -> DataFrame:
    """The same with more columns, named like results and helpers of the operators."""
    extra = (False, "own", 5, "r", "k", "n", "s")
    return spark.createDataFrame([(*row, *extra) for row in edge_rows()], f"{SCHEMA}, {EXTRA}")


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
