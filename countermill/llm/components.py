"""Connected components of a link table, by alternating star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countermill.llm.common import cut


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """(u, smallest v of u) for each u; combined before the shuffle, so a hub with very
    many links is one row a task."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    Each round links larger neighbours, then smaller ones, to the smallest neighbour
    known; depth halves, so the rounds grow with the logarithm of the longest chain. Every
    round is written to the shared folder. Links to itself and repeated links are ignored;
    no link gives an empty result.
    """
    edges = cut(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _to_smallest(both).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u")
            .where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        smallest = _to_smallest(large)
        small = (
            large.join(smallest, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(smallest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = cut(small)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
