"""Merkle manifest of a dataset that stores every second level of its trees.

Each document is a leaf; the leaves of a language, in order of doc_id, form one tree of runs of
``ARITY`` nodes, and the language roots, in order of the language, form one more. ``build``
persists levels 0, 2, 4, ... (``STRIDE`` apart): an aligned subtree has ``ARITY ** STRIDE``
stored descendants and one stored top. ``proofs`` regenerates the missing nodes of a subtree
from its stored descendants, writes each descendant's siblings into its path and drops the
regenerated nodes; paths grow downwards from the root, one stored level at a time.

A group is never more than one subtree (64 nodes). Leaves are numbered over ranges of
(language, doc_id), so one language may hold any share of the rows. The driver sees the height
of the tallest tree and the root.

Defined results: a null column enters its leaf as ``-``; a null lang is a language of its own,
before all others; a null doc_id stands before all others and is never tampered with; rows that
repeat a doc_id are leaves of their own, in order of their leaf; a very long text is hashed
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import string
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countermill.llm.common import scratch_dir
from countermill.llm.sql_parts import CRC_TABLE, crc32
from countermill.llm.sql_parts import ascii_lower as sql_lower
from countermill.operators.ordering import numbered

ARITY = 8
STRIDE = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One step of a path: place of a node in its run and the other nodes of that run.
STEP = "struct<place:int,others:array<string>>"


def leaf(*fields: Column) -> Column:
    """Digest of fields, each ``-`` or its byte count, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    coded = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*coded), 256)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree and leaf of each document, and ``claimed``, the leaf that a verifier finds:
    that of the text in lower case where 3 divides the checksum of doc_id."""
    own = {c: F.col(c) for c in FIELDS}
    changed = F.crc32(F.encode(own["doc_id"].cast("string"), "UTF-8")) % 3 == 0
    lowered = leaf(*(own | {"text": ascii_lower(own["text"])}).values())
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
        leaf(*own.values()).alias("node"),
        F.when(changed, lowered).alias("_lowered"),
    )
    return rows.withColumn("claimed", F.coalesce("_lowered", "node")).drop("_lowered")


def _height(size: Column) -> Column:
    """Levels above the leaves: the least n with ARITY ** n >= size."""
    return sum((F.when(size > ARITY**n, 1).otherwise(0) for n in range(21)), F.lit(0)).cast("int")


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add each leaf's ``pos`` in its tree and the tree's ``height``."""
    return numbered(rows, ["tree"], order, "pos", "_size").withColumn("height", _height(F.col("_size"))).drop("_size")


def _level_path(folder: str, level: int) -> str:
    return os.path.join(folder, f"level_{level:02d}")


def _subtrees(nodes: DataFrame, level: int, *carried: str) -> DataFrame:
    """One row for each aligned subtree below a stored level: its stored descendants in order,
    their runs and the regenerated nodes above the runs."""
    block = F.expr(f"pos div {ARITY**STRIDE}")
    groups = nodes.groupBy("tree", block.alias("block"), "height").agg(
        F.sort_array(F.collect_list(F.struct("pos", "node", *carried))).alias("nodes")
    )
    return groups.selectExpr(
        "*",
        f"transform(sequence(0, (size(nodes) - 1) div {ARITY}), r -> "
        f"transform(slice(nodes, cast(r * {ARITY} + 1 as int), {ARITY}), x -> x.node)) as runs",
    ).selectExpr("*", "transform(runs, r -> sha2(array_join(r, ''), 256)) as ups", f"height - {level} > 1 as whole")


def build(rows: DataFrame, folder: str) -> list[DataFrame]:
    """Write levels 0, STRIDE, 2 * STRIDE, ... of the trees of placed leaves; the stored tables."""
    spark = rows.sparkSession

    def stored(frame: DataFrame, level: int) -> DataFrame:
        path = _level_path(folder, level)
        frame.write.mode("overwrite").parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    tables = [stored(rows, 0)]
    top = tables[0].agg(F.max("height")).first()[0] or 0
    for level in range(0, top, STRIDE):
        subtrees = _subtrees(tables[-1].where(F.col("height") > level), level)
        node = F.when(F.col("whole"), F.sha2(F.array_join("ups", ""), 256)).otherwise(F.col("ups")[0])
        above = subtrees.select("tree", F.col("block").alias("pos"), "height", node.alias("node"))
        tables.append(stored(above, level + STRIDE))
    return tables


def tops(tables: list[DataFrame]) -> DataFrame:
    """Top node of each tree."""
    found = [t.where(F.col("height") <= i * STRIDE).select("tree", "node") for i, t in enumerate(tables)]
    whole = found[0]
    for frame in found[1:]:
        whole = whole.unionByName(frame)
    return whole


def _others(nodes: str, place: str) -> str:
    return f"filter({nodes}, (x, k) -> k != {place})"


def proofs(tables: list[DataFrame], above: DataFrame, carried: tuple[str, ...]) -> DataFrame:
    """Path of every leaf: ``above`` (tree, subroot, path from the tree's top) continued down
    the stored levels. Returns tree, node, carried columns, subroot and path."""
    paths = None
    for index in range(len(tables) - 1, -1, -1):
        level, keep = index * STRIDE, carried if index == 0 else ()
        nodes = tables[index]
        done = nodes.where(F.col("height") <= level).join(above, "tree")
        here = done.select("tree", "pos", "node", *keep, "subroot", "path")
        if paths is not None:
            subtrees = _subtrees(nodes.where(F.col("height") > level), level, *keep)
            upper = paths.select("tree", F.col("pos").alias("block"), "subroot", "path")
            each = subtrees.join(upper, ["tree", "block"]).select(
                "tree", "runs", "ups", "whole", "subroot", "path", F.posexplode("nodes").alias("i", "at")
            )
            run = f"named_struct('place', cast(i % {ARITY} as int), 'others', {_others(f'runs[i div {ARITY}]', f'i % {ARITY}')})"
            up = f"named_struct('place', cast(i div {ARITY} as int), 'others', {_others('ups', f'i div {ARITY}')})"
            below = each.selectExpr(
                "tree",
                "at.pos as pos",
                "at.node as node",
                *(f"at.{c} as {c}" for c in keep),
                "subroot",
                f"concat(if(whole, array({run}, {up}), array({run})), path) as path",
            )
            here = here.unionByName(below)
        paths = here
    return paths.drop("pos")


def folded(node: str, path: str) -> Column:
    """Root that a node and the siblings on its path give."""
    run = "concat(slice(s.others, 1, s.place), array(h), slice(s.others, s.place + 1, size(s.others)))"
    return F.expr(f"aggregate({path}, {node}, (h, s) -> sha2(array_join({run}, ''), 256))")


def manifest(docs: DataFrame, folder: str) -> tuple[DataFrame, str | None]:
    """Write the trees below ``folder`` (``documents/level_NN``, ``languages/level_NN``). Returns
    doc_id, leaf, claimed leaf, subroot and path of every document, and the root."""
    rows = placed(leaves(docs), ["doc_id", "node", "claimed"])
    tables = build(rows, os.path.join(folder, "documents"))
    subroots = tops(tables).select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node")
    over = build(placed(subroots, ["of"]), os.path.join(folder, "languages"))
    root = tops(over).first()
    start = tops(over).select("tree", F.lit(None).cast("string").alias("subroot"), F.expr(f"cast(array() as array<{STEP}>)").alias("path"))
    above = proofs(over, start, ("of",)).select(F.col("of").alias("tree"), F.col("node").alias("subroot"), "path")
    found = proofs(tables, above, ("doc_id", "claimed"))
    return found.select("doc_id", F.col("node").alias("leaf"), "claimed", "subroot", "path"), root and root.node


def prove(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Leaf, roots, digest of the proof and outcome of verifying each document, where some
    texts were changed after the manifest was made."""
    spark = docs.sparkSession
    folder = folder or os.path.join(scratch_dir(spark), f"merkle-{uuid.uuid4().hex}")
    found, root = manifest(docs, folder)
    siblings = F.expr("array_join(flatten(transform(path, s -> s.others)), '')")
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        F.lit(root).cast("string").alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded("claimed", "path").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(text: str) -> str:
    fields = [text if c == "text" else f"{c}::VARCHAR" for c in FIELDS]
    coded = (f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields)
    return f"sha256({' || '.join(coded)})"


def _tree_sql(name: str, placed_leaves: str) -> str:
    """Nodes of all levels and runs of all levels below the top, from (tree, pos, node, n)."""
    return f"""
{name}_nodes AS (
  SELECT tree, 0 AS level, pos, node, n FROM {placed_leaves}
  UNION ALL
  SELECT tree, level + 1, pos // {ARITY}, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + {ARITY - 1}) // {ARITY}
  FROM {name}_nodes WHERE n > 1 GROUP BY tree, level, pos // {ARITY}),
{name}_runs AS (
  SELECT tree, level, pos // {ARITY} AS block, list(node ORDER BY pos) AS run
  FROM {name}_nodes WHERE n > 1 GROUP BY ALL),
{name}_tops AS (SELECT tree, node, level FROM {name}_nodes WHERE n = 1)"""


ORACLE_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql("text")} AS node,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf_sql(sql_lower("text"))} ELSE {_leaf_sql("text")} END AS claimed
  FROM documents, crc_table),
placed AS (
  SELECT *, row_number() OVER in_tree - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n, row_number() OVER () AS id
  FROM leaves WINDOW in_tree AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node, claimed)),
{_tree_sql("doc", "placed")},
languages AS (
  SELECT '' AS tree, tree AS lang, node, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM doc_tops),
{_tree_sql("lang", "languages")},
steps AS (
  SELECT p.id, r.level AS step, (p.pos // ({ARITY}**r.level)::BIGINT) % {ARITY} AS place, r.run
  FROM placed p JOIN doc_runs r ON r.tree = p.tree AND r.block = p.pos // ({ARITY}**(r.level + 1))::BIGINT
  UNION ALL
  SELECT p.id, t.level + r.level, (l.pos // ({ARITY}**r.level)::BIGINT) % {ARITY}, r.run
  FROM placed p JOIN doc_tops t ON t.tree = p.tree JOIN languages l ON l.lang = p.tree
    JOIN lang_runs r ON r.block = l.pos // ({ARITY}**(r.level + 1))::BIGINT),
siblings AS (
  SELECT id, count(*) AS steps,
    string_agg(array_to_string(run[:place] || run[place + 2:], ''), '' ORDER BY step) AS proof
  FROM steps GROUP BY id),
fold AS (
  SELECT id, 0 AS step, claimed AS node FROM placed
  UNION ALL
  SELECT f.id, f.step + 1, sha256(array_to_string(run[:place] || [f.node] || run[place + 2:], ''))
  FROM fold f JOIN steps s ON s.id = f.id AND s.step = f.step)
SELECT p.doc_id, p.node AS leaf, d.node AS subroot, r.node AS root, sha256(coalesce(s.proof, '')) AS proof_sha256,
  f.node AS folded_root, f.node = r.node AS verified
FROM placed p JOIN doc_tops d ON d.tree = p.tree CROSS JOIN lang_tops r
  LEFT JOIN siblings s ON s.id = p.id
  JOIN fold f ON f.id = p.id AND f.step = coalesce(s.steps, 0)
"""
