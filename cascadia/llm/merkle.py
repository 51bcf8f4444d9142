"""Merkle manifest of a dataset, and a recursive query that climbs it.

Every row becomes a leaf digest. Per group (a language) the leaves are numbered in key order
and joined two by two, level by level, to a subroot; the subroots, in group order, likewise
to the root. Levels are built ``SPAN`` at a time: the 2**SPAN consecutive nodes under one node
of the next stored level make one bounded list, whose levels are computed in the JVM. What is
stored are parent-linked node rows: id, parent id, digest, and the steps from the node to its
parent (the sibling's digest, null where a node is alone, and whether it stands left).

:func:`climb` is a Spark recursive query over these rows: its anchor is one row a leaf, each
round joins the row of the parent, appends the siblings and folds a digest through them, until
no parent is left: a round a stored level, ``levels / SPAN`` in all.

Nothing is gathered beyond 2**SPAN digests; rows are numbered in range slices, so neither a
common group nor a common key is one task's work.

Defined results: null values of any field count as ``-`` in the leaf; a null group is a group of
its own, first in order; rows with equal keys are ordered by their leaf digest, equal rows are
leaves side by side; other columns have no part; long texts cost one digest; no rows give no
nodes, no root and no proofs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascadia.functions.ordered import running_sums
from cascadia.llm.common import stored

#: Levels between stored rows.
SPAN = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256, in hex, of the values one after another: ``-`` if null, else length, ``:``, value."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(
            F.when(value.isNull(), F.lit("-")).otherwise(
                F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
            )
        )
    return F.sha2(F.concat(*parts).cast("binary"), 256)


class Manifest(NamedTuple):
    """``leaves``: key, leaf, altered, node id, parent, steps. ``nodes``: the rows above them."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def build_manifest(
    docs: DataFrame,
    altered: Mapping[str, Column],
    key: str = "doc_id",
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
    span: int = SPAN,
) -> Manifest:
    """The stored levels over ``docs``; ``altered`` gives fields with a value to be tested later.

    The leaf digest of a row with the altered values goes along as ``altered``.
    """
    changed = [altered.get(f, F.col(f)) for f in fields]
    rows = docs.select(
        # Null first, then by the bytes of the group.
        F.when(F.col(group).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(group).cast("string"))).alias("tree"),
        F.col(key).alias("key"),
        leaf_digest([F.col(f) for f in fields]).alias("hash"),
        leaf_digest(changed).alias("altered"),
    )
    # One pass over the texts; what follows reads digests.
    rows = stored(rows, "leaves").withColumns(
        {"one": F.lit(1).cast("long"), "tie": F.monotonically_increasing_id()}
    )
    # Equal rows are interchangeable, so the tie only spreads them over range slices.
    numbered = running_sums(rows, ["tree"], ["key", "hash", "tie"], {"one": "idx"}, sliced=True)
    numbered = numbered.select("tree", F.expr("idx - 1").alias("idx"), "hash", "key", "altered")
    leaves, above, tops = _levels(numbered, span, "leaf")
    ranked = running_sums(tops.withColumn("one", F.lit(1).cast("long")).withColumn("all", F.lit("")), ["all"], ["tree"], {"one": "idx"}, sliced=True)
    ranked = ranked.select(
        F.col("all").alias("tree"), F.expr("idx - 1").alias("idx"), "hash", F.concat(F.lit("/"), "tree").alias("id")
    )
    entries, over, last = _levels(ranked, span, "top")
    root = last.first()
    heads = entries.select(F.col("id").alias("node"), "parent", "hash", "steps", F.col("hash").alias("subroot"))
    nodes = heads
    for rest in (*above, *over):
        nodes = nodes.unionByName(rest.withColumn("subroot", F.lit(None).cast("string")))
    return Manifest(leaves, nodes, root["hash"] if root else None)


def _levels(rows: DataFrame, span: int, label: str) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Stored node rows from the bottom up, and per tree the digest at its top.

    ``rows`` has ``tree, idx, hash`` and columns to keep. Each pass links the nodes of one
    stored level to those ``span`` levels above; a tree that has one node left is done.
    """
    extra = [c for c in rows.columns if c not in ("tree", "idx", "hash")]
    # The size of a tree goes to each of its blocks, so that no tree is one key of the join.
    block = f"idx div {1 << span}"
    sizes = rows.groupBy("tree").agg((F.max("idx") + 1).alias("size"))
    sizes = sizes.withColumn("block", F.explode(F.expr(f"sequence(0L, (size - 1) div {1 << span})")))
    level = rows.withColumn("block", F.expr(block)).join(sizes, ["tree", "block"])
    out, done, stage = [], [], 0
    largest = None
    while largest is None or largest > 1:
        keep = extra if stage == 0 else []
        linked = stored(_link(level, span, stage, keep), f"merkle-{label}")
        nodes = linked.select(
            F.explode("entries").alias("e"), "parent", "tree"
        ).select("tree", "e.*", "parent")
        out.append(nodes.drop("tree"))
        above = linked.select("tree", F.col("block").alias("idx"), F.col("top").alias("hash"), "size")
        done.append(above.where("size = 1").select("tree", "hash"))
        level, stage = above.where("size > 1").withColumn("block", F.expr(block)), stage + 1
        largest = level.agg(F.max("size")).first()[0] or 0
    tops = done[0]
    for more in done[1:]:
        tops = tops.unionByName(more)
    return out[0], [n.withColumnRenamed("id", "node") for n in out[1:]], tops


def _link(level: DataFrame, span: int, stage: int, keep: Sequence[str]) -> DataFrame:
    """One row a block of 2**span nodes: its entries with their steps, and the digest above them."""
    width = 1 << span
    blocks = level.groupBy("tree", "block", "size").agg(
        F.array_sort(F.collect_list(F.struct("idx", "hash", *keep))).alias("rows")
    )
    # A tree that fits in one block ends in its one node, others rise by the full span.
    depth = f"CASE WHEN size > {width} THEN {span} ELSE CAST(ceil(log2(size)) AS int) END"
    blocks = blocks.withColumns({"depth": F.expr(depth), "l0": F.col("rows.hash")})
    for k in range(span):
        pair = f"sha2(concat(get(l{k}, 2 * i), coalesce(get(l{k}, 2 * i + 1), '')), 256)"
        rise = f"transform(sequence(0, (size(l{k}) - 1) div 2), i -> {pair})"
        blocks = blocks.withColumn(f"l{k + 1}", F.expr(f"CASE WHEN depth > {k} THEN {rise} ELSE l{k} END"))
    steps = ", ".join(
        f"struct((shiftright(p, {k}) & 1) = 1 AS left, unhex(get(l{k}, shiftright(p, {k}) ^ 1)) AS digest)" for k in range(span)
    )
    own = "r.id" if "id" in keep else f"concat(tree, '/{stage}/', r.idx)"
    fields = "".join(f", r.{c} AS {c}" for c in keep if c != "id")
    entry = f"struct({own} AS id, r.hash AS hash, slice(array({steps}), 1, depth) AS steps{fields})"
    new_size = f"CASE WHEN size > {width} THEN (size + {width - 1}) div {width} ELSE 1L END"
    # The one node of a tree is its entry among the trees; over all trees there is nothing.
    parent = f"CASE WHEN size > {width} THEN concat(tree, '/{stage + 1}/', block) WHEN tree <> '' THEN concat('/', tree) END"
    return blocks.select(
        "tree",
        "block",
        F.expr(new_size).cast("long").alias("size"),
        F.expr(f"get(l{span}, 0)").alias("top"),
        F.expr(parent).alias("parent"),
        F.expr(f"transform(rows, (r, p) -> {entry})").alias("entries"),
    )


_FOLD = """aggregate({steps}, {start}, (acc, s) -> sha2(concat(
  if(s.left, lower(hex(s.digest)), ''), acc, if(s.left or s.digest is null, '', lower(hex(s.digest)))), 256))"""
_APPEND = "aggregate({steps}, {start}, (acc, s) -> concat(acc, coalesce(s.digest, X'')))"

_CLIMB = f"""
WITH RECURSIVE climb(key, leaf, parent, subroot, folded, proof) AS (
  SELECT key, hash, parent, CAST(NULL AS string),
         {_FOLD.format(steps="steps", start="altered")}, {_APPEND.format(steps="steps", start="X''")}
  FROM {{leaves}}
  UNION ALL
  SELECT c.key, c.leaf, n.parent, coalesce(c.subroot, n.subroot),
         {_FOLD.format(steps="n.steps", start="c.folded")}, {_APPEND.format(steps="n.steps", start="c.proof")}
  FROM climb c JOIN {{nodes}} n ON c.parent = n.node)
SELECT key, leaf, subroot, folded, sha2(CAST(lower(hex(proof)) AS binary), 256) AS proof_sha256
FROM climb WHERE parent IS NULL"""


def climb(manifest: Manifest) -> DataFrame:
    """Per leaf ``key, leaf, subroot, folded, proof_sha256``: the recursive ascent to the root.

    ``folded`` is what the altered leaf and the original siblings give at the top;
    ``proof_sha256`` is the digest of all siblings on the way, left to right. The recursion
    ends by itself, so its row limit is lifted while it runs, and its result is stored.
    """
    spark = manifest.leaves.sparkSession
    before = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        return stored(spark.sql(_CLIMB, leaves=manifest.leaves, nodes=manifest.nodes), "climb")
    finally:
        spark.conf.set(_ROW_LIMIT, before)


def audit(docs: DataFrame, altered: Mapping[str, Column], key: str = "doc_id", span: int = SPAN) -> DataFrame:
    """Per row of ``docs`` its leaf, subroot, root, proof, folded root and whether that is the root."""
    manifest = build_manifest(docs, altered, key=key, span=span)
    found = climb(manifest)
    root = F.lit(manifest.root).cast("string")
    return found.select(
        F.col("key").alias(key),
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        F.col("folded").alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )
