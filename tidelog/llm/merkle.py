"""Merkle manifest of a dataset by an exchange of cogrouped subtrees.

*Leaves* are digests of whole rows, ordered inside their tree (one for each language) by doc_id.  Their positions come from
one range sort: a row's place in its partition plus the rows of its tree in the partitions before.
*Up.*  Each superblock of ``SIZE`` consecutive nodes of a tree is reduced to its root in one task; the roots are the nodes of
the next round, until a tree is one node.  The roots of the trees, in order of language, are the nodes of one more tree.
*Down.*  Nodes and the required outer nodes (the siblings above their superblock) are cogrouped by superblock; the
task repeats the local reduction, joins each node's own siblings with the outer ones to its proof and, for leaves,
folds the proof.  No task holds more than a superblock and no list grows with the dataset but by its logarithm.

An entry of a proof is ``<`` or ``>`` and the digest of a left or right sibling, or empty where a lone node is hashed by itself.

Rows are ordered by doc_id (null first), then by leaf; equal rows are leaves of their own.  A null language is a tree like
others and comes first.  A null value counts as ``-``.  A row without id is not among those that are tampered with.  An empty
table gives an empty result.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SIZE = 4096  # a power of two
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row, with other values for some of its fields."""
    return F.sha2(F.concat(*(_field(changed.get(c, F.col(c))) for c in FIELDS)), 256)


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def reduce_block(nodes: Sequence[str], n: int, size: int) -> list[list[str]]:
    """Levels of a superblock: of the whole tree, where it has one superblock only, else up to the superblock's root."""
    levels, width = [list(nodes)], n if n <= size else size
    while width > 1:
        below = levels[-1]
        levels.append([_h("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
        width = (width + 1) // 2
    return levels


def siblings(levels: list[list[str]], i: int) -> list[str]:
    """Proof entries of node ``i`` up to the root of its superblock."""
    out = []
    for level in levels[:-1]:
        other = i ^ 1
        out.append("" if other >= len(level) else "<" + level[other] if other < i else ">" + level[other])
        i //= 2
    return out


def fold(node: str, proof: Sequence[str]) -> str:
    """The root that a node and its proof give."""
    for entry in proof:
        node = _h(entry[1:] + node if entry[:1] == "<" else node + entry[1:])
    return node


def _block() -> Column:
    return F.floor(F.col("pos") / F.lit(SIZE)).alias("block")


def _reduced(nodes: DataFrame) -> DataFrame:
    """The roots of superblocks as the nodes of the next round."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        tree, pos, n = (int(rows[c].iloc[0]) for c in ("tree", "pos", "n"))
        top = reduce_block(rows["node"].tolist(), n, SIZE)[-1][0]
        return pd.DataFrame({"tree": [tree], "pos": [pos // SIZE], "n": [-(-n // SIZE)], "node": [top]})

    return nodes.select("tree", "pos", "n", "node").groupBy("tree", _block()).applyInPandas(run, "tree long, pos long, n long, node string")


def _rounds(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Nodes of each round, the first given, the last with one node for each tree."""
    largest, levels = nodes.agg(F.max("n")).first()[0] or 1, [nodes]
    while len(levels) == 1 or largest > 1:
        levels.append(cut(_reduced(levels[-1]), f"{label}-{len(levels)}"))
        largest = -(-largest // SIZE)
    return levels


_OUTER = "tree long, pos long, proof array<string>, subroot string, root string"


def _down(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """``outer`` one round lower: proofs of ``nodes``."""

    def run(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels = reduce_block(rows["node"].tolist(), int(rows["n"].iloc[0]), SIZE)
        rest = list(above["proof"].iloc[0])
        return pd.DataFrame({"tree": rows["tree"], "pos": rows["pos"], "proof": [siblings(levels, i) + rest for i in range(len(rows))],
                             "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0]})

    return nodes.select("tree", "pos", "n", "node").groupBy("tree", _block()).cogroup(
        outer.groupBy("tree", F.col("pos").alias("block"))).applyInPandas(run, _OUTER)


_PROVED = "id string, node string, proof array<string>, proof_sha256 string, subroot string, root string, folded_root string"


def _prove(leaves: DataFrame, outer: DataFrame) -> DataFrame:
    def run(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels = reduce_block(rows["node"].tolist(), int(rows["n"].iloc[0]), SIZE)
        rest = list(above["proof"].iloc[0])
        proofs = [siblings(levels, i) + rest for i in range(len(rows))]
        folded = [fold(other or node, proof) for other, node, proof in zip(rows["other"], rows["node"], proofs)]
        return pd.DataFrame({"id": rows["id"], "node": rows["node"], "proof": proofs, "proof_sha256": [_h("".join(e[1:] for e in p)) for p in proofs],
                             "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0], "folded_root": folded})

    return leaves.groupBy("tree", _block()).cogroup(outer.groupBy("tree", F.col("pos").alias("block"))).applyInPandas(run, _PROVED)


def placed(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with tree (the rank of ``group``, null first), pos (place in the group by ``order``) and n (rows of the group)."""
    # equal rows are told apart by a number, so that a row repeated over and over fills more than one partition
    rows = cut(rows.withColumn("_copy", F.xxhash64(F.monotonically_increasing_id())), f"{label}-rows")
    rows = rows.repartitionByRange(group, *order, "_copy").sortWithinPartitions(group, *order, "_copy").drop("_copy")
    rows = cut(rows.withColumn("_at", F.monotonically_increasing_id()), f"{label}-sorted").withColumn("_part", F.shiftright("_at", 33))
    # groups of a partition: as many as partitions and groups together, at most
    pieces = cut(rows.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows")), f"{label}-pieces")
    before = Window.partitionBy(group).orderBy("_part")
    pieces = pieces.withColumns({
        "_before": F.coalesce(F.sum("_rows").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "n": F.sum("_rows").over(Window.partitionBy(group))})
    heads = pieces.filter("_before = 0").select(F.col(group).alias("_group"), "_part", F.row_number().over(Window.partitionBy("_part").orderBy(group)).alias("_place"))
    # one row for each partition
    starts = heads.groupBy("_part").agg(F.count("*").alias("_heads"))
    starts = starts.select("_part", F.coalesce(F.sum("_heads").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    trees = heads.join(starts, "_part").select("_group", (F.col("_start") + F.col("_place") - 1).alias("tree"))
    pieces = pieces.join(trees, F.col(group).eqNullSafe(F.col("_group"))).select(
        F.col(group).alias("_group"), F.col("_part").alias("_piece"), "_first", "_before", "n", "tree")
    rows = rows.join(pieces, (F.col("_part") == F.col("_piece")) & F.col(group).eqNullSafe(F.col("_group")))
    return rows.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_piece", "_group", "_first", "_before")


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, proof_sha256, folded_root, verified) of each row.

    Where ``tampered`` holds, the proof is folded from the row with 1 added to n_chars; all else is that of the rows as they are.
    """
    kinds = dict(docs.dtypes)
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    other = F.when(F.coalesce(tampered, F.lit(False)), leaf_digest(n_chars=more)) if tampered is not None else F.lit(None).cast("string")
    leaves = docs.select(*FIELDS).select(F.col("doc_id").alias("key"), F.col("doc_id").cast("string").alias("id"), F.col("lang"), leaf_digest().alias("node"), other.alias("other"))
    leaves = cut(placed(leaves, "lang", ["key", "node"], "leaves").drop("key", "lang"), "leaves")
    trees = _rounds(leaves, "tree")
    # the trees' roots are the nodes of the last tree
    roots = trees[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(trees[-1].count()).cast("long").alias("n"), "node")
    tops = _rounds(roots, "top")
    outer = tops[-1].select("tree", "pos", F.array().cast("array<string>").alias("proof"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    for nodes in reversed(tops[:-1]):
        outer = _down(nodes, outer)
    outer = outer.select(F.col("pos").alias("tree"), "proof", "root").join(trees[-1].select("tree", F.col("node").alias("subroot")), "tree")
    outer = outer.select("tree", F.lit(0).cast("long").alias("pos"), "proof", "subroot", "root")
    for nodes in reversed(trees[1:-1]):
        outer = _down(nodes, outer)
    return _prove(leaves, cut(outer, "outer")).select(
        F.col("id").cast(kinds["doc_id"]).alias("doc_id"), F.col("node").alias("leaf"), "subroot", "root", "proof", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
