"""Similarity join on word shingles by chosen paths.

A text is the set of its 5-word shingles (64-bit hashes; a text of fewer words has one shingle, all its words).  Equal sets
are one set with a multiplicity.  A set is embedded as ``TOKENS`` (coordinate, minimum hash) tokens, of which two sets share
a part equal to their Jaccard similarity in expectation.

*Chosen paths.*  In each run a path grows by tokens sampled with chance 1 / (similarity * TOKENS) by a hash of path and
coordinate, the same choice for all sets on the path; sets go to the bucket of each path they choose.  Buckets above
``SPLIT`` are split by another sampled token, ``DEPTH`` levels deep at most.  A pair at the threshold shares a bucket of depth 1
with chance 0.63 a run and one of depth 6 with 0.24, and the number of runs is taken so that the target recall holds there.
*Brute force.*  Small buckets (each membership once) are compared pair by pair on all tokens.  In buckets that do not get small,
groups of mutual near copies, all members are compared with a pivot first and get one edge to it where they agree.  Members that
do not agree with the pivot are then compared with all members, those that do once for all buckets of one pivot, in tiles of two blocks, so that none is dropped, no task holds a
whole bucket, and edges are in proportion to members.  Pairs that agree on three quarters of the threshold connect to candidate clusters.
*Exact check.*  All pairs inside a cluster are compared on the full sets, again in tiles, which gives links, their number
for each set, and edges that span them; pairs themselves are never written.  Classes are the components of links.

Null and blank texts have no shingle, no link and their own id as class.  Rows with equal texts are linked; repeated ids are
told apart by their texts.  A class is named by its least doc_id (null if none has one).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, cut, lean, mix, row_key, text_buffer, words
from .components import components
from .naming import spread_join

SHINGLE, SIMILARITY, TOKENS, RECALL = 5, Fraction(4, 5), 64, 0.997
BLOCK, WIDE, SPLIT, DEPTH = 512, 2048, 4096, 6  # WIDE: of signatures, which are small
_PIECE = 1 << 14
_BYTES = 1 << 20  # of texts whose words are in memory at once, if no text is longer
_SEEDS = mix(np.arange(1, 2 * TOKENS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def n_runs(recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met in a bucket of ``depth`` with this chance."""
    meets = 1.0
    for _ in range(depth):
        meets = 1 - math.exp(-meets)
    return math.ceil(math.log(1 - recall) / math.log(1 - meets))


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Each text's distinct shingles, in order."""
    data, at = text_buffer(column)
    found = [(h, t) for h, t, *_ in words(data, at)]
    if not found:
        for _ in range(len(at) - 1):
            yield np.empty(0, np.uint64)
        return
    h, text = (np.concatenate(x) for x in zip(*found))
    every = np.zeros(max(len(h) - size + 1, 0), np.uint64)
    for i in range(size):
        every = (every + h[i:i + len(every)]) * _SEEDS[i]
    every = mix(every)
    edge = np.searchsorted(text, np.arange(len(at)))
    for low, high in zip(edge, edge[1:]):
        if high - low >= size:
            yield np.unique(every[low:high - size + 1])
        elif high > low:
            yield np.frombuffer(xxhash.xxh3_64_digest(h[low:high].tobytes()), np.uint64)
        else:
            yield np.empty(0, np.uint64)


def signature(shingles: np.ndarray) -> bytes:
    """The least hash of each coordinate; a long text's shingles are hashed some at a time."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(shingles), _PIECE):
        hashes = (shingles[low:low + _PIECE] ^ _SEEDS[:TOKENS, None]) * (_SEEDS[TOKENS:, None] | np.uint64(1))
        least = np.minimum(least, hashes.min(1))
    return (least >> np.uint64(32)).astype("<u4").tobytes()


@lean
def _sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(it, size=_BYTES):
        size, s1, s2, signatures = [], [], [], []
        for shingles in shingle_sets(batch.column("text")):
            size.append(len(shingles))
            a, b = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
            s1.append(a)
            s2.append(b)
            signatures.append(signature(shingles) if len(shingles) else b"")
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("k1"), batch.column("k2"), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(size, pa.int64()), pa.array(signatures, pa.binary())],
            ["doc_id", "k1", "k2", "s1", "s2", "n", "signature"])


def _chosen(paths: np.ndarray, limit: float) -> np.ndarray:
    """Which coordinates each path grows by."""
    return mix(paths[:, None] ^ _SEEDS[None, TOKENS:]) < np.uint64(limit * 2.0 ** 64)


def _grow(runs: int, similarity: Fraction):
    limit = 1 / (float(similarity) * TOKENS)

    @lean
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = mix(np.arange(1, runs + 1, dtype=np.uint64))
        first, coordinate = np.nonzero(_chosen(roots, limit))
        for batch in it:
            tokens = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u4").reshape(-1, TOKENS).astype(np.uint64)
            rid = batch.column("rid").to_numpy()
            if "path" in batch.schema.names:
                old = batch.column("path").to_numpy().view(np.uint64)
                row, c = np.nonzero(_chosen(old, limit))
                parent = old[row]
            else:
                row = np.repeat(np.arange(len(rid)), len(first))
                parent, c = np.tile(roots[first], len(rid)), np.tile(coordinate, len(rid))
            path = mix(mix(parent ^ _SEEDS[TOKENS + c]) ^ tokens[row, c])
            yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(rid[row])], ["path", "rid"])

    return run


def _stars(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the first row that it is connected to, itself included."""
    first = np.full(len(linked), -1)
    for i in range(len(linked)):
        if first[i] < 0:
            front = np.zeros(len(linked), bool)
            front[i] = True
            seen = front.copy()
            while front.any():
                front = linked[front].any(0) & ~seen
                seen |= front
            first[seen] = i
    return first


def _groups(it: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows with the same first ``keys`` columns, of rows in this order."""
    group: list[tuple] = []
    for batch in it:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and row[:keys] != group[0][:keys]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def _least(similarity: Fraction) -> int:
    """Coordinates that must agree for a candidate."""
    return int(0.75 * float(similarity) * TOKENS)


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, TOKENS)


def _with_pivot(similarity: Fraction):
    @lean
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            agree = (_tokens(batch.column("signature")) == _tokens(batch.column("pivot_signature"))).sum(1) >= _least(similarity)
            yield batch.select(["pivot", "rid"]).filter(pa.array(agree))

    return run


def _by_path(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Join by path; both sides have the bucket's ``count``, by which a large one's row is copied and its members spread."""
    copies = F.ceil(F.col("count") / F.lit(BLOCK)).cast("int")
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("rid", F.lit(2)), copies).cast("int"))
    return rows.join(table.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1))).drop("count"), ["path", "_salt"]).drop("_salt")


def _pivoted(large: DataFrame, tokens: DataFrame, similarity: Fraction) -> tuple[DataFrame, DataFrame]:
    """Members of large buckets (path, rid, count) with the bucket's pivot and label (1: agrees with it), and edges (pivot, rid) of those that agree.

    The pivot is the least member, whatever the path, so that a group that meets in path after path has the same one there, and
    each of its members is compared with it once.  Where members come with it, they are not joined with their bucket once more.
    """
    rows = large
    if "pivot" not in large.columns:
        rows = cut(_by_path(large, large.groupBy("path").agg(F.max("count").alias("count"), F.min("rid").alias("pivot"))), "pivots")
    pairs = rows.filter("rid != pivot").select("pivot", "rid").distinct()
    chosen = pairs.groupBy("pivot").agg(F.count("*").alias("count")).join(
        tokens.select(F.col("rid").alias("pivot"), F.col("signature").alias("pivot_signature")), "pivot")
    asked = spread_join(pairs, chosen, ["pivot"]).join(tokens, "rid").select("pivot", "rid", "signature", "pivot_signature")
    edges = cut(asked.mapInArrow(_with_pivot(similarity), "pivot long, rid long"), "pivot-edges")
    marked = rows.join(edges.withColumn("agrees", F.lit(1)), ["pivot", "rid"], "left")
    return marked.select("path", "rid", "count", "pivot", F.when(F.col("rid") == F.col("pivot"), 1).otherwise(F.coalesce("agrees", F.lit(0))).alias("label")), edges


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _compared(members: DataFrame) -> DataFrame:
    """(path, rid, count, pivot, label, meets) of the members of large buckets that are compared with others; rows with the path are ``count`` at most.

    A group meets in path after path with one pivot.  Members that agree with it are there once a pivot, under the pivot in place of
    the path, and so are the others, which meet them there.  The others are compared with each other there too (``meets``) if that
    takes no more pairs than path by path.  The pivot itself has been compared with all.
    """
    pairs = cut(members.filter("rid != pivot").groupBy("pivot", "rid").agg(F.max("label").alias("label")), "pivot-pairs")
    n = [F.count(F.when(F.col("label") == k, 1)).alias(f"n_{k}") for k in (0, 1)]
    others = members.filter("label = 0").select("path", "rid", "count", "pivot", "label")
    of_path = others.groupBy("pivot", "path").agg(F.count("*").alias("n")).groupBy("pivot").agg(
        F.sum(F.col("n").cast("double") * F.col("n")).alias("apart"))
    pivots = pairs.groupBy("pivot").agg(F.count("*").alias("count"), *n).join(of_path, "pivot")
    pivots = cut(pivots.withColumn("meets", F.col("n_0").cast("double") * F.col("n_0") <= F.col("apart")), "pivot-counts")
    once = spread_join(pairs, pivots.select("pivot", "count", "n_1", "meets"), ["pivot"]).filter("meets OR n_1 > 0")
    once = once.select(F.col("pivot").alias("path"), "rid", "count", "pivot", "label", "meets")
    # the bucket's count serves for the rows that stay in their path
    paths = others.join(pivots.filter("NOT meets").select("pivot"), "pivot").withColumn("meets", F.lit(True))
    return cut(once.unionByName(paths), "compared")


def _labelled_tiles(members: DataFrame, tokens: DataFrame) -> DataFrame:
    """(path, i, j, root, rid, signature) in which a bucket's members share a tile of two blocks, but for two of label 1, which are
    connected by the pivot: it is their root."""
    members = _compared(members)
    counts = members.groupBy("path", "label").agg(
        F.max("count").alias("count"), F.max("meets").alias("meets"), F.ceil(F.count("*") / F.lit(WIDE)).cast("int").alias("blocks"))
    blocks = [F.coalesce(F.max(F.when(F.col("label") == k, F.col("blocks"))), F.lit(0)).alias(f"blocks_{k}") for k in (0, 1)]
    counts = counts.groupBy("path").agg(F.max("count").alias("count"), F.max("meets").alias("meets"), *blocks).filter("blocks_0 > 0")
    rows = _by_path(members.drop("meets"), counts)
    own = F.when(F.col("label") == 0, F.col("blocks_0")).otherwise(F.col("blocks_1"))
    rows = rows.withColumn("_own", F.struct("label", F.pmod(F.xxhash64("rid", F.lit(1)), own).cast("int").alias("block")))

    def of(label: int) -> Column:
        n = F.col(f"blocks_{label}")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda k: F.struct(F.lit(label).alias("label"), k.alias("block"))))

    # a member without the label meets all blocks, or those with it alone; one with it meets those without
    others = F.when((F.col("label") == 1) | (F.col("blocks_1") == 0), of(0)).when(F.col("meets"), F.concat(of(0), of(1))).otherwise(of(1))
    root = F.when(F.col("label") == 1, F.col("pivot")).otherwise(F.col("rid"))
    rows = rows.withColumn("_other", F.explode(others))
    rows = rows.select("path", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), root.alias("root"), "rid")
    return rows.join(tokens, "rid").select("path", "i", "j", "root", "rid", "signature").repartition("path", "i", "j").sortWithinPartitions("path", "i", "j")


def _agree(similarity: Fraction):
    @lean
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        above: dict[int, int] = {}  # a forest of the sets that the task has connected: an edge inside a tree says nothing new

        def top(x: int) -> int:
            while (up := above.setdefault(x, x)) != x:
                above[x] = x = above[up]
            return x

        for group in _groups(it, 3):
            root, rid = [x[3] for x in group], [x[4] for x in group]
            tokens = np.frombuffer(b"".join(x[5] for x in group), "<u4").reshape(-1, TOKENS)
            linked = np.empty((len(rid), len(rid)), bool)
            for low in range(0, len(rid), 64):
                same = np.zeros((min(64, len(rid) - low), len(rid)), np.uint8)
                for c in range(TOKENS):
                    same += tokens[low:low + 64, c, None] == tokens[None, :, c]
                linked[low:low + 64] = same >= _least(similarity)
            roots = np.array(root)
            linked |= roots[:, None] == roots[None, :]
            first: dict[int, int] = {}
            for x, of in zip(rid, root):
                # sets of one root are connected already
                if (one := top(first.setdefault(of, x))) != (other := top(x)):
                    above[other] = one
            for x, y in enumerate(_stars(linked)):
                if x != y and (one := top(rid[y])) != (other := top(rid[x])):
                    above[other] = one
                    a.append(rid[y])
                    b.append(rid[x])
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count[column] > 1
    number = np.cumsum(count > 1) - 1
    owner, column = owner[common], number[column[common]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    wide = max(64, (1 << 22) // len(sets))
    top = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, top, wide):
        begin, end = np.searchsorted(column, (low, low + wide))
        dense = np.zeros((len(sets), min(wide, top - low)), np.float32)
        dense[owner[begin:end], column[begin:end] - low] = 1
        out += dense @ dense.T
    return out.astype(np.int64)


def _links(similarity: Fraction):
    p, q = similarity.numerator, similarity.denominator

    @lean
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(it, 3):
            # a set whose text comes in several rows is there once
            rows = list({x[4]: x for x in group}.values())
            rid, block, mult = (np.array([x[i] for x in rows]) for i in (4, 3, 5))
            sets = [np.frombuffer(x[6], np.uint64) for x in rows]
            size, both = np.array([len(s) for s in sets]), _shared(sets)
            linked = both * (p + q) >= p * (size[:, None] + size[None, :])
            np.fill_diagonal(linked, False)
            if group[0][1] != group[0][2]:
                linked &= block[:, None] != block[None, :]
            links, first = linked @ mult, _stars(linked)
            some = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(rid[some]), pa.array(rid[first[some]]), pa.array(links[some].astype(np.int64))], ["a", "b", "links"])

    return run


def _tiles(rows: DataFrame, group: str, member: str, count: Column, *rest: str) -> DataFrame:
    """(group, i, j, block, member, rest) in which every pair of a group's members shares a tile of two blocks of about BLOCK."""
    blocks = F.ceil(count / F.lit(BLOCK)).cast("int")
    rows = rows.withColumn("_blocks", blocks).withColumn("block", F.pmod(F.xxhash64(member, F.lit(1)), "_blocks").cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    # a block meets itself in one tile of its own; with two blocks or more it is already with each other one
    rows = rows.select(group, F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"), "block", member, *rest)
    return rows.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


@lean
def _texts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(it, size=_BYTES):
        sets = pa.array([s.tobytes() for s in shingle_sets(batch.column("text"))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("root", "rid", "mult", "count")] + [sets], ["root", "rid", "mult", "count", "shingles"])


def similarity_classes(docs: DataFrame, similarity: Fraction = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(doc_id, k1, k2, class_id, first_k1, first_k2, n_links) for each row of ``docs``.

    k1, k2 stand for the row's id and text; first_k1, first_k2 are those of the document that gives the class its name.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), "text")
    sets = cut(keyed.mapInArrow(_sets, "doc_id long, k1 long, k2 long, s1 long, s2 long, n long, signature binary"), "sets")
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    reps = cut(sets.filter("n > 0").groupBy("s1", "s2").agg(F.count("*").alias("mult"), F.min(name).alias("name"), F.first("n").alias("n"), F.first("signature").alias("signature"))
               .withColumn("rid", F.monotonically_increasing_id()), "reps")
    tokens = reps.select("rid", "signature")

    counted, depth = [], 1
    paths = tokens.mapInArrow(_grow(n_runs(recall), similarity), "path long, rid long")
    while True:
        paths = paths.distinct() if depth > 1 else paths
        # the pivot comes with the count: members of large buckets are joined with their bucket once
        sizes = paths.groupBy("path").agg(F.count("*").alias("count"), F.min("rid").alias("pivot")).filter("count > 1")
        found = cut(paths.join(sizes, "path"), "buckets")
        large = found.filter(F.col("count") > SPLIT)
        if depth == DEPTH or large.isEmpty():
            counted.append(found)
            break
        counted.append(found.filter(F.col("count") <= SPLIT))
        paths = large.select("path", "rid").join(tokens, "rid").select("path", "rid", "signature").mapInArrow(_grow(0, similarity), "path long, rid long")
        depth += 1
    buckets = _union(counted)
    # most buckets have the same few members in run after run
    small = buckets.filter(F.col("count") <= BLOCK).groupBy("path").agg(F.sort_array(F.collect_list("rid")).alias("members"))
    small = small.select("members", F.xxhash64("members").alias("path")).groupBy("path").agg(F.first("members").alias("members"))
    small = small.select("path", F.explode("members").alias("rid")).join(tokens, "rid")
    one = F.struct(F.lit(0).alias("label"), F.lit(0).alias("block"))
    small = small.select("path", one.alias("i"), one.alias("j"), F.col("rid").alias("root"), "rid", "signature")
    small = small.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j")
    near = small.mapInArrow(_agree(similarity), "a long, b long")
    large = buckets.filter(F.col("count") > BLOCK)
    if not large.isEmpty():
        labelled, edges = _pivoted(large, tokens, similarity)
        near = near.unionByName(edges.select(F.col("pivot").alias("a"), F.col("rid").alias("b"))).unionByName(
            _labelled_tiles(cut(labelled, "labelled"), tokens).mapInArrow(_agree(similarity), "a long, b long"))
    clusters = components(near).withColumnRenamed("id", "rid")

    members = cut(clusters.join(reps.select("rid", "name", "mult"), "rid"), "clusters")
    members = spread_join(members, members.groupBy("root").agg(F.count("*").alias("count")), ["root"])
    members = members.select("root", "rid", "mult", "count", F.col("name.k1").alias("k1"), F.col("name.k2").alias("k2"))
    shingles = keyed.select("k1", "k2", "text").join(members, ["k1", "k2"]).select("root", "rid", "mult", "count", "text")
    shingles = shingles.mapInArrow(_texts, "root long, rid long, mult long, count long, shingles binary")
    links = cut(_tiles(shingles, "root", "rid", F.col("count"), "mult", "shingles").mapInArrow(_links(similarity), "a long, b long, links long"), "links")

    number = links.groupBy(F.col("a").alias("rid")).agg(F.sum("links").alias("links"))
    classes = components(links.select("a", "b")).withColumnRenamed("id", "rid")
    named = reps.select("rid", "s1", "s2", "mult", "name").join(classes, "rid", "left").join(number, "rid", "left")
    named = named.withColumn("root", F.coalesce("root", "rid"))
    named = cut(named, "named")
    first = named.groupBy("root").agg(F.count("*").alias("count"), F.min("name").alias("first"))
    named = spread_join(named, first, ["root"]).select(
        "s1", "s2", F.col("mult").alias("count"), "first", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    own = F.col("first").isNull()
    found = sets.select("doc_id", "k1", "k2", "s1", "s2", "n")
    blank = found.filter("n = 0").select("doc_id", "k1", "k2", F.lit(None).cast(first.schema["first"].dataType).alias("first"), F.lit(0).cast("long").alias("n_links"))
    found = spread_join(found.filter("n > 0"), cut(named, "named"), ["s1", "s2"]).select("doc_id", "k1", "k2", "first", "n_links").unionByName(blank)
    return found.select(
        "doc_id", "k1", "k2", F.when(own, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.when(own, F.col("k1")).otherwise(F.col("first.k1")).alias("first_k1"), F.when(own, F.col("k2")).otherwise(F.col("first.k2")).alias("first_k2"),
        F.when(own, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"))


def keep_first(docs: DataFrame, similarity: Fraction = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """``docs`` with one document of each class: the one that names it, once if its row is repeated.  Blank texts all stay."""
    classes = similarity_classes(docs, similarity, recall)
    kept = classes.filter((F.col("k1") == F.col("first_k1")) & (F.col("k2") == F.col("first_k2"))).select(
        F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    k1, k2 = row_key()
    rows = docs.withColumns({"_k1": k1, "_k2": k2}).join(kept, ["_k1", "_k2"])
    again = Window.partitionBy("_k1", "_k2").orderBy("_k1")
    blank = F.length(F.translate(F.coalesce("text", F.lit("")), " \t\n\x0b\x0c\r", "")) == 0
    return rows.withColumn("_again", F.row_number().over(again)).filter(blank | (F.col("_again") == 1)).select(docs.columns)
