"""Nearest neighbours by cosine: a block matrix join over int8 tiles with error bounds, then exact scores for what survives.

Vectors are scaled to length 1 and quantised: v = scale * q + e with q in int8 and a known length of e.  A tile
multiplies a block of queries with a block of candidates (the products are whole numbers below 2 ** 24 for up to a thousand
dimensions and summed in pieces beyond, so they are exact), and
|cosine - scales * product| <= |e_query| * |scale * q_candidate| + |e_candidate|.
A candidate survives if its upper bound reaches the k-th largest lower bound of the tile.  Survivors are scored in double
precision on the original vectors, and per query a heap of k merges tiles.  The search is exact.

Blocks are dealt by a hash of id and vector into a grid; queries travel to every column and candidates to every row, so that a tile
holds about ``QUERIES`` x ``CANDIDATES`` vectors whatever the table's size, and no two vectors meet in two tiles.

Vectors that are null, zero, or hold null or non-finite components, and rows without id, take no part.  Rows equal in id
and vector are one; an id with several vectors is a candidate, and asks, with each of them, and is no candidate for itself.
Vectors are compared with those of their own dimension.  Equal scores go to the
smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES, CANDIDATES, PIECE = 512, 8192, 1024


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat if isinstance(flat, pa.Array) else flat.chunk(0)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values, scales, lengths of the quantised vectors, lengths of the errors)."""
    scale = np.abs(unit).max(1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    slack = 1e-12  # rounding of the lengths themselves
    return q, scale, np.sqrt((back ** 2).sum(1)) + slack, np.sqrt(((unit - back) ** 2).sum(1)) + slack


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact product of int8 matrices, by float32 multiplications that stay exact."""
    out = np.zeros((len(a), len(b)))
    for low in range(0, a.shape[1], PIECE):
        out += a[:, low:low + PIECE].astype(np.float32) @ b[:, low:low + PIECE].astype(np.float32).T
    return out


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of rows, summed from the first component to the last: equal rows give equal numbers wherever they stand."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def _tile(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            q_id, c_id = (t["vec_id"].to_numpy() for t in (left, right))
            q, c = _matrix(left["embedding"]), _matrix(right["embedding"])
            q_length, c_length = (np.sqrt(_dot(m, m)) for m in (q, c))
            q8, q_scale, _, q_error = quantise(q / q_length[:, None])
            c8, c_scale, c_size, c_error = quantise(c / c_length[:, None])
            for low in range(0, len(q), 64):
                some = slice(low, low + 64)
                about = product(q8[some], c8) * q_scale[some, None] * c_scale
                bound = q_error[some, None] * c_size + c_error
                about[q_id[some, None] == c_id] = -np.inf
                lower = about - bound
                least = np.partition(lower, -k, 1)[:, -k] if len(c) > k else np.full(len(lower), -np.inf)
                row, at = np.nonzero((about + bound >= least[:, None]) & (about > -np.inf))
                exact = _dot(q[some][row], c[at]) / (q_length[some][row] * c_length[at])
                for r in range(len(about)):
                    mine = row == r
                    best = heapq.nsmallest(k, zip(-exact[mine], c_id[at[mine]]))
                    out += ((q_id[low + r], i, -s) for s, i in best)
        columns = zip(*out) if out else ([], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    return run


def _merge(k: int):
    """Streams rows in order of query through a heap of k."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, heap = None, []

        def ranked() -> list[tuple]:
            return [(query, rank, -i, s) for rank, (s, i) in enumerate(sorted(heap, reverse=True), 1)]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.float64()))], ["query_id", "rank", "vec_id", "score"])

        for batch in it:
            out = []
            for q, i, s in zip(*(batch.column(c).to_pylist() for c in ("query_id", "vec_id", "score"))):
                if q != query:
                    out += ranked()
                    query, heap = q, []
                (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, (s, -i))
            yield batch_of(out)
        yield batch_of(ranked())

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, queries: int = QUERIES, candidates: int = CANDIDATES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` rows of largest cosine to each row for which ``is_query`` holds.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on vec_id.
    """
    value = F.col("embedding").cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(
        F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False)))
    rows = rows.distinct().withColumn("dimension", F.size("embedding"))
    asked = rows.filter(is_query)
    n, m = rows.count(), asked.count()
    down, across = max(1, -(-m // queries)), max(1, -(-n // candidates))
    part = F.xxhash64("vec_id", "embedding", F.lit(7))
    every = lambda top: F.explode(F.sequence(F.lit(0), F.lit(top - 1)))
    left = asked.withColumn("i", F.pmod(part, F.lit(down)).cast("int")).withColumn("j", every(across))
    right = rows.withColumn("j", F.pmod(part, F.lit(across)).cast("int")).withColumn("i", every(down))
    tiles = left.groupBy("dimension", "i", "j").cogroup(right.groupBy("dimension", "i", "j")).applyInArrow(_tile(k), "query_id long, vec_id long, score double")
    return tiles.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(_merge(k), "query_id long, rank int, vec_id long, score double")
