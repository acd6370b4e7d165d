"""Connected components by contraction: every round each vertex points to its least neighbour, and edges between the same ends merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of the vertices of (a, b) longs; edges of a vertex with itself and repeated ones do no harm.

    A round leaves at most half of the vertices that still have edges, so rounds grow with the logarithm of a component.
    """
    edges = cut(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.min("b").alias("r")).select("a", F.least("a", "r").alias("r")), "least")
        rounds.append(least)
        for end in ("a", "b"):
            to = least.select(F.col("a").alias(end), F.col("r").alias(f"r{end}"))
            edges = edges.join(to, end)
        edges = edges.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).filter("a != b").distinct()
        edges = cut(edges, "edges")
    if not rounds:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    out = rounds[0].select(F.col("a").alias("id"), F.col("r").alias("root"))
    for least in rounds[1:]:
        out = out.join(least, F.col("root") == F.col("a"), "left").select("id", F.coalesce("r", "root").alias("root"))
    return out
