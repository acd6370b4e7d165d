"""Ordered computations that never put one whole key into one task.

A key is cut into time buckets.  The per-row work is a window inside one bucket;
what comes before (or after) the bucket is a prefix over per-bucket totals, a
table with at most one row per key and bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def running_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, out: str
) -> DataFrame:
    """1-based position of each row in its key by (bucket, *order).

    ``bucket`` must not decrease along ``order``.  A NULL key is a key, and rows of a
    NULL bucket come first, as NULL does in an order.
    """
    rows = df.withColumn("_b", bucket)
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, "_b")
        .agg(F.count("*").alias("_n"))
        .select(*keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*keys, "_b").orderBy(*order)
    offsets = offsets.withColumnsRenamed({k: f"_k_{k}" for k in (*keys, "_b")})
    same = F.lit(True)
    for key in (*keys, "_b"):
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    return (
        rows.withColumn(out, F.row_number().over(inside))
        .join(offsets, same)
        .withColumn(out, F.col(out) + F.col("_before"))
        .drop("_b", "_before", *(f"_k_{k}" for k in (*keys, "_b")))
    )


def running_peers(df: DataFrame, keys: Sequence[str], ts: str, unit: str, count: str, following: str) -> DataFrame:
    """Per row: rows of its key up to and including its ``ts`` (peers count), and
    the smallest strictly later ``ts`` of its key.

    Rows with a NULL key get 0 and NULL.
    """
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    rows = df.withColumn("_b", F.date_trunc(unit, ts))
    edge = Window.partitionBy(*keys).orderBy("_b")
    buckets = (
        rows.where(known)
        .groupBy(*keys, "_b")
        .agg(F.count("*").alias("_n"), F.min(ts).alias("_first"))
        .select(
            *keys, "_b",
            F.coalesce(F.sum("_n").over(edge.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.lead("_first").over(edge).alias("_bucket_next"),
        )
    )
    # rows without a key have a fixed result and stay out of the window, where all would meet in one task
    rows, rest = rows.where(known), df.where(~known)
    inside = Window.partitionBy(*keys, "_b").orderBy(ts)
    upto = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    peers = inside.rangeBetween(Window.currentRow, Window.currentRow)
    # The next row's time, or for ties that of the row after them: frames that only
    # grow or slide, so a bucket takes time linear in its rows.
    coming = F.lead(ts).over(inside)
    return (
        rows.withColumn("_upto", F.count("*").over(upto))
        .withColumn("_coming", coming)
        .withColumn("_later", F.max(F.when(F.col("_coming") > F.col(ts), F.col("_coming"))).over(peers))
        .join(buckets, [*keys, "_b"], "left")
        .withColumn(count, F.coalesce(F.col("_before") + F.col("_upto"), F.lit(0)))
        .withColumn(following, F.coalesce("_later", "_bucket_next"))
        .drop("_b", "_upto", "_coming", "_later", "_before", "_bucket_next")
        .unionByName(rest.withColumn(count, F.lit(0).cast("long")).withColumn(following, F.lit(None).cast(df.schema[ts].dataType)))
    )
