"""Hourly measures as sketches that merge: a batch writes its own, a reader puts all of an hour together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import payload_of, trunc_ts
from ..plans.upsert import complete_versions, merged_versions, retire_versions, write_version

#: Ranks of a latency are exact up to so many values of an hour and customer, and within 0.2 % of the rows beyond.
KLL_K = 1000
_KEYS = ("hour", "customer")


def hourly_sketches(rows: DataFrame) -> DataFrame:
    """One row per hour and customer, of a size that does not depend on its rows."""
    p = payload_of(rows, "latency_ms", "success", "total_tokens")
    typed = p.df.select(
        trunc_ts("hour", "ts").alias("hour"), "customer", "activity", "revenue_impact", p.whole("latency_ms").alias("latency"),
        p.flag("success").alias("success"), p.whole("total_tokens").alias("tokens"))
    return typed.groupBy(*_KEYS).agg(
        F.count("*").alias("total_activities"), F.hll_sketch_agg("activity").alias("activities"),
        F.kll_sketch_agg_bigint("latency", F.lit(KLL_K)).alias("latencies"), F.count("latency").alias("measured"),
        F.count_if("success").alias("successful_operations"), F.sum("tokens").alias("total_tokens"), F.sum("revenue_impact").alias("total_cost_credits"))


def merge_sketches(rows: DataFrame) -> DataFrame:
    """Sketches of the same hour and customer put together; all parts are sums or unions, so the order does not matter."""
    return rows.groupBy(*_KEYS).agg(
        F.sum("total_activities").alias("total_activities"), F.hll_union_agg("activities").alias("activities"),
        F.kll_merge_agg_bigint("latencies").alias("latencies"), F.sum("measured").alias("measured"),
        F.sum("successful_operations").alias("successful_operations"), F.sum("total_tokens").alias("total_tokens"),
        F.sum("total_cost_credits").alias("total_cost_credits"))


def measures(sketches: DataFrame) -> DataFrame:
    """What ``hourly_metrics`` gives, from merged sketches."""
    p95 = F.when(F.col("measured") > 0, F.kll_sketch_get_quantile_bigint("latencies", F.lit(0.95)))
    return sketches.select(
        *_KEYS, "total_activities", F.hll_sketch_estimate("activities").cast("bigint").alias("activity_types"), p95.alias("p95_latency_ms"),
        "successful_operations", "total_tokens", "total_cost_credits")


def hourly_sketch_stream(stream: DataFrame, out: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Write each batch's sketches as one version.

    A batch reads nothing but its own rows: late rows, of whatever hour, are one more part of it.  A repeated batch writes its version
    again.  Nothing is kept in a state.  ``hourly_metrics_stream`` is the exact form, which reads the table again.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_version(hourly_sketches(batch), out, batch_id + 1)

    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_hourly_sketches(spark: SparkSession, out: str) -> DataFrame:
    """Measures of every hour and customer, of all completely written versions."""
    rows = merged_versions(spark, out)
    if rows is None:
        raise ValueError(f"no complete version in {out}")
    return measures(merge_sketches(rows.drop("version")))


def compact_hourly_sketches(spark: SparkSession, out: str, retire: bool = False) -> None:
    """Merge all versions to one row per hour and customer; with ``retire`` those it replaces are removed."""
    versions = complete_versions(spark, out)
    if versions:
        last = int(versions[-1].rsplit("=", 1)[1])
        write_version(merge_sketches(merged_versions(spark, out).drop("version")), out, last, kind="base")
        if retire:
            retire_versions(spark, out)
