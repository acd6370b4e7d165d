"""Hourly product metrics, rollups and lag over the second-generation stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocab
from ..functions import bound, payload_of, pct, since, span, steady_round, trunc_ts, ts_diff

LATENCY_POINTS = {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95, "p99_latency_ms": 0.99}


def health_score(p95: Column, success_pct: Column, provenance_pct: Column) -> Column:
    """0 to 100 in four parts; NULL when a percentage is unknown."""
    total = (
        F.when(p95 <= vocab.LATENCY_SLO_MS, 25.0).otherwise(0.0)
        + F.when(success_pct >= 95, 25.0).otherwise(success_pct * 0.25)
        + F.when(provenance_pct >= 98, 25.0).otherwise(provenance_pct * 0.25)
        + 25.0
    )
    # greatest and least skip NULLs, so an unknown total is kept apart.
    return F.when(total.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), total)))


def _hourly_rows(stream: DataFrame) -> DataFrame:
    p = payload_of(stream, "latency_ms", "success", "total_tokens", "prompt_tokens", "completion_tokens")
    return p.df.select(
        trunc_ts("hour", "ts").alias("hour"), "customer", "activity", "link", "revenue_impact",
        p.whole("latency_ms").alias("latency"), p.flag("success").alias("success"),
        p.whole("total_tokens").alias("total_tokens"), p.whole("prompt_tokens").alias("prompt_tokens"),
        p.whole("completion_tokens").alias("completion_tokens"),
    )


def _measures() -> list[Column]:
    return [
        F.count("*").alias("total_activities"),
        # A set of activity names is as small as the vocabulary.
        F.size(F.collect_set("activity")).cast("bigint").alias("unique_activity_types"),
        F.count_if("success").alias("_good"),
        F.count_if(~F.col("success")).alias("_bad"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("revenue_impact").alias("total_cost_credits"),
        F.count("link").alias("_linked"),
    ]


def _shape(hours: DataFrame, keys: Sequence[str]) -> DataFrame:
    return hours.select(
        "*",
        pct(F.col("_good"), F.col("_good") + F.col("_bad"), 2).alias("success_rate_pct"),
        pct(F.col("_linked"), F.col("total_activities"), 2).alias("provenance_coverage_pct"),
    ).select(
        *keys, "total_activities", "unique_activity_types", *LATENCY_POINTS,
        F.when(F.col("p95_latency_ms") <= vocab.LATENCY_SLO_MS, "met").otherwise("missed").alias("mcp_latency_slo"),
        "success_rate_pct", "total_tokens", "prompt_tokens", "completion_tokens",
        F.round(F.col("total_tokens") / F.nullif("total_activities", F.lit(0)), 2).alias("avg_tokens_per_activity"),
        "total_cost_credits",
        steady_round(F.col("total_cost_credits") * vocab.USD_PER_CREDIT_REPORTED, 4).alias("total_cost_usd"),
        "unique_artifacts", "provenance_coverage_pct",
        health_score(F.col("p95_latency_ms"), F.col("success_rate_pct"), F.col("provenance_coverage_pct"))
        .alias("health_score"),
    )


def product_metrics(stream: DataFrame, as_of=None, days: int = 7, approx: bool = False) -> DataFrame:
    """Activity, latency, success, token, cost and provenance measures by hour and customer.

    The payload is parsed in one aggregation, combined map side, whose state per
    group is a count per distinct whole millisecond and per activity name, however
    many rows the group has.  Distinct links have no such bound: they are made
    distinct in a shuffle of their own, from columns that need no parsing, and
    joined on the same keys.  ``approx=True`` keeps sketches of fixed size instead
    and needs one shuffle.
    """
    recent = since(stream, bound(as_of) - span(days=days), strict=True, to=bound(as_of))
    keys, points = ["hour", "customer"], F.array(*[F.lit(p) for p in LATENCY_POINTS.values()])
    rows = _hourly_rows(recent)
    if approx:
        hours = rows.groupBy(*keys).agg(
            *_measures(), F.approx_count_distinct("link").alias("unique_artifacts"),
            F.percentile_approx("latency", points, 10_000).alias("_p"),
        )
    else:
        links = (
            recent.where(F.col("link").isNotNull())
            .select(trunc_ts("hour", "ts").alias("hour"), "customer", "link").distinct()
            .groupBy(*keys).agg(F.count("*").alias("unique_artifacts"))
        )
        hours = (
            rows.groupBy(*keys).agg(*_measures(), F.percentile("latency", points).alias("_p"))
            .join(links, keys, "left").fillna(0, ["unique_artifacts"])
        )
    named = [F.col("_p")[i].cast("double").alias(n) for i, n in enumerate(LATENCY_POINTS)]
    return _shape(hours.select("*", *named), keys)


def customer_health(metrics: DataFrame, customer: str, as_of=None) -> DataFrame:
    """Recent hours of one customer from ``product_metrics``."""
    return metrics.where(
        (F.col("customer") == customer) & F.col("hour").between(bound(as_of) - span(hours=1), bound(as_of))
    ).select("customer", "total_activities", "p50_latency_ms", "p95_latency_ms", "success_rate_pct", "health_score")


def _insight(df: DataFrame, subject: str, metric: str, value: Column, grain: str, confidence: float) -> DataFrame:
    return df.select(
        "customer", F.lit(subject).alias("subject"), F.lit(metric).alias("metric"), value.alias("value"),
        F.lit(grain).alias("grain"), F.lit(confidence).alias("confidence"),
        F.lit("aggregate_calculation").alias("derivation_method"),
    )


def hourly_latency_p95(stream: DataFrame, as_of=None, activity: str = "mcp_call") -> DataFrame:
    """Insight rows: latency p95 of the last hour per customer."""
    rows = since(stream.where(F.col("activity") == activity), bound(as_of) - span(hours=1), strict=True, to=bound(as_of))
    p = payload_of(rows, "latency_ms")
    found = (
        p.df.groupBy("customer").agg(F.percentile(p.whole("latency_ms"), F.lit(0.95)).alias("p95"))
        .where(F.col("p95").isNotNull())
    )
    return _insight(found, "system_performance", "hourly_latency_p95", F.col("p95"), "hourly", 1.0)


def success_rate(
    stream: DataFrame, as_of=None, activities: Sequence[str] = ("query_complete", "query_error"), more_than: int = 10
) -> DataFrame:
    """Insight rows: query success of the last day for customers with enough queries."""
    rows = since(stream.where(F.col("activity").isin(*activities)), bound(as_of) - span(days=1), strict=True, to=bound(as_of))
    p = payload_of(rows, "success")
    found = (
        p.df.groupBy("customer")
        .agg(F.count("*").alias("n"), F.count_if(p.flag("success")).alias("good"))
        .where(F.col("n") > more_than)
    )
    return _insight(found, "query_performance", "success_rate", F.col("good") * 100.0 / F.col("n"), "daily", 0.95)


def _lag(changes: DataFrame, name: str, as_of) -> DataFrame:
    now = bound(as_of)
    return changes.agg(
        F.count("*").alias("pending_records"), F.min("ts").alias("oldest_record"), F.max("ts").alias("newest_record")
    ).select(
        F.lit(name).alias("stream_name"), "*",
        ts_diff("second", F.col("oldest_record"), now).alias("max_lag_seconds"),
        ts_diff("millisecond", F.col("newest_record"), now).alias("min_lag_ms"),
    )


def stream_lag(changes: DataFrame, insight_changes: DataFrame, as_of=None) -> DataFrame:
    """Waiting rows of the two change feeds and their age."""
    return _lag(changes, "stream_changes", as_of).unionByName(_lag(insight_changes, "insight_changes", as_of))


def pending_lag(stream: DataFrame, processed_ts, as_of=None, name: str = "stream_changes") -> DataFrame:
    """Lag of the rows newer than the newest processed instant."""
    return _lag(since(stream, bound(processed_ts), strict=True), name, as_of)


def stream_window_summary(stream: DataFrame, customer: str, as_of=None, minutes: int = 5) -> DataFrame:
    rows = since(stream.where(F.col("customer") == customer), bound(as_of) - span(minutes=minutes), strict=True, to=bound(as_of))
    return rows.agg(
        F.count("*").alias("total_events"), F.countDistinct("activity").alias("activity_types"),
        F.min("ts").alias("first_event"), F.max("ts").alias("last_event"), F.sum("revenue_impact").alias("total_cost"),
    )


def run_health(job_runs: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """State and duration of the job runs scheduled in the last ``hours``."""
    state = F.col("state")
    return since(job_runs, bound(as_of) - span(hours=hours), ts="scheduled_time", to=bound(as_of)).select(
        "job_name", "state", "scheduled_time", "completed_time",
        ts_diff("second", F.col("scheduled_time"), F.col("completed_time")).alias("duration_seconds"),
        "error_message",
        F.when(state == "SUCCEEDED", "healthy").when(state == "FAILED", "critical").when(state == "SKIPPED", "warning")
        .otherwise("unknown").alias("health_status"),
    )


def run_rollups(stream: DataFrame, as_of=None) -> DataFrame:
    """The scheduled insight rollups of one run, as insight rows."""
    return hourly_latency_p95(stream, as_of).unionByName(success_rate(stream, as_of))
