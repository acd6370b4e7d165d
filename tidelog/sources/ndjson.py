"""NDJSON event lines: parsing, enrichment, degradation, backpressure."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .. import vocab
from ..functions import bound, opt, stable_id

LINE = T.StructType([
    T.StructField("activity_id", T.StringType()),
    T.StructField("ts", T.StringType()),
    T.StructField("activity", T.StringType()),
    T.StructField("customer", T.StringType()),
    T.StructField("anonymous_customer_id", T.StringType()),
    T.StructField("feature_json", T.StringType()),
    T.StructField("revenue_impact", T.StringType()),
    T.StructField("link", T.StringType()),
])


def parse_lines(lines: DataFrame, as_of=None, column: str = "value") -> DataFrame:
    """Stream rows of JSON lines.

    A line that is not JSON, or has no id, is skipped.  A missing payload becomes
    ``{}``, a missing time ``as_of``, a missing host 'unknown', a missing cost 0.
    Works on streaming DataFrames too.
    """
    e = F.from_json(F.col(column), LINE, {"mode": "PERMISSIVE"}).alias("e")
    rows = lines.select(e).where(F.col("e.activity_id").isNotNull())
    when = F.coalesce(F.col("e.ts").try_cast("timestamp").cast("timestamp_ntz"), bound(as_of))
    return rows.select(
        "e.activity_id", when.alias("ts"), "e.activity", "e.customer",
        F.coalesce(F.nullif("e.anonymous_customer_id", F.lit("")), F.lit("unknown")).alias("anonymous_customer_id"),
        F.coalesce("e.feature_json", F.lit("{}")).alias("feature_json"),
        F.coalesce(F.col("e.revenue_impact").try_cast("double"), F.lit(0.0)).alias("revenue_impact"),
        F.nullif("e.link", F.lit("")).alias("link"),
    )


def read_ndjson(spark: SparkSession, path: str, as_of=None) -> DataFrame:
    return parse_lines(spark.read.text(path), as_of)


def stream_ndjson(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_lines(reader.text(path))


def enrich_events(events: DataFrame, as_of=None) -> DataFrame:
    """Fills a missing id by a hash of the event, stamps queue time and version."""
    return (
        events.withColumn("activity_id", F.coalesce(opt(events, "activity_id"), stable_id(*(F.col(c) for c in events.columns if c != "activity_id"))))
        .withColumn("queued_at", bound(as_of))
        .withColumn("queue_version", F.lit(2))
    )


def degrade_events(
    events: DataFrame, backlog_age_ms: int, threshold_ms: int = vocab.BACKPRESSURE_MS,
    max_chars: int = vocab.DEGRADE_CHARS,
) -> DataFrame:
    """Flags events queued while the backlog is older than the threshold.

    Large payloads are flagged with their size; their content is kept.
    """
    late = backlog_age_ms > threshold_ms
    size = F.length("feature_json").cast("bigint")
    large = F.lit(late) & (size > max_chars)
    return (
        events.withColumn("degraded", F.lit(late))
        .withColumn("degradation_reason", F.lit("backpressure" if late else None).cast("string"))
        .withColumn("_truncated", F.coalesce(large, F.lit(False)))
        .withColumn("_original_size", F.when(large, size))
    )


def backpressure_events(
    backlog: DataFrame, threshold_ms: int = vocab.BACKPRESSURE_MS, every: dt.timedelta = dt.timedelta(hours=1)
) -> DataFrame:
    """One event whenever a host's oldest waiting file first exceeds the threshold.

    ``backlog`` has one row per check, host and waiting file.  A check without
    waiting files has no row, so a gap longer than ``every`` clears the state.
    """
    checks = backlog.groupBy("host", "checked_at").agg(
        F.count("*").alias("queue_depth"), F.min("marked_at").alias("oldest")
    ).withColumn("oldest_age_ms", F.timestamp_diff("MILLISECOND", F.col("oldest"), F.col("checked_at")))
    over = F.col("oldest_age_ms") > threshold_ms
    order = Window.partitionBy("host").orderBy("checked_at")
    before = F.lag(over).over(order) & (F.lag("checked_at").over(order) >= F.col("checked_at") - F.lit(every))
    return (
        checks.withColumn("_before", F.coalesce(before, F.lit(False)))
        .where(over & ~F.col("_before"))
        .select(
            F.lit(vocab.BACKPRESSURE).alias("activity"), F.col("checked_at").alias("ts"), "host", "queue_depth",
            "oldest_age_ms", F.lit(threshold_ms).cast("bigint").alias("threshold_ms"),
            F.lit("backpressure").alias("event_type"), F.lit("warning").alias("severity"),
        )
    )
