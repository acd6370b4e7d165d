"""Projections and filters over the first-generation stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocab
from ..functions import bound, is_day, like_prefix, payload_of, since, span, ts_diff


def stream_activities(stream: DataFrame) -> DataFrame:
    """Stream rows with the common payload fields typed."""
    p = payload_of(
        stream.where(like_prefix("activity", vocab.STREAM_PREFIX) | like_prefix("activity", vocab.LEGACY_PREFIX)),
        "tool_name", "command", "parameters", "result_type", "error_message", "duration_ms", "tokens_used",
        "confidence_score", "project_path", "git_branch", "file_path",
    )
    return p.df.select(
        "activity_id", "ts", "activity",
        F.col("customer").alias("session_id"),
        F.col("anonymous_customer_id").alias("host_id"),
        *[p.text(n).alias(n) for n in ("tool_name", "command", "parameters", "result_type", "error_message")],
        p.whole("duration_ms").alias("duration_ms"),
        p.whole("tokens_used").alias("tokens_used"),
        p.real("confidence_score").alias("confidence_score"),
        *[p.text(n).alias(n) for n in ("project_path", "git_branch", "file_path")],
        "feature_json", "revenue_impact", "link",
    )


def recent_activities(stream: DataFrame, as_of=None, ordered: bool = True) -> DataFrame:
    """Rows of the 24 hours before ``as_of`` with their age, newest first unless ``ordered=False``."""
    now = bound(as_of)
    out = (
        since(stream, now - span(hours=24), to=now)
        .select(
            "activity_id", "ts", "activity", "customer", "anonymous_customer_id", "feature_json", "revenue_impact",
            "link",
            ts_diff("second", F.col("ts"), now).alias("seconds_ago"),
            ts_diff("minute", F.col("ts"), now).alias("minutes_ago"),
        )
    )
    return out.orderBy(F.desc("ts")) if ordered else out


def todays_activities(stream: DataFrame, as_of=None, ordered: bool = True) -> DataFrame:
    out = is_day(stream, as_of)
    return out.orderBy(F.desc("ts")) if ordered else out


def activity_log(stream: DataFrame, as_of=None, n: int = 100) -> DataFrame:
    """Newest ``n`` rows since 24 hours before midnight of ``as_of``, with one detail text."""
    midnight = F.to_date(bound(as_of)).cast("timestamp_ntz")
    newest = (
        since(stream, midnight - span(hours=24), to=bound(as_of))
        .orderBy(F.desc("ts"), F.asc("activity_id"))
        .limit(n)
    )
    p = payload_of(newest, "prompt", "tool_name", "file_path")
    activity = F.col("activity")
    return p.df.select(
        F.col("ts").alias("time"), "activity", F.col("customer").alias("session_id"),
        F.col("anonymous_customer_id").alias("user"),
        F.when(activity == vocab.META_QUERY, p.text("prompt"))
        .when(activity == vocab.TOOL_CALL, p.text("tool_name"))
        .when(activity == vocab.FILE_OPERATION, p.text("file_path")).alias("details"),
    )


def meta_queries(stream: DataFrame, as_of=None, *, recent: bool = False, containing: str | None = None,
                 preview: int | None = 100, ordered: bool = True) -> DataFrame:
    """Question-to-SQL events.

    ``recent`` keeps the 24 hours before ``as_of``; ``containing`` keeps prompts
    with that word; ``preview`` cuts the shown SQL (None shows all of it).  Newest first unless ``ordered=False``.
    """
    rows = stream.where(F.col("activity") == vocab.META_QUERY)
    if recent:
        rows = since(rows, bound(as_of) - span(hours=24), strict=True, to=bound(as_of))
    p = payload_of(rows, "prompt", "query_generated", once=containing is not None)
    sql: Column = p.text("query_generated")
    out = p.df.select(
        "ts", F.col("customer").alias("session_id"), p.text("prompt").alias("question"),
        (sql if preview is None else F.left(sql, F.lit(preview))).alias("sql_text"),
    )
    if containing is not None:
        out = out.where(F.col("question").contains(containing))
    return out.orderBy(F.desc("ts")) if ordered else out


def successful_payloads(stream: DataFrame, as_of=None, n: int = 10) -> DataFrame:
    """Distinct payloads of the newest ``n`` successful SQL executions of 7 days."""
    rows = since(stream.where(F.col("activity") == vocab.SQL_EXECUTION), bound(as_of) - span(days=7), strict=True, to=bound(as_of))
    p = payload_of(rows, "success")
    return (
        p.df.where(p.flag("success"))
        .orderBy(F.desc("ts"), F.asc("activity_id"))
        .limit(n)
        .select("feature_json")
        .distinct()
    )
