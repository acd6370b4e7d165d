"""Typed views of the second-generation stream, one per event family."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import vocab
from ..functions import opt, payload_of
from ..plans.intervals import left_interval_join

_HISTORY_COLUMNS = {
    "query_text": ("actual_query_text", "string"),
    "database_name": ("actual_database", "string"),
    "schema_name": ("actual_schema", "string"),
    "warehouse_name": ("actual_warehouse", "string"),
    "warehouse_size": ("warehouse_size", "string"),
    "warehouse_type": ("warehouse_type", "string"),
    "bytes_scanned": ("history_bytes_scanned", "bigint"),
    "bytes_written": ("bytes_written", "bigint"),
    "rows_produced": ("history_rows_produced", "bigint"),
    "rows_inserted": ("rows_inserted", "bigint"),
    "rows_updated": ("rows_updated", "bigint"),
    "rows_deleted": ("rows_deleted", "bigint"),
    "credits_used_cloud_services": ("history_credits", "double"),
    "execution_time": ("history_execution_time_ms", "bigint"),
    "compilation_time": ("compilation_time", "bigint"),
    "queued_provisioning_time": ("queued_provisioning_time", "bigint"),
    "queued_repair_time": ("queued_repair_time", "bigint"),
    "queued_overload_time": ("queued_overload_time", "bigint"),
    "list_external_files_time": ("list_external_files_time", "bigint"),
    "error_code": ("history_error_code", "string"),
    "error_message": ("history_error_message", "string"),
}
_CORE = ("activity_id", "ts", "customer", "anonymous_customer_id")


def _family(stream: DataFrame, activities: Sequence[str], *fields: str):
    return payload_of(stream.where(F.col("activity").isin(*activities)), *fields)


def sql_events(
    stream: DataFrame, history: DataFrame, activities: Sequence[str] = vocab.SQL_ACTIVITIES,
    margin: dt.timedelta = dt.timedelta(minutes=5),
) -> DataFrame:
    """Query events, each with every history row of its tag within ``margin``."""
    p = _family(
        stream, activities, "query_id", "sql", "warehouse", "role", "database", "schema", "rows", "bytes_scanned",
        "duration_ms", "credits_used", "success", "error", "error_code",
    )
    events = p.df.select(
        *_CORE,
        p.text("query_id").alias("query_id"),
        p.text("sql").alias("sql_text"),
        p.text("warehouse").alias("warehouse"),
        p.text("role").alias("role"),
        p.text("database").alias("database"),
        p.text("schema").alias("schema"),
        p.whole("rows").alias("rows_returned"),
        p.whole("bytes_scanned").alias("bytes_scanned"),
        p.whole("duration_ms").alias("duration_ms"),
        p.real("credits_used").alias("credits_used"),
        p.flag("success").alias("success"),
        p.text("error").alias("error_message"),
        p.text("error_code").alias("error_code"),
        F.col("link").alias("artifact_id"),
        "revenue_impact",
        F.concat(F.lit(vocab.QUERY_TAG_PREFIX), p.text("query_id")).alias("_tag"),
    )
    runs = history.select(
        F.col("query_tag").alias("_query_tag"), F.col("start_time").alias("_start"),
        F.col("query_id").alias("history_query_id"),
        *[opt(history, name, kind).alias(out) for name, (out, kind) in _HISTORY_COLUMNS.items()],
    )
    joined = left_interval_join(
        events, runs, left_key="_tag", left_ts="ts", right_key="_query_tag", right_ts="_start", margin=margin
    )
    status = (
        F.when(F.col("success"), "success")
        .when(F.col("history_error_code").isNotNull(), "failed")
        .when(F.col("artifact_id").isNotNull(), "completed")
        .otherwise("unknown")
    )
    cost = F.coalesce("revenue_impact", F.col("history_credits") * vocab.USD_PER_CREDIT)
    return (
        joined.withColumn("total_cost_usd", cost)
        .withColumn("status", status)
        .drop("_tag", "_query_tag", "_start", "revenue_impact")
    )


def llm_events(stream: DataFrame, activities: Sequence[str] = vocab.LLM_ACTIVITIES) -> DataFrame:
    """Model calls with cost (reported, booked, or by price list) and latency class."""
    p = _family(
        stream, activities, "model", "prompt_hash", "prompt_tokens", "completion_tokens", "total_tokens",
        "latency_ms", "total_latency_ms", "cost_usd", "temperature", "max_tokens", "stream",
    )
    typed = p.df.select(
        *_CORE,
        p.text("model").alias("model"),
        p.text("prompt_hash").alias("prompt_hash"),
        p.whole("prompt_tokens").alias("prompt_tokens"),
        p.whole("completion_tokens").alias("completion_tokens"),
        p.whole("total_tokens").alias("total_tokens"),
        p.whole("latency_ms").alias("time_to_first_token_ms"),
        p.whole("total_latency_ms").alias("total_latency_ms"),
        p.real("cost_usd").alias("cost_usd"),
        p.real("temperature").alias("temperature"),
        p.whole("max_tokens").alias("max_tokens"),
        p.flag("stream").alias("is_streamed"),
        F.col("link").alias("artifact_id"),
        "revenue_impact",
    )
    listed = None
    for fragment, (prompt, completion) in vocab.MODEL_PRICES.items():
        price = (F.col("prompt_tokens") * prompt + F.col("completion_tokens") * completion) / 1000
        hit = F.col("model").contains(fragment)
        listed = F.when(hit, price) if listed is None else listed.when(hit, price)
    first = F.col("time_to_first_token_ms")
    return typed.select(
        *[c for c in typed.columns if c != "revenue_impact"],
        F.coalesce("cost_usd", "revenue_impact", listed.otherwise(0.0)).alias("estimated_cost_usd"),
        F.when(first < 300, "fast").when(first < 1000, "normal").otherwise("slow").alias("latency_category"),
    )


def tool_events(stream: DataFrame, activities: Sequence[str] = vocab.TOOL_ACTIVITIES) -> DataFrame:
    p = _family(
        stream, activities, "tool_name", "tool_category", "parameters", "success", "latency_ms", "error",
        "result_size", "result_type",
    )
    took = F.col("latency_ms")
    return p.df.select(
        *_CORE,
        p.text("tool_name").alias("tool_name"),
        p.text("tool_category").alias("tool_category"),
        p.text("parameters").alias("parameters"),
        p.flag("success").alias("success"),
        p.whole("latency_ms").alias("latency_ms"),
        p.text("error").alias("error_message"),
        p.whole("result_size").alias("result_size_bytes"),
        p.text("result_type").alias("result_type"),
        F.coalesce(p.text("tool_name"), opt(stream, "feature_1")).alias("tool_name_normalized"),
    ).select(
        "*",
        F.when(took < 25, "excellent").when(took < 100, "good").when(took < 500, "acceptable").otherwise("poor")
        .alias("performance_tier"),
        F.when(F.col("success"), 1).otherwise(0).cast("bigint").alias("success_flag"),
    )


def file_events(stream: DataFrame, activities: Sequence[str] = vocab.FILE_ACTIVITIES) -> DataFrame:
    p = _family(
        stream, activities, "operation", "file_path", "file_type", "lines_affected", "bytes_before", "bytes_after",
        "success", "git_tracked", "git_branch",
    )
    op = F.col("operation")
    return p.df.select(
        *_CORE,
        p.text("operation").alias("operation"),
        p.text("file_path").alias("file_path"),
        p.text("file_type").alias("file_type"),
        p.whole("lines_affected").alias("lines_affected"),
        p.whole("bytes_before").alias("bytes_before"),
        p.whole("bytes_after").alias("bytes_after"),
        p.flag("success").alias("success"),
        p.flag("git_tracked").alias("git_tracked"),
        p.text("git_branch").alias("git_branch"),
        F.coalesce("link", F.concat(F.lit("file://"), p.text("file_path"))).alias("file_link"),
    ).select(
        "*",
        (F.col("bytes_after") - F.col("bytes_before")).alias("bytes_changed"),
        F.when(op.isin("create", "write"), "write").when(op == "read", "read").when(op == "edit", "modify")
        .when(op.isin("delete", "rename"), "delete").otherwise("other").alias("operation_category"),
    )


def session_events(stream: DataFrame, activities: Sequence[str] = vocab.SESSION_ACTIVITIES) -> DataFrame:
    p = _family(
        stream, activities, "event_type", "project_path", "user", "host", "cli_version", "total_activities",
        "total_tokens", "session_duration_ms",
    )
    activity = F.col("activity")
    return p.df.select(
        "activity_id", "ts", F.col("customer").alias("session_id"), "anonymous_customer_id",
        p.text("event_type").alias("event_type"),
        p.text("project_path").alias("project_path"),
        p.text("user").alias("user"),
        p.text("host").alias("host"),
        p.text("cli_version").alias("cli_version"),
        p.whole("total_activities").alias("total_activities"),
        p.whole("total_tokens").alias("total_tokens"),
        p.whole("session_duration_ms").alias("session_duration_ms"),
        F.when(activity == vocab.SESSION_START, "started").when(activity == vocab.SESSION_END, "completed")
        .when(activity == vocab.HYDRATION, "hydrating").otherwise("active").alias("session_status"),
        F.coalesce("revenue_impact", p.whole("total_tokens") * vocab.USD_PER_SESSION_TOKEN)
        .alias("session_cost_usd"),
    )


def mcp_events(
    stream: DataFrame, activities: Sequence[str] = vocab.MCP_ACTIVITIES, slo_ms: int = vocab.LATENCY_SLO_MS,
    fresh_ms: int = 30_000,
) -> DataFrame:
    p = _family(stream, activities, "method", "cache_hit", "cache_age_ms", "latency_ms", "stale", "context_size")
    hit, stale = F.col("cache_hit"), F.col("is_stale_while_revalidate")
    return p.df.select(
        *_CORE,
        p.text("method").alias("method"),
        p.flag("cache_hit").alias("cache_hit"),
        p.whole("cache_age_ms").alias("cache_age_ms"),
        p.whole("latency_ms").alias("latency_ms"),
        p.flag("stale").alias("is_stale_while_revalidate"),
        p.whole("context_size").alias("context_size_bytes"),
    ).select(
        "*",
        F.when(F.col("latency_ms") <= slo_ms, "within_slo").otherwise("slo_breach").alias("latency_slo_status"),
        F.when(hit & (F.col("cache_age_ms") < fresh_ms), "fresh_hit").when(hit & stale, "stale_hit")
        .when(hit, "hit").otherwise("miss").alias("cache_status"),
    )


def system_events(stream: DataFrame, activities: Sequence[str] = vocab.SYSTEM_ACTIVITIES) -> DataFrame:
    p = _family(stream, activities, "event_type", "severity", "message", "metrics", "action_taken")
    kind, severity = F.col("event_type"), F.col("severity")
    return p.df.select(
        "activity_id", "ts", "customer",
        p.text("event_type").alias("event_type"),
        p.text("severity").alias("severity"),
        p.text("message").alias("message"),
        p.text("metrics").alias("metrics"),
        p.text("action_taken").alias("action_taken"),
    ).select(
        "*",
        F.when(severity == "critical", "unhealthy").when(severity == "error", "degraded")
        .when(severity == "warning", "warning").otherwise("healthy").alias("system_health"),
        F.when((kind == "backpressure") & severity.isin("error", "critical"), 1)
        .when(kind == "schema_drift", 2).when(severity == "critical", 1).when(severity == "error", 2)
        .when(severity == "warning", 3).otherwise(4).cast("bigint").alias("alert_priority"),
    )
