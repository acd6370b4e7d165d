"""Stream rows from logged calls: payload, cost and link of each event kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocab

# Payload fields of each kind, in order.
PAYLOADS = {
    "session_start": ("session_id", "project_path", "git_branch", "user", "host", "cli_version"),
    "tool_call": ("tool_name", "parameters", "result_type", "duration_ms", "tokens_used", "project_path", "git_branch"),
    "file_operation": ("operation", "file_path", "lines_affected", "success", "project_path"),
    "session_end": ("session_id", "total_activities", "total_tokens", "session_duration_ms", "session_outcome"),
}
SESSION_END_V2 = ("session_id", "total_activities", "total_tokens", "session_duration_ms", "exit_code")
_NAMES = {
    "session_start": vocab.SESSION_START,
    "tool_call": vocab.TOOL_CALL,
    "file_operation": vocab.FILE_OPERATION,
    "session_end": vocab.SESSION_END,
}
_TOKENS = {"tool_call": "tokens_used", "session_end": "total_tokens"}


def token_cost(tokens: Column) -> Column:
    """0.00004 USD per 1000 tokens, cut (not rounded) after six decimals."""
    return F.floor(tokens.cast("bigint") * 4 / 100).cast("double") / 1_000_000


def build_events(kind: str, calls: DataFrame) -> DataFrame:
    """Rows (activity_id, ts, customer, host, + payload columns) as stream rows."""
    fields = [f for f in PAYLOADS[kind] if f in calls.columns]
    cost = token_cost(F.col(_TOKENS[kind])) if kind in _TOKENS else F.lit(0.0)
    link = F.concat(F.lit("file://"), F.col("file_path")) if kind == "file_operation" else F.lit(None).cast("string")
    return calls.select(
        "activity_id", "ts", F.lit(_NAMES[kind]).alias("activity"), "customer",
        F.col("host").alias("anonymous_customer_id"), F.to_json(F.struct(*fields)).alias("feature_json"),
        F.coalesce(cost, F.lit(0.0)).alias("revenue_impact"), link.alias("link"),
    )


def session_end_cost(tokens: Column) -> Column:
    """Cost of a second-generation session end, to six decimals."""
    return F.round(tokens * vocab.USD_PER_SESSION_TOKEN, 6)


def build_session_ends(calls: DataFrame) -> DataFrame:
    """Second-generation session ends of ended sessions; unknown tokens cost nothing."""
    fields = [f for f in SESSION_END_V2 if f in calls.columns]
    return calls.select(
        "activity_id", "ts", F.lit("session_end").alias("activity"), "customer", F.col("host").alias("anonymous_customer_id"),
        F.to_json(F.struct(*fields)).alias("feature_json"),
        F.coalesce(session_end_cost(F.col("total_tokens")), F.lit(0.0)).alias("revenue_impact"), F.lit(None).cast("string").alias("link"),
    )
