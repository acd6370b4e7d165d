"""Evolution, patterns, cost, usage and file measures by day or tool."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import vocab
from ..functions import day_of, like_prefix, n_distinct, payload_of, steady_round


def system_evolution(stream: DataFrame, approx: bool = False) -> DataFrame:
    """Vocabulary growth by day."""
    rows = stream.where(like_prefix("activity", vocab.STREAM_PREFIX) | like_prefix("activity", vocab.LEGACY_PREFIX))
    kinds = F.col("unique_activity_types")
    return (
        rows.groupBy(day_of().alias("day"))
        .agg(
            F.array_sort(F.collect_set("activity")).alias("_names"),
            F.count("*").alias("total_events"),
            n_distinct("customer", approx).alias("unique_sessions"),
            n_distinct("anonymous_customer_id", approx).alias("unique_users"),
        )
        .select(
            "day", F.size("_names").cast("bigint").alias("unique_activity_types"), "total_events", "unique_sessions",
            "unique_users", F.array_join("_names", ", ").alias("activities_logged"),
        )
        .withColumn(
            "maturity_level",
            F.when(kinds <= 2, "phase1").when(kinds <= 4, "phase2").when(kinds <= 6, "phase3").otherwise("phase4"),
        )
    )


def pattern_discovery(stream: DataFrame, n: int = 20, approx: bool = False) -> DataFrame:
    """Busiest ``n`` (hour of day, weekday) cells."""
    hour = F.col("hour_of_day")
    return (
        stream.where(like_prefix("activity", vocab.STREAM_PREFIX))
        .groupBy(F.hour("ts").cast("bigint").alias("hour_of_day"), F.date_format("ts", "E").alias("day_of_week"))
        .agg(F.count("*").alias("activity_count"), n_distinct("customer", approx).alias("session_count"))
        .orderBy(F.desc("activity_count"), F.asc("hour_of_day"), F.asc("day_of_week"))
        .limit(n)
        .withColumn(
            "time_pattern",
            F.when(hour.between(9, 17), "business").when(hour.between(18, 23), "evening")
            .when(hour.between(0, 8), "early").otherwise("unusual"),
        )
    )


def cost_by_day(stream: DataFrame) -> DataFrame:
    p = payload_of(stream.where(like_prefix("activity", vocab.STREAM_PREFIX)), "tokens_used", "session_duration_ms")
    cost = F.col("calculated_cost")
    return (
        p.df.select(day_of().alias("day"), "revenue_impact", p.whole("tokens_used").alias("tokens"),
                    p.whole("session_duration_ms").alias("ms"))
        .groupBy("day")
        .agg(
            F.count("*").alias("activities"), F.sum("revenue_impact").alias("calculated_cost"),
            F.sum("tokens").alias("reported_tokens"), (F.sum("ms") / 1000).alias("total_seconds"),
        )
        .select(
            "*",
            steady_round(cost * 1_000_000, 2).alias("cost_in_microdollars"),
            F.when(cost == 0, "none").when(cost < 0.01, "efficient").when(cost < 0.10, "normal").otherwise("heavy")
            .alias("cost_assessment"),
        )
    )


def usage_by_day(stream: DataFrame, approx: bool = False) -> DataFrame:
    """Sessions, tokens, written lines, tools and cost by day and machine."""
    kinds = (vocab.SESSION_START, vocab.SESSION_END, vocab.FILE_OPERATION, vocab.TOOL_CALL)
    p = payload_of(stream.where(F.col("activity").isin(*kinds)), "total_tokens", "operation", "lines_affected")
    activity = F.col("activity")
    wrote = (activity == vocab.FILE_OPERATION) & p.text("operation").isin(*vocab.WRITE_OPERATIONS)
    rows = p.df.select(
        day_of().alias("date"), F.col("anonymous_customer_id").alias("user_machine"),
        F.when(activity == vocab.SESSION_START, F.col("customer")).alias("session"),
        F.when(activity == vocab.SESSION_END, p.whole("total_tokens")).alias("tokens"),
        F.when(wrote, p.whole("lines_affected")).alias("lines"),
        (activity == vocab.TOOL_CALL).alias("tool"),
    )
    tokens = F.coalesce(F.sum("tokens"), F.lit(0))
    return (
        rows.groupBy("date", "user_machine")
        .agg(
            n_distinct("session", approx).alias("sessions"), tokens.alias("tokens_used"),
            F.coalesce(F.sum("lines"), F.lit(0)).alias("lines_written"), F.count_if("tool").alias("tools_used"),
        )
        .select(
            "date", "user_machine", F.split_part("user_machine", F.lit("."), F.lit(1)).alias("user"), "sessions",
            "tokens_used", "lines_written", "tools_used",
            steady_round(F.col("tokens_used") * vocab.USD_PER_SESSION_TOKEN, 4).alias("estimated_cost_usd"),
        )
    )


def usage_summary(by_day: DataFrame) -> DataFrame:
    """Totals and daily averages per user over ``usage_by_day``."""
    return by_day.groupBy("user").agg(
        F.countDistinct("date").alias("active_days"),
        F.sum("sessions").alias("total_sessions"),
        F.sum("tokens_used").alias("total_tokens"),
        F.sum("lines_written").alias("total_lines_written"),
        F.sum("tools_used").alias("total_tools_used"),
        steady_round(F.avg("tokens_used"), 0).alias("avg_tokens_per_day"),
        steady_round(F.avg("lines_written"), 0).alias("avg_lines_per_day"),
        F.sum("estimated_cost_usd").alias("total_cost_usd"),
    )


def daily_user_metrics(stream: DataFrame, approx: bool = False) -> DataFrame:
    """Sessions, tokens and written lines by day and user.

    The three measures come from disjoint events of the same stream, so one
    conditional aggregation gives what a full join of three would.
    """
    p = payload_of(
        stream.where(F.col("activity").isin(vocab.SESSION_START, vocab.SESSION_END, vocab.FILE_OPERATION)),
        "user", "total_tokens", "operation", "lines_affected", once=True,
    )
    activity = F.col("activity")
    wrote = p.text("operation").isin(*vocab.WRITE_OPERATIONS)
    rows = p.df.where((activity != vocab.FILE_OPERATION) | wrote).select(
        day_of().alias("date"), F.coalesce(p.text("user"), F.col("anonymous_customer_id")).alias("username"),
        F.when(activity == vocab.SESSION_START, F.col("customer")).alias("session"),
        F.when(activity == vocab.SESSION_END, p.whole("total_tokens")).alias("tokens"),
        F.when(activity == vocab.FILE_OPERATION, p.whole("lines_affected")).alias("lines"),
    )
    return (
        rows.groupBy("date", "username")
        .agg(
            n_distinct("session", approx).alias("sessions"),
            F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens_used"),
            F.coalesce(F.sum("lines"), F.lit(0)).alias("lines_of_code_written"),
        )
        .withColumn("estimated_cost_usd", steady_round(F.col("tokens_used") * vocab.USD_PER_SESSION_TOKEN, 4))
    )


def tool_breakdown(stream: DataFrame) -> DataFrame:
    p = payload_of(stream.where(F.col("activity") == vocab.TOOL_CALL), "tool_name", "duration_ms")
    return (
        p.df.select(p.text("tool_name").alias("tool"), p.whole("duration_ms").alias("ms"))
        .groupBy("tool")
        .agg(F.count("*").alias("usage_count"), F.avg("ms").alias("avg_duration_ms"))
    )


def files_touched(stream: DataFrame) -> DataFrame:
    p = payload_of(stream.where(F.col("activity") == vocab.FILE_OPERATION), "file_path")
    return (
        p.df.select(p.text("file_path").alias("file_path"), "ts")
        .groupBy("file_path")
        .agg(F.count("*").alias("operations_count"), F.max("ts").alias("last_modified"))
    )


def distinct_activities(stream: DataFrame, n: int | None = None) -> DataFrame:
    """Activity names in use."""
    names = stream.where(like_prefix("activity", vocab.STREAM_PREFIX)).select("activity").distinct().orderBy("activity")
    return names if n is None else names.limit(n)
