"""Company-level measures over the first-generation stream.

``approx=True`` replaces exact distinct counts by sketches of a few kilobytes,
which are combined map side.  Exact ones count over partial rows: raw rows are first added up by what is to be
counted (sessions, users, days and the like, of which many rows share one combination), and only these sums are copied for each distinct count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import vocab
from ..functions import bound, day_of, like_prefix, n_distinct, payload_of, pct, since, span, steady_round, trunc_ts, ts_diff
from ..plans.partial import deviation, mean, partial, total


def _of(activity: str):
    return F.count_if(F.col("activity") == activity)


def executive_summary(stream: DataFrame, as_of=None, approx: bool = False) -> DataFrame:
    """One row for the 30 days before ``as_of``."""
    today = F.to_date(bound(as_of))
    rows = since(stream.where(like_prefix("activity", vocab.STREAM_PREFIX)),
                 today.cast("timestamp_ntz") - span(days=30), to=bound(as_of))
    p = payload_of(rows, "project_path", "git_branch", "duration_ms", "tokens_used")
    typed = p.df.select(
        "customer", "anonymous_customer_id", "activity", "revenue_impact", day_of().alias("day"),
        p.text("project_path").alias("project"), p.text("git_branch").alias("branch"),
        p.whole("duration_ms").alias("ms"), p.whole("tokens_used").alias("tokens"),
    )
    rows = partial(typed, ("customer", "anonymous_customer_id", "day", "project", "branch"), {
        "n": F.count("*"), "tools": _of(vocab.TOOL_CALL), "files": _of(vocab.FILE_OPERATION), "errors": _of(vocab.ERROR),
        "cost": F.sum("revenue_impact"), "costed": F.count("revenue_impact"), "ms_sum": F.sum("ms"), "ms_n": F.count("ms"), "ms_max": F.max("ms"),
        "tokens": F.sum("tokens")})
    return rows.agg(
        n_distinct("customer", approx).alias("total_sessions"),
        n_distinct("anonymous_customer_id", approx).alias("unique_users"),
        total("n").alias("total_activities"),
        total("tools").alias("tool_executions"),
        total("files").alias("file_operations"),
        total("errors").alias("errors_encountered"),
        steady_round(F.sum("cost"), 6).alias("total_cost_usd"),
        steady_round(mean("cost", "costed"), 8).alias("avg_cost_per_activity"),
        n_distinct("day", approx).alias("days_active"),
        n_distinct("project", approx).alias("projects_touched"),
        n_distinct("branch", approx).alias("git_branches_worked"),
        steady_round(mean("ms_sum", "ms_n"), 2).alias("avg_response_time_ms"),
        F.max("ms_max").alias("max_response_time_ms"),
        F.sum("tokens").alias("total_tokens_consumed"),
    ).select(today.alias("report_date"), "*")


def user_adoption(stream: DataFrame, approx: bool = False, user_list: bool = False) -> DataFrame:
    """Daily users, sessions and growth over the previous day.

    ``user_list=True`` adds the day's users as one text cell, which is as long as the day has users; ``daily_users`` gives
    them as rows.
    """
    p = payload_of(stream.where(like_prefix("activity", vocab.STREAM_PREFIX)), "tool_name")
    typed = p.df.select(trunc_ts("day", "ts").alias("activity_date"), "anonymous_customer_id", "customer",
                        p.text("tool_name").alias("tool"))
    rows = partial(typed, ("activity_date", "anonymous_customer_id", "customer", "tool"), {"n": F.count("*")})
    days = rows.groupBy("activity_date").agg(
        n_distinct("anonymous_customer_id", approx).alias("daily_active_users"),
        n_distinct("customer", approx).alias("daily_sessions"),
        total("n").alias("daily_activities"),
        n_distinct("tool", approx).alias("unique_tools_used"),
    )
    if user_list:
        # Users are made distinct per day before any list is built.
        lists = daily_users(stream).groupBy("activity_date").agg(
            F.expr("listagg(user, ', ') WITHIN GROUP (ORDER BY user)").alias("user_list")
        )
        days = days.join(lists, "activity_date", "left")
    previous = F.lag("daily_active_users").over(Window.orderBy("activity_date"))  # one row per day
    return days.withColumn("previous_day_users", previous).select(
        "activity_date", "daily_active_users", "daily_sessions", "daily_activities",
        F.round(F.col("daily_activities") / F.nullif("daily_sessions", F.lit(0)), 2).alias("avg_activities_per_session"),
        "unique_tools_used", *(["user_list"] if user_list else []), "previous_day_users",
        F.round((F.col("daily_active_users") - F.col("previous_day_users"))
                / F.nullif("previous_day_users", F.lit(0)) * 100, 2).alias("daily_growth_percentage"),
    )


def daily_users(stream: DataFrame) -> DataFrame:
    """Distinct (day, user) rows."""
    return (
        stream.where(like_prefix("activity", vocab.STREAM_PREFIX) & F.col("anonymous_customer_id").isNotNull())
        .select(trunc_ts("day", "ts").alias("activity_date"), F.col("anonymous_customer_id").alias("user"))
        .distinct()
    )


def tool_usage(stream: DataFrame, approx: bool = False) -> DataFrame:
    p = payload_of(stream.where(F.col("activity") == vocab.TOOL_CALL),
                   "tool_name", "duration_ms", "tokens_used", "result_type", once=True)
    typed = p.df.select(
        p.text("tool_name").alias("tool_name"), "customer", "anonymous_customer_id", "ts", "revenue_impact",
        p.whole("duration_ms").alias("ms"), p.whole("tokens_used").alias("tokens"),
        p.text("result_type").alias("result"),
    )
    square = F.col("ms").cast("decimal(19,0)") * F.col("ms").cast("decimal(19,0)")
    rows = partial(typed, ("tool_name", "customer", "anonymous_customer_id"), {
        "n": F.count("*"), "ms_sum": F.sum("ms"), "ms_n": F.count("ms"), "ms_squares": F.sum(square), "ms_min": F.min("ms"), "ms_max": F.max("ms"),
        "tokens": F.sum("tokens"), "tokens_n": F.count("tokens"), "good": F.count_if(F.col("result") == "success"),
        "cost": F.sum("revenue_impact"), "costed": F.count("revenue_impact"), "first": F.min("ts"), "last": F.max("ts")})
    return (
        rows.groupBy("tool_name")
        .agg(
            total("n").alias("usage_count"),
            n_distinct("customer", approx).alias("unique_sessions"),
            n_distinct("anonymous_customer_id", approx).alias("unique_users"),
            steady_round(mean("ms_sum", "ms_n"), 2).alias("avg_duration_ms"),
            F.min("ms_min").alias("min_duration_ms"),
            F.max("ms_max").alias("max_duration_ms"),
            F.round(deviation("ms_sum", "ms_squares", "ms_n"), 2).alias("stddev_duration_ms"),
            F.sum("tokens").alias("total_tokens"),
            steady_round(mean("tokens", "tokens_n"), 2).alias("avg_tokens_per_call"),
            total("good").alias("successful_calls"),
            F.sum("cost").alias("total_cost"),
            mean("cost", "costed").alias("avg_cost_per_call"),
            F.min("first").alias("first_used"),
            F.max("last").alias("last_used"),
        )
        .where(F.col("tool_name").isNotNull())
        .select(
            "*",
            pct(F.col("successful_calls"), F.col("usage_count"), 2).alias("success_rate_percentage"),
            ts_diff("hour", F.col("first_used"), F.col("last_used")).alias("hours_in_use"),
        )
    )


def error_analysis(stream: DataFrame, approx: bool = False) -> DataFrame:
    """Errors by day, type and message, with the tools involved."""
    p = payload_of(stream, "error_type", "error_message", "tool_name", "recovery_action", "result_type", once=True)
    errors = p.df.where((F.col("activity") == vocab.ERROR) | (p.text("result_type") == "error")).select(
        trunc_ts("day", "ts").alias("error_date"), p.text("error_type").alias("error_type"),
        p.text("error_message").alias("error_message"), "customer", "anonymous_customer_id", "ts",
        p.text("tool_name").alias("tool"), p.text("recovery_action").alias("recovery"),
    )
    return errors.groupBy("error_date", "error_type", "error_message").agg(
        F.count("*").alias("error_count"),
        n_distinct("customer", approx).alias("affected_sessions"),
        n_distinct("anonymous_customer_id", approx).alias("affected_users"),
        # The set holds tool names, a small vocabulary, and is combined map side.
        F.nullif(F.array_join(F.array_sort(F.collect_set("tool")), ", "), F.lit("")).alias("related_tools"),
        F.count("recovery").alias("errors_with_recovery"),
        F.max("ts").alias("last_occurrence"),
        F.min("ts").alias("first_occurrence"),
    )


def project_activity(stream: DataFrame, approx: bool = False) -> DataFrame:
    p = payload_of(stream.where(like_prefix("activity", vocab.STREAM_PREFIX)),
                   "project_path", "git_branch", "file_path", "lines_affected", once=True)
    typed = p.df.select(
        p.text("project_path").alias("project_path"), p.text("git_branch").alias("git_branch"), "customer",
        "anonymous_customer_id", "activity", "ts", "revenue_impact", p.text("file_path").alias("file"),
        p.whole("lines_affected").alias("lines"),
    )
    rows = partial(typed, ("project_path", "git_branch", "customer", "anonymous_customer_id", "file"), {
        "n": F.count("*"), "tools": _of(vocab.TOOL_CALL), "files": _of(vocab.FILE_OPERATION), "lines": F.sum("lines"), "first": F.min("ts"), "last": F.max("ts"),
        "cost": F.sum("revenue_impact")})
    return (
        rows.groupBy("project_path", "git_branch")
        .agg(
            n_distinct("customer", approx).alias("sessions"),
            n_distinct("anonymous_customer_id", approx).alias("users"),
            total("n").alias("total_activities"),
            total("tools").alias("tool_calls"),
            total("files").alias("file_operations"),
            n_distinct("file", approx).alias("files_touched"),
            F.sum("lines").alias("total_lines_modified"),
            F.min("first").alias("first_activity"),
            F.max("last").alias("last_activity"),
            F.sum("cost").alias("project_cost"),
        )
        .where(F.col("project_path").isNotNull())
        .withColumn("project_age_days", ts_diff("day", F.col("first_activity"), F.col("last_activity")))
    )


def quick_stats(stream: DataFrame, as_of=None, approx: bool = False) -> DataFrame:
    """Users ever, sessions today, activities of the last hour, in one pass."""
    now = bound(as_of)
    midnight = F.to_date(now).cast("timestamp_ntz")
    today = (F.col("ts") >= midnight) & (F.col("ts") < midnight + span(days=1))
    user = F.when(like_prefix("activity", vocab.STREAM_PREFIX), F.col("anonymous_customer_id"))
    return stream.select(
        user.alias("user"), F.when(today, F.col("customer")).alias("session"),
        F.col("ts").between(now - span(hours=1), now).alias("fresh"),
    ).agg(
        n_distinct("user", approx).alias("total_users"), n_distinct("session", approx).alias("sessions_today"),
        F.count_if("fresh").alias("activities_last_hour"),
    )


def table_stats(stream: DataFrame, many_rows: int = 1_000_000) -> DataFrame:
    return stream.agg(F.count("*").alias("stream_rows"), F.max("ts").alias("last_insert")).withColumn(
        "maintenance_hint", F.when(F.col("stream_rows") > many_rows, "partition the stream table")
    )
