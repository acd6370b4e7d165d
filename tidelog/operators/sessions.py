"""Session-level measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import vocab
from ..functions import bound, day_of, is_day, like_prefix, n_distinct, payload_of, pct, since, span, trunc_ts, ts_diff


def _is(activity: str):
    return F.col("activity") == activity


def session_summary(stream: DataFrame) -> DataFrame:
    """One row per session: bounds, counts, tokens, cost, tools used."""
    p = payload_of(
        stream.where(like_prefix("activity", vocab.STREAM_PREFIX)), "tokens_used", "tool_name", "project_path"
    )
    rows = p.df.select(
        F.col("customer").alias("session_id"), "ts", "activity", "revenue_impact",
        p.whole("tokens_used").alias("tokens"), p.text("tool_name").alias("tool"),
        p.text("project_path").alias("project"),
    )
    # Reduced to (session, activity, tool) first: the sets below then hold
    # vocabulary-sized groups, and a session with very many rows is combined map side.
    parts = rows.groupBy("session_id", "activity", "tool").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n"),
        F.sum("tokens").alias("tokens"), F.sum("revenue_impact").alias("cost"), F.max("project").alias("project"),
    )
    return parts.groupBy("session_id").agg(
        F.min(F.when(_is(vocab.SESSION_START), F.col("first"))).alias("session_start"),
        F.max(F.when(_is(vocab.SESSION_END), F.col("last"))).alias("session_end"),
        F.sum("n").alias("total_activities"),
        F.size(F.collect_set("activity")).cast("bigint").alias("unique_activity_types"),
        F.sum(F.when(_is(vocab.TOOL_CALL), F.col("n")).otherwise(0)).alias("tool_calls"),
        F.sum(F.when(_is(vocab.ERROR), F.col("n")).otherwise(0)).alias("errors"),
        F.sum("tokens").alias("total_tokens"),
        F.sum("cost").alias("total_cost"),
        F.array_sort(F.collect_set("tool")).alias("tools_used"),
        F.max("project").alias("project_path"),
    )


def activity_stats(stream: DataFrame, approx: bool = False) -> DataFrame:
    """Activity by hour."""
    p = payload_of(stream, "duration_ms")
    return (
        p.df.select("activity", trunc_ts("hour", "ts").alias("hour"), "customer", "ts", "revenue_impact",
                    p.whole("duration_ms").alias("ms"))
        .groupBy("activity", "hour")
        .agg(
            F.count("*").alias("activity_count"),
            n_distinct("customer", approx).alias("unique_sessions"),
            F.avg("ms").alias("avg_duration_ms"),
            F.sum("revenue_impact").alias("total_revenue_impact"),
            F.max("ts").alias("last_occurrence"),
        )
    )


def orphaned_sessions(stream: DataFrame) -> DataFrame:
    """Sessions with and without an end event, in total."""
    ended = (
        stream.where(like_prefix("activity", vocab.STREAM_PREFIX))
        .groupBy("customer")
        .agg(F.max(_is(vocab.SESSION_END)).alias("ended"))
    )
    return ended.agg(
        F.count("*").alias("total_sessions"),
        F.sum(F.when(F.col("ended"), 0).otherwise(1)).alias("orphaned_sessions"),
        F.sum(F.when(F.col("ended"), 1).otherwise(0)).alias("completed_sessions"),
    ).select("*", pct(F.col("orphaned_sessions"), F.col("total_sessions"), 1).alias("orphan_rate_pct"))


def latest_sessions(
    stream: DataFrame, as_of=None, labels: Sequence[tuple[str, str]] = (), other: str = "other", n: int = 20
) -> DataFrame:
    """Newest ``n`` sessions, each labelled by the first LIKE pattern its project matches."""
    p = payload_of(stream.where(like_prefix("activity", vocab.STREAM_PREFIX)), "project_path")
    now = bound(as_of)
    label = F.lit(other)
    for pattern, code in reversed(labels):
        label = F.when(F.col("project_directory").like(pattern), code).otherwise(label)
    return (
        p.df.select("customer", "ts", p.text("project_path").alias("project"))
        .groupBy(F.col("customer").alias("session_id"))
        .agg(F.min("ts").alias("session_start"), F.max("ts").alias("last_activity"),
             F.max("project").alias("project_directory"), F.count("*").alias("activity_count"))
        .orderBy(F.desc("session_start"), F.asc("session_id"))
        .limit(n)
        .select(
            "session_id", "session_start", "last_activity",
            ts_diff("minute", F.col("session_start"), F.col("last_activity")).alias("duration_minutes"),
            "project_directory", label.alias("work_label"), "activity_count",
            F.when(F.col("session_start") > now - span(minutes=10), "current").otherwise("").alias("session_marker"),
        )
    )


def session_day_summary(stream: DataFrame, approx: bool = False) -> DataFrame:
    return stream.groupBy(day_of().alias("date")).agg(
        n_distinct("customer", approx).alias("unique_sessions"),
        F.count("*").alias("total_activities"),
        F.count_if(_is(vocab.SESSION_START)).alias("sessions_started"),
        F.count_if(_is(vocab.SESSION_END)).alias("sessions_ended"),
    )


def longest_sessions(stream: DataFrame, host: str | None = None, n: int = 1) -> DataFrame:
    """Sessions by minutes between first and last event, longest first."""
    rows = stream if host is None else stream.where(F.col("anonymous_customer_id") == host)
    return (
        rows.groupBy("customer")
        .agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
        .select("customer", ts_diff("minute", F.col("first"), F.col("last")).alias("duration_minutes"))
        .orderBy(F.desc("duration_minutes"), F.asc("customer"))
        .limit(n)
    )


def active_sessions(stream: DataFrame, as_of=None, hours: int | None = None) -> DataFrame:
    """Start events of sessions that have no end event.

    Sessions without a name cannot be matched and are left out; end events
    without a name exclude nobody.
    """
    starts = stream.where(_is(vocab.SESSION_START) & F.col("customer").isNotNull())
    if hours is not None:
        starts = since(starts, bound(as_of) - span(hours=hours), strict=True, to=bound(as_of))
    ends = stream.where(_is(vocab.SESSION_END)).select("customer")
    if hours is not None:
        # few starts: the ends of all time are cut to theirs before they are made distinct
        ends = ends.join(starts.select("customer").distinct(), "customer", "left_semi")
    ends = ends.distinct()
    return starts.join(ends, "customer", "left_anti")


def orphaned_today(stream: DataFrame, as_of=None) -> DataFrame:
    """Distinct sessions started but not ended on the day of ``as_of``."""
    day = is_day(stream, as_of)
    started = day.where(_is(vocab.SESSION_START)).select("customer")
    ended = day.where(_is(vocab.SESSION_END)).select("customer")
    return started.subtract(ended)


def session_gap_counts(stream: DataFrame, as_of=None) -> DataFrame:
    active = active_sessions(stream, as_of, hours=1).agg(F.count("*").alias("value"))
    orphaned = orphaned_today(stream, as_of).agg(F.count("*").alias("value"))
    return active.select(F.lit("active").alias("metric"), "value").unionByName(
        orphaned.select(F.lit("orphaned_today").alias("metric"), "value")
    )


def study_sessions_by_day(stream: DataFrame, project_like: str) -> DataFrame:
    """Session starts in matching projects, by day."""
    p = payload_of(stream.where(_is(vocab.SESSION_START)), "project_path")
    return (
        p.df.where(p.text("project_path").like(project_like))
        .groupBy(day_of().alias("day"))
        .agg(F.count("*").alias("study_sessions"))
    )


def _host(stream: DataFrame, host: str) -> DataFrame:
    return stream.where(F.col("anonymous_customer_id") == host)


def host_profile(stream: DataFrame, host: str, project_like: str) -> DataFrame:
    """One row about a host: activity totals, orphan and study counts, level.

    One scan: rows are reduced to one per session, then to one in total.
    """
    p = payload_of(_host(stream, host), "project_path")
    named = like_prefix("activity", vocab.STREAM_PREFIX)
    by_day = (
        p.df.select("customer", day_of().alias("day"), "ts", named.alias("named"),
                    F.col("activity").like(vocab.SESSION_PREFIX + "%").alias("session_event"),
                    _is(vocab.SESSION_END).alias("is_end"),
                    p.text("project_path").like(project_like).alias("study"))
        .groupBy("customer", "day")
        .agg(
            F.count_if("named").alias("n"), F.max(F.when(F.col("named"), F.col("ts"))).alias("last"),
            F.max("session_event").alias("has_session"), F.max("is_end").alias("has_end"), F.max("study").alias("study"),
        )
    )
    totals = by_day.where("n > 0").agg(
        F.countDistinct("customer").alias("sessions_started"), F.countDistinct("day").alias("days_active"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_activities"), F.to_date(F.max("last")).alias("last_active"),
    )
    sessions = by_day.groupBy("customer").agg(
        F.max("has_session").alias("has_session"), F.max("has_end").alias("has_end"), F.max("study").alias("study")
    )
    counts = sessions.agg(
        F.count_if(F.col("has_session") & ~F.col("has_end")).alias("orphaned_sessions"),
        F.count_if(F.col("study") & F.col("customer").isNotNull()).alias("study_sessions"),
    )
    level = (
        F.when(F.col("study_sessions") > 5, "expert").when(F.col("study_sessions") > 2, "advanced")
        .when(F.col("orphaned_sessions") > 0, "discoverer").otherwise("beginner")
    )
    one = F.lit(1).alias("_one")
    return (
        totals.select("*", one).join(counts.select("*", one), "_one").drop("_one").withColumn("level", level)
    )


def host_sessions(stream: DataFrame, host: str, as_of=None, n: int = 5) -> DataFrame:
    """The host's newest ``n`` sessions."""
    p = payload_of(_host(stream, host).where(like_prefix("activity", vocab.STREAM_PREFIX)), "project_path")
    return (
        p.df.select("customer", "ts", p.text("project_path").alias("project"))
        .groupBy(F.col("customer").alias("session_id"))
        .agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), F.count("*").alias("activity_count"),
             F.max("project").alias("project"))
        .orderBy(F.desc("start_time"), F.asc("session_id"))
        .limit(n)
        .select(
            "session_id", "start_time",
            ts_diff("minute", F.col("start_time"), F.coalesce("end_time", bound(as_of))).alias("duration_mins"),
            "activity_count",
            F.substring("project", -30, 30).alias("project_name"),
        )
    )


def host_progress(stream: DataFrame, host: str, project_like: str) -> DataFrame:
    """Event-based variant of the host level."""
    p = payload_of(_host(stream, host), "project_path")
    study = F.coalesce(p.text("project_path").like(project_like), F.lit(False))
    return p.df.agg(
        F.countDistinct(day_of()).alias("days_active"), F.countDistinct("customer").alias("sessions_started"),
        F.count_if(study).alias("study_events"),
    ).withColumn(
        "level",
        F.when(F.col("study_events") > 10, "expert").when(F.col("study_events") > 5, "advanced")
        .when(F.col("sessions_started") > 5, "growing").when(F.col("sessions_started") > 0, "starting")
        .otherwise("new"),
    )


def latest_per_customer(stream: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` rows of every customer (limited per task before the shuffle)."""
    place = Window.partitionBy("customer").orderBy(F.desc("ts"), F.asc("activity_id"))
    return stream.withColumn("place", F.row_number().over(place)).where(F.col("place") <= n)
