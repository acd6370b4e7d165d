"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import payload_of, steady_round
from ..operators import (
    artifacts, dashboard, executive, knowledge, product, quality, sessions, state, text, trends, typed, views, windows,
)
from ..session import pin, work_dir
from ..sources import builders, ndjson
from ..sources.fixtures import load
from ..sources.tables import read_stream, write_result, write_stream
from ..streaming import abandoned, context, ingest, metrics, sketches

DAY = "2024-01-31 00:00:00"
HOUR = "2024-01-30 12:00:00"
#: Half of the ids of every day, by a hash: what a keyed insert finds in its target.
HALF = "md5(activity_id) < '8'"
HOST = "host3.local"
STUDY = "%proj3%"
JOBS_AS_OF = "2001-07-20 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def settle(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to ``digits`` decimals, small ints to long: comparable across engines."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = steady_round(column, digits)
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(name: str):
    def register(build: Callable[["Tables"], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return settle(build(Tables(pin(spark), sf_dir)))

        QUERIES[name] = run
        return build

    return register


class Tables:
    """Stream tables by name: ``t.activity_stream``."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)

    def work(self, label: str) -> str:
        return work_dir(self.spark, label)

    def event_stream(self, name: str) -> DataFrame:
        """The same table as a streaming DataFrame over the Parquet file."""
        from ..sources.fixtures import TABLES

        schema = self.spark.read.parquet(f"{self.sf_dir}/events.parquet").schema
        self.spark.readStream.schema(schema).parquet(f"{self.sf_dir}/event[s].parquet").createOrReplaceTempView("events")
        return self.spark.sql(TABLES[name])


# ------------------------------------------------------------------- views (P)
query("p1_stream_activities")(lambda t: views.stream_activities(t.activity_stream))
query("p2_recent_activities")(lambda t: views.recent_activities(t.activity_stream, DAY))
query("p3_sql_events")(lambda t: typed.sql_events(t.stream_v2, t.query_history))
query("p4_llm_events")(lambda t: typed.llm_events(t.stream_v2))
query("p5_tool_events")(lambda t: typed.tool_events(t.stream_v2))
query("p6_file_events")(lambda t: typed.file_events(t.stream_v2))
query("p7_session_events")(lambda t: typed.session_events(t.stream_v2))
query("p8_mcp_events")(lambda t: typed.mcp_events(t.stream_v2))
query("p9_system_events")(lambda t: typed.system_events(t.stream_v2))
query("p10_activity_log")(lambda t: views.activity_log(t.activity_stream, DAY))
query("p11_executive_templates")(lambda t: knowledge.executive_templates(t.knowledge_base))
query("p12_classify_prompts")(lambda t: knowledge.classify_prompts(t.knowledge_base))
query("p13_meta_queries")(lambda t: views.meta_queries(t.meta_stream))
query("p13b_recent_meta_queries")(lambda t: views.meta_queries(t.meta_stream, DAY, recent=True, preview=None))
query("p13c_query_questions")(lambda t: views.meta_queries(t.meta_stream, containing="query"))
query("p14_todays_activities")(lambda t: views.todays_activities(t.activity_stream, HOUR))
query("p15_screen_generated_sql")(lambda t: text.screen_generated_sql(t.model_answers))
query("p16_active_contexts")(lambda t: state.active_contexts(t.context_cache, HOUR))


# ------------------------------------------------------------ aggregations (A)
@query("a1_session_summary")
def _(t):
    return sessions.session_summary(t.activity_stream).withColumn("tools_used", F.array_join("tools_used", ","))


query("a2_activity_stats")(lambda t: sessions.activity_stats(t.activity_stream))
query("a3_executive_summary")(lambda t: executive.executive_summary(t.activity_stream, DAY))
query("a4_user_adoption")(lambda t: executive.user_adoption(t.activity_stream, user_list=True))
query("a5_tool_usage")(lambda t: executive.tool_usage(t.activity_stream))
query("a6_error_analysis")(lambda t: executive.error_analysis(t.activity_stream))
query("a7_project_activity")(lambda t: executive.project_activity(t.activity_stream))
query("a8_orphaned_sessions")(lambda t: sessions.orphaned_sessions(t.activity_stream))
query("a9_latest_sessions")(lambda t: sessions.latest_sessions(
    t.activity_stream, "2024-01-30 23:50:00", [("%proj3%", "self_study"), ("%proj5%", "assistant_project")]))
query("a10_system_evolution")(lambda t: trends.system_evolution(t.activity_stream))
query("a11_pattern_discovery")(lambda t: trends.pattern_discovery(t.activity_stream))
query("a12_cost_by_day")(lambda t: trends.cost_by_day(t.activity_stream))
query("a13_period_metrics")(lambda t: dashboard.period_metrics(t.activity_stream, HOUR))
query("a14_daily_trend")(lambda t: dashboard.daily_trend(t.activity_stream, DAY))
query("a15_top_users")(lambda t: dashboard.top_users(t.activity_stream, DAY))
query("a16_health_check")(lambda t: dashboard.health_check(t.activity_stream, "2024-01-30 12:40:00"))
query("a17_usage_by_day")(lambda t: trends.usage_by_day(t.activity_stream))
query("a18_usage_summary")(lambda t: trends.usage_summary(trends.usage_by_day(t.activity_stream)))
query("a19_daily_user_metrics")(lambda t: trends.daily_user_metrics(t.activity_stream))
query("a20_product_metrics")(lambda t: product.product_metrics(t.stream_v2, DAY, days=30))
query("a21_session_day_summary")(lambda t: sessions.session_day_summary(t.activity_stream))
query("a22_tool_breakdown")(lambda t: trends.tool_breakdown(t.activity_stream))
query("a23_files_touched")(lambda t: trends.files_touched(t.activity_stream))
query("a24_host_profile")(lambda t: sessions.host_profile(t.activity_stream, HOST, STUDY))
query("a24b_host_sessions")(lambda t: sessions.host_sessions(t.activity_stream, HOST, DAY))
query("a24c_host_progress")(lambda t: sessions.host_progress(t.activity_stream, HOST, STUDY))
query("a25_session_gap_counts")(lambda t: sessions.session_gap_counts(t.activity_stream, "2024-01-30 20:00:00"))
query("a25b_active_sessions")(lambda t: sessions.active_sessions(t.activity_stream))


query("a26_successful_patterns")(
    lambda t: knowledge.successful_patterns(knowledge.classify_prompts(t.knowledge_base)))
query("a26b_pattern_examples")(
    lambda t: knowledge.pattern_examples(knowledge.classify_prompts(t.knowledge_base)))
query("a27_intelligence_metrics")(
    lambda t: knowledge.intelligence_metrics(knowledge.classify_prompts(t.knowledge_base)))
query("a28_hourly_latency_p95")(lambda t: product.hourly_latency_p95(t.stream_v2, HOUR))
query("a29_success_rate")(lambda t: product.success_rate(t.stream_v2, HOUR, more_than=2))
query("a30_stream_lag")(lambda t: product.stream_lag(t.stream_v2, t.insight_atoms, DAY))
query("a31_schema_drift")(lambda t: quality.schema_drift(t.stream_v2, DAY))
query("a31b_payload_kinds")(lambda t: quality.payload_kinds(t.stream_v2))
query("a32_context_entries")(lambda t: state.context_entries(t.stream_v2, t.insight_atoms, t.stream_v2, HOUR))


@query("a32b_context_blobs")
def _(t):
    blobs = state.context_blobs(t.stream_v2, t.insight_atoms, t.stream_v2, HOUR)
    body = F.col("context_blob")

    def size(path: str):
        return F.size(F.json_object_keys(F.get_json_object(body, path))).cast("bigint")

    return blobs.select(
        "customer", "context_type", size("$.activities").alias("activity_keys"), size("$.insights").alias("insight_keys"),
        F.json_array_length(F.get_json_object(body, "$.recent_queries")).cast("bigint").alias("query_count"),
        size("$.tool_usage").alias("tool_keys"),
        F.get_json_object(body, "$.recent_queries[0].activity_id").alias("newest_query"),
        F.get_json_object(body, "$.refresh_lag_ms").cast("bigint").alias("refresh_lag_ms"),
        F.get_json_object(body, "$.is_stale").alias("is_stale"),
    )


_PROPS = T.StructType([T.StructField("k", T.LongType())])


@query("a33_artifact_profile")
def _(t):
    profile = artifacts.artifact_profile(
        t.result_rows, ["ts", "event_id"], F.date_trunc("hour", "ts"), DAY, schema=_PROPS, page_list=False)
    return profile.withColumn("sample_rows", F.array_join("sample_rows", ","))


@query("a33b_page_sizes")
def _(t):
    return artifacts.page_sizes(
        artifacts.numbered_rows(t.result_rows, ["ts", "event_id"], F.date_trunc("hour", "ts")))


query("a34_migration_validation")(lambda t: quality.migration_validation(t.activity_stream, t.stream_v2))
query("a35_study_sessions_by_day")(lambda t: sessions.study_sessions_by_day(t.activity_stream, STUDY))
query("a36_table_stats")(lambda t: executive.table_stats(t.activity_stream, many_rows=5_000))
query("a37_quick_stats")(lambda t: executive.quick_stats(t.activity_stream, "2024-01-30 20:00:00"))
query("a37b_successful_payloads")(lambda t: views.successful_payloads(t.meta_stream, DAY))
query("a38_stream_window_summary")(
    lambda t: product.stream_window_summary(t.stream_v2, "c3", HOUR, minutes=60 * 24 * 7))
query("a39_quarantine_counts")(lambda t: quality.quarantine_counts(t.insight_atoms))
query("a40_longest_sessions")(lambda t: sessions.longest_sessions(t.activity_stream, HOST, n=10))


@query("a41_customer_health")
def _(t):
    """Of the customer with the newest event before DAY, at that event."""
    last = t.stream_v2.where(F.col("ts") < F.lit(DAY).cast("timestamp_ntz")).orderBy(F.desc("ts"), "customer").select("customer", "ts").first()
    return product.customer_health(product.product_metrics(t.stream_v2, DAY), last["customer"], last["ts"])


# ----------------------------------------------------------------- windows (W)
query("w1_activity_occurrences")(lambda t: windows.activity_occurrences(t.activity_stream).select(
    "activity_id", "activity_occurrence", "activity_repeated_at"))
query("w2_repeated_for_one_activity")(
    lambda t: windows.activity_occurrences(t.stream_v2, "tool_call", unit="day").select(
        "activity_id", "customer", "activity", "activity_occurrence", "activity_repeated_at"))
query("w3_adoption_growth")(lambda t: executive.user_adoption(t.activity_stream, user_list=False).select(
    "activity_date", "daily_active_users", "previous_day_users", "daily_growth_percentage"))
query("w4_running_totals")(
    lambda t: knowledge.intelligence_metrics(knowledge.classify_prompts(t.knowledge_base)).select(
        "query_date", "cumulative_queries"))
query("w5_rolling_rate")(
    lambda t: knowledge.intelligence_metrics(knowledge.classify_prompts(t.knowledge_base)).select(
        "query_date", "rolling_7day_success_rate"))
query("w6_self_study_sessions")(lambda t: windows.self_study_sessions(t.activity_stream, STUDY))
query("w7_latest_per_customer")(lambda t: sessions.latest_per_customer(t.stream_v2))
query("w8_dedup_keep_first")(lambda t: windows.dedup_keep_first(
    ndjson.parse_lines(t.ndjson_lines, DAY), order=("ts", "feature_json")))

# ---------------------------------------------------------------- set ops (O)
query("o1_union_of_checks")(lambda t: quality.migration_validation(t.stream_v2, t.meta_stream))
query("o2_orphaned_today")(lambda t: sessions.orphaned_today(t.activity_stream, HOUR))
query("o3_distinct_activities")(lambda t: trends.distinct_activities(t.activity_stream))
query("o4_learning_opportunities")(lambda t: knowledge.learning_opportunities(t.knowledge_base))


# ------------------------------------------------------- table-changing jobs (D)
def _migrated(t):
    """A first-generation stream of which half of the ids, on every day, are migrated."""
    return t.activity_stream.where(HALF)


def _teams(t):
    """The stream by groups of customers, each with more than ten queries a day."""
    return t.stream_v2.withColumn("customer", F.substring("customer", 1, 2))


@query("d1_insert_if_absent")
def _(t):
    lines = ndjson.parse_lines(t.ndjson_lines, DAY)
    old = lines.where(HALF).select("activity_id").distinct()
    return state.insert_if_absent(old, lines.select("activity_id", "ts", "feature_json"), order=["ts", "feature_json"])


@query("d2_dual_write")
def _(t):
    old, new = state.dual_write(t.stream_v2, t.activity_stream, _migrated(t))
    return old.withColumn("generation", F.lit("old")).unionByName(new.withColumn("generation", F.lit("new")))


query("d3_backfill")(
    lambda t: state.backfill(t.activity_stream, _migrated(t), "2024-01-08", "2024-01-20"))


@query("d3b_backfill_rows_by_day")
def _(t):
    """Between stored tables, whose days bound both sides."""
    base = t.work("backfill")
    write_stream(t.activity_stream, f"{base}/old")
    write_stream(_migrated(t), f"{base}/new")
    rows = state.backfill_rows(read_stream(t.spark, f"{base}/old"), read_stream(t.spark, f"{base}/new"), "2024-01-08", "2024-01-20", same_day=True)
    return rows.drop("dt")


@query("d4_refresh_context")
def _(t):
    blobs = state.context_blobs(t.stream_v2, t.insight_atoms, t.stream_v2, HOUR)
    out = state.refresh_context(t.context_cache, blobs, HOUR)
    return out.withColumn("has_blob", F.length("context_blob") > 2).drop("context_blob")


query("d4b_refresh_log")(lambda t: state.refresh_log(t.stream_v2, HOUR))
query("d5_clean_artifacts")(lambda t: artifacts.clean_artifacts(t.artifacts, HOUR))
query("d5b_stale_insights")(lambda t: artifacts.mark_stale_insights(t.insight_atoms, HOUR))
query("d5c_expired_count")(lambda t: artifacts.expired_artifacts(t.artifacts, HOUR).agg(
    F.count("*").alias("deleted_count")))
query("d6_quarantine_insights")(lambda t: quality.quarantine_insights(t.insight_atoms, t.stream_v2, DAY))
query("d6b_quarantine_on_drift")(lambda t: quality.quarantine_insights(
    t.insight_atoms, t.stream_v2, DAY, drift=quality.schema_drift(t.stream_v2, DAY)))
query("d7_drift_events")(
    lambda t: quality.drift_events(quality.schema_drift(t.stream_v2, DAY), DAY))
query("d8_record_insights")(lambda t: state.record_insights(product.run_rollups(_teams(t), HOUR), HOUR))
query("d9_log_queries")(lambda t: knowledge.log_queries(t.knowledge_base.selectExpr(
    "user_prompt AS prompt", "generated_query AS query", "query_success AS success", "result_count AS row_count",
    "execution_time_ms AS exec_time"), DAY))
query("d10_valid_insights")(lambda t: state.valid_insights(t.insight_atoms, HOUR))
query("d11_seed_definitions")(lambda t: state.seed_definitions(
    t.activity_stream.select(F.col("activity").alias("activity_name")).distinct()).select("activity_name"))
query("q1_validate_events")(lambda t: quality.validate_events(t.stream_v2))
query("t3_changes_between")(lambda t: state.changes_between(t.insight_atoms, t.insight_atoms_later))

# --------------------------------------------------------------- sources (S)
query("s1_parse_lines")(lambda t: ndjson.parse_lines(t.ndjson_lines, DAY))
query("s3_enrich_events")(lambda t: ndjson.enrich_events(t.stream_v2, DAY))
query("s4_degrade_events")(
    lambda t: ndjson.degrade_events(t.stream_v2, backlog_age_ms=130_000, max_chars=390))
query("s5_backpressure_events")(lambda t: ndjson.backpressure_events(t.backlog, threshold_ms=1_800_000))
query("s6_parse_agent_log")(lambda t: text.parse_agent_log(t.agent_lines))
query("s7_detect_tools_in_text")(lambda t: text.detect_tools_in_text(t.output_lines))


@query("s8_build_events")
def _(t):
    p = payload_of(t.stream_v2, "tool_name", "prompt_tokens", "operation", "file_path", "total_tokens")
    calls = p.df.select(
        "activity_id", "ts", "customer", F.col("anonymous_customer_id").alias("host"),
        p.text("tool_name").alias("tool_name"), p.whole("prompt_tokens").alias("tokens_used"),
        p.text("operation").alias("operation"), p.text("file_path").alias("file_path"),
        p.whole("total_tokens").alias("total_tokens"), F.col("customer").alias("session_id"),
    )
    rows = None
    for kind in builders.PAYLOADS:
        part = builders.build_events(kind, calls)
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query("s8b_build_session_ends")
def _(t):
    p = payload_of(t.stream_v2.where(F.col("activity") == "claude_session_end"), "total_tokens")
    return builders.build_session_ends(p.df.select(
        "activity_id", "ts", "customer", F.col("anonymous_customer_id").alias("host"), F.col("customer").alias("session_id"),
        p.whole("total_tokens").alias("total_tokens")))


@query("s9_write_and_read")
def _(t):
    path = t.work("stream")
    write_stream(t.activity_stream, path)
    return read_stream(t.spark, path)


@query("s12_result_formats")
def _(t):
    """Written and read back in each format, with the format as a column."""
    trend, base, rows = dashboard.daily_trend(t.activity_stream, DAY), t.work("formats"), None
    for kind in ("csv", "json", "parquet"):
        write_result(trend, f"{base}/{kind}", kind)
        reader = t.spark.read.schema(trend.schema).option("header", True)
        part = getattr(reader, kind)(f"{base}/{kind}").withColumn("format", F.lit(kind))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query("s10_dual_sink")
def _(t):
    base = t.work("dual")
    run = ingest.ingest_dual(t.event_stream("stream_v2"), f"{base}/old", f"{base}/new", f"{base}/checkpoint")
    run.awaitTermination()
    old, new = read_stream(t.spark, f"{base}/old").drop("dt", "batch"), read_stream(t.spark, f"{base}/new").drop("dt")
    return old.withColumn("generation", F.lit("old")).unionByName(new.withColumn("generation", F.lit("new")))


# ------------------------------------------------------------- streaming (T)
@query("t1_ingest_stream")
def _(t):
    base = t.work("ingest")
    rows = ndjson.parse_lines(t.event_stream("ndjson_lines"), DAY)
    ingest.ingest_stream(rows, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return read_stream(t.spark, f"{base}/table").drop("dt")


def _refreshed(t):
    """The cache after a run of the context stream, its version merged into a base."""
    base = t.work("context")
    context.context_stream(
        t.event_stream("stream_v2"), f"{base}/cache", f"{base}/checkpoint",
        lambda: t.insight_atoms, lambda: t.stream_v2, HOUR,
    ).awaitTermination()
    context.compact_cache(t.spark, f"{base}/cache", retire=True)
    return context.read_cache(t.spark, f"{base}/cache", HOUR)


@query("t2_context_stream")
def _(t):
    return _refreshed(t).withColumn("has_blob", F.length("context_blob") > 2).drop("context_blob")


query("t2b_cached_entries")(lambda t: state.blob_entries(_refreshed(t)))
query("d4c_refreshed_entries")(lambda t: state.blob_entries(state.refresh_context(
    t.context_cache, state.context_blobs(t.stream_v2, t.insight_atoms, t.stream_v2, HOUR), HOUR)))


@query("a32c_context_pages")
def _(t):
    pages = state.context_pages(state.context_entries(t.stream_v2, t.insight_atoms, t.stream_v2, HOUR), page_rows=5)
    return pages.select("customer", F.inline("entries"))


@query("t5_hourly_metrics_stream")
def _(t):
    base = t.work("hourly")
    table = f"{base}/table"
    write_stream(t.stream_v2, table)
    rows = t.spark.readStream.schema(read_stream(t.spark, table).schema).parquet(table)
    metrics.hourly_metrics_stream(
        rows, f"{base}/hours", f"{base}/checkpoint", lambda: read_stream(t.spark, table)).awaitTermination()
    return metrics.read_hourly_metrics(t.spark, f"{base}/hours")


@query("t5b_hourly_sketch_stream")
def _(t):
    base = t.work("sketches")
    sketches.hourly_sketch_stream(t.event_stream("stream_v2"), f"{base}/hours", f"{base}/checkpoint").awaitTermination()
    sketches.compact_hourly_sketches(t.spark, f"{base}/hours", retire=True)
    return sketches.read_hourly_sketches(t.spark, f"{base}/hours")


query("t6_run_rollups")(lambda t: product.run_rollups(_teams(t), HOUR))
query("t7_pending_lag")(lambda t: product.pending_lag(t.stream_v2, "2024-01-30 00:00:00", DAY))
query("t8_run_health")(lambda t: product.run_health(t.job_runs, JOBS_AS_OF, hours=24 * 365 * 5))
query("t9_abandoned_sessions")(lambda t: metrics.abandoned_sessions(t.activity_stream, timeout="2 hours"))


@query("t9b_abandoned_sessions_stream")
def _(t):
    base = t.work("abandoned")
    abandoned.abandoned_sessions_stream(t.event_stream("activity_stream"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{base}/out")
