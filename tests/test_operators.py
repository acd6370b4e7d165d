import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelog import vocab
from tidelog.catalog.queries import QUERIES
from tidelog.operators import artifacts, dashboard, executive, knowledge, product, quality, sessions, state, text, trends, typed, views, windows
from tidelog.plans.partial import deviation, partial
from tidelog.plans.upsert import insert_if_absent, latest_version, write_version
from tidelog.sources import ndjson
from tidelog.sources.builders import token_cost
from tidelog.sources.fixtures import TABLES, load
from tidelog.sources.tables import append_new, read_stream, write_result, write_stream

T0 = dt.datetime(2024, 1, 1, 12)
DAY = "2024-01-31"
STREAM = ("activity_id string, ts timestamp_ntz, activity string, customer string, anonymous_customer_id string, "
          "feature_json string, revenue_impact double, link string")


def stream(spark, rows):
    full = [(i, ts, a, c, "h", payload, None, None) for i, ts, a, c, payload in rows]
    return spark.createDataFrame(full, STREAM)


AGGREGATES = {
    "session_summary": lambda a: sessions.session_summary(a),
    "activity_stats": lambda a: sessions.activity_stats(a),
    "orphaned_sessions": lambda a: sessions.orphaned_sessions(a),
    "latest_sessions": lambda a: sessions.latest_sessions(a, DAY),
    "session_gap_counts": lambda a: sessions.session_gap_counts(a, DAY),
    "host_profile": lambda a: sessions.host_profile(a, "h", "%x%"),
    "host_sessions": lambda a: sessions.host_sessions(a, "h", DAY),
    "longest": lambda a: sessions.longest_sessions(a),
    "executive_summary": lambda a: executive.executive_summary(a, DAY),
    "executive_summary_approx": lambda a: executive.executive_summary(a, DAY, approx=True),
    "user_adoption": lambda a: executive.user_adoption(a),
    "tool_usage": lambda a: executive.tool_usage(a),
    "error_analysis": lambda a: executive.error_analysis(a),
    "project_activity": lambda a: executive.project_activity(a),
    "quick_stats": lambda a: executive.quick_stats(a, DAY),
    "table_stats": lambda a: executive.table_stats(a),
    "period_metrics": lambda a: dashboard.period_metrics(a, DAY),
    "daily_trend": lambda a: dashboard.daily_trend(a, DAY),
    "top_users": lambda a: dashboard.top_users(a, DAY),
    "health_check": lambda a: dashboard.health_check(a, DAY),
    "system_evolution": lambda a: trends.system_evolution(a),
    "pattern_discovery": lambda a: trends.pattern_discovery(a),
    "cost_by_day": lambda a: trends.cost_by_day(a),
    "usage": lambda a: trends.usage_summary(trends.usage_by_day(a)),
    "daily_user_metrics": lambda a: trends.daily_user_metrics(a),
    "product_metrics": lambda a: product.product_metrics(a, DAY),
    "product_metrics_approx": lambda a: product.product_metrics(a, DAY, approx=True),
    "rollups": lambda a: product.run_rollups(a, DAY),
    "lag": lambda a: product.stream_lag(a, a, DAY),
    "drift": lambda a: quality.schema_drift(a, DAY),
    "violations": lambda a: quality.validate_events(a),
    "validation": lambda a: quality.migration_validation(a, a),
    "self_study": lambda a: windows.self_study_sessions(a, "%x%"),
    "log": lambda a: views.activity_log(a, DAY),
}
ONE_ROW = {"orphaned_sessions", "executive_summary", "executive_summary_approx", "quick_stats", "table_stats", "host_profile"}


@pytest.mark.parametrize("name", list(AGGREGATES))
def test_empty_input(spark, name):
    rows = AGGREGATES[name](stream(spark, [])).collect()
    if name in ONE_ROW:
        assert len(rows) == 1
    if name == "period_metrics":
        assert [r.period for r in rows] == list(dashboard.PERIODS) and all(r.sessions == 0 for r in rows)


def test_approx_agrees_on_small_data(spark, sf_dir):
    a = load(spark, sf_dir, "activity_stream")
    exact, approx = executive.executive_summary(a, DAY).first(), executive.executive_summary(a, DAY, approx=True).first()
    assert exact.total_activities == approx.total_activities
    assert abs(exact.total_sessions - approx.total_sessions) <= 0.15 * exact.total_sessions
    v = load(spark, sf_dir, "stream_v2")
    assert product.product_metrics(v, DAY, 30, approx=True).count() == product.product_metrics(v, DAY, 30).count()


def test_unknown_latency_is_worst_class(spark):
    df = stream(spark, [("1", T0, "llm_call", "c", '{"latency_ms":"n/a"}'), ("2", T0, "tool_call", "c", "{}"),
                        ("3", T0, "mcp_call", "c", "{}")])
    assert typed.llm_events(df).first().latency_category == "slow"
    assert typed.tool_events(df).first().performance_tier == "poor"
    assert typed.mcp_events(df).first().latency_slo_status == "slo_breach"


def test_legacy_tool_name(spark):
    df = stream(spark, [("1", T0, "tool_call", "c", "{}")]).withColumn("feature_1", F.lit("old"))
    assert typed.tool_events(df).first().tool_name_normalized == "old"


def test_interval_join_fans_out(spark):
    v = stream(spark, [("1", T0, "query_complete", "c", '{"query_id":"q1"}')])
    history = spark.createDataFrame(
        [("h1", "cdesk:q1", T0), ("h2", "cdesk:q1", T0 + dt.timedelta(minutes=5)), ("h3", "cdesk:q1", T0 + dt.timedelta(minutes=6))],
        "query_id string, query_tag string, start_time timestamp_ntz")
    assert {r.history_query_id for r in typed.sql_events(v, history).collect()} == {"h1", "h2"}


def test_health_check_single_baseline_value(spark):
    rows = [(f"{d}", dt.datetime(2024, 1, d, 12, 5), "x", "s", "{}") for d in (9, 10)]
    row = dashboard.health_check(stream(spark, rows), "2024-01-10 12:30:00").first()
    assert (row.status, row.current_sessions, row.typical_sessions) == ("normal", 1, 1.0)


def test_unnamed_sessions_in_gap_counts(spark):
    rows = [("1", T0, vocab.SESSION_START, "a", "{}"), ("2", T0, vocab.SESSION_START, None, "{}"),
            ("3", T0, vocab.SESSION_END, None, "{}"), ("4", T0, vocab.SESSION_START, "b", "{}"),
            ("5", T0, vocab.SESSION_END, "b", "{}")]
    assert [r.customer for r in sessions.active_sessions(stream(spark, rows)).collect()] == ["a"]


# ------------------------------------------------------------------ keyed tables
def test_insert_if_absent_is_idempotent(spark):
    target = spark.createDataFrame([("a", T0, 1)], "activity_id string, ts timestamp_ntz, n int")
    late = T0 + dt.timedelta(hours=1)
    source = spark.createDataFrame([("a", late, 9), ("b", late, 3), ("b", T0, 2)], target.schema)
    once = insert_if_absent(target, source)
    assert sorted((r.activity_id, r.n) for r in once.collect()) == [("a", 1), ("b", 2)]
    assert sorted(map(tuple, insert_if_absent(once, source).collect())) == sorted(map(tuple, once.collect()))


def test_backfill_without_ids_is_idempotent(spark):
    old = stream(spark, [(None, T0, "x", "c", "{}"), ("1", T0, "x", "c", "{}")])
    new = stream(spark, [])
    once = state.backfill(old, new)
    assert once.count() == 2 and state.backfill(old, once).count() == 2
    assert state.backfill(old, new, "2024-01-02").count() == 0


def test_refresh_context(spark):
    stale = T0 - dt.timedelta(minutes=1)
    cache = spark.createDataFrame(
        [("a", "default", "{}", stale, 4, True), ("b", "default", "{}", stale, 1, False), ("c", "default", "{}", T0, 1, False)],
        "customer string, context_type string, context_blob string, updated_at timestamp_ntz, access_count bigint, is_stale boolean")
    blobs = spark.createDataFrame([("a", "default", "A"), ("n", "default", "N")], "customer string, context_type string, context_blob string")
    got = {r.customer: r for r in state.refresh_context(cache, blobs, str(T0)).collect()}
    assert (got["a"].context_blob, got["a"].access_count, got["a"].is_stale, got["a"].updated_at) == ("A", 5, False, T0)
    assert (got["n"].access_count, got["n"].is_stale) == (0, False)
    assert (got["b"].is_stale, got["c"].is_stale, got["b"].access_count) == (True, False, 1)


def test_context_blob_duplicate_insights(spark):
    insight = ("id string, ts timestamp_ntz, customer string, subject string, metric string, value double, confidence double, "
               "artifact_id string, valid_until timestamp_ntz, is_stale boolean, is_quarantined boolean")
    later = T0 + dt.timedelta(days=1)
    insights = spark.createDataFrame(
        [("1", T0, "c", "s", "m", 1.0, 0.5, None, later, False, False), ("2", T0, "c", "s", "m", 2.0, 0.9, None, later, False, False)], insight)
    empty = stream(spark, [])
    blob = state.context_blobs(empty, insights, empty, str(T0)).select(
        F.get_json_object("context_blob", "$.insights['s:m'].value")).first()[0]
    assert blob == "2.0"


def test_clean_artifacts_keeps_unknown_expiry(spark):
    past = T0 - dt.timedelta(days=1)
    df = spark.createDataFrame([("a", None, False, 0), ("b", past, False, 0), ("c", past, True, 0), ("d", past, False, 2)],
                               "artifact_id string, expires_at timestamp_ntz, is_pinned boolean, access_count int")
    assert sorted(r.artifact_id for r in artifacts.clean_artifacts(df, str(T0)).collect()) == ["a", "c", "d"]


def test_versions(spark, tmp_path):
    base = str(tmp_path / "v")
    assert latest_version(spark, base) is None
    for version in (1, 2, 10):
        write_version(spark.range(version), base, version)
    assert latest_version(spark, base).endswith("version=000000000010")
    assert latest_version(spark, base, below=10).endswith("version=000000000002")


def test_seed_knowledge_base(spark):
    empty = spark.createDataFrame([], "kb_id string, user_prompt string, query_success boolean")
    seeded = knowledge.seed_knowledge_base(empty)
    assert seeded.count() == len(vocab.SEED_PROMPTS) == knowledge.seed_knowledge_base(seeded).count()


def test_pattern_examples_as_arrays(spark):
    kb = spark.createDataFrame([("a", "p2", "q", True, 1), ("a", "p1", "q", True, 3), (None, "p3", "q3", True, 5), ("b", "x", "y", False, 1)],
                               "common_pattern string, user_prompt string, generated_query string, query_success boolean, execution_time_ms int")
    got = {r.common_pattern: r for r in knowledge.successful_patterns(kb, examples=True).collect()}
    assert set(got) == {"a", None}
    assert (got["a"].example_prompts, got["a"].example_queries, got["a"].avg_execution_ms) == (["p1", "p2"], ["q"], 2.0)
    assert knowledge.pattern_examples(kb).count() == 5


def test_changes_between(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "id string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("d", 4), ("c", None)], "id string, v int")
    assert sorted((r.id, r.action, r.v) for r in state.changes_between(old, new).collect()) == [("b", "UPDATE", 3), ("d", "INSERT", 4)]


# ------------------------------------------------------------------------ text
def test_agent_log(spark):
    lines = spark.createDataFrame(
        [("s", T0, '{"type":"tool_use","tool":"grep","parameters":{"a":1}}'), ("s", T0, '{"type":"tool_use"}'), ("s", T0, "oops"),
         ("s", T0 + dt.timedelta(seconds=2), '{"type":"error"}'), ("s", T0, '{"type":"other"}')],
        "session_id string, ts timestamp_ntz, value string")
    rows = text.parse_agent_log(lines).collect()
    calls = sorted((r.tool_name, r.parameters, r.result_type) for r in rows if r.kind == "tool_call")
    assert calls == [("error", '{"error":"Unknown error"}', "error"), ("grep", '{"a":1}', "success"), ("unknown", "{}", "success")]
    end = next(r for r in rows if r.kind == "session_end")
    assert (end.total_activities, end.session_duration_ms) == (2, 2000)
    assert sum(r.kind == "session_start" for r in rows) == 1


@pytest.mark.parametrize("answer,sql,unsafe", [
    ("```sql\nSELECT 1\n```", "SELECT 1", False),
    ("Here:\nSELECT a\nFROM b;\nbye", "SELECT a\nFROM b;", False),
    ("WITH x AS (SELECT 1)\nSELECT * FROM x", "WITH x AS (SELECT 1)\nSELECT * FROM x", False),
    ("delete\n```sql\ndrop table x\n```", "drop table x", True),
    ("DELETE\nFROM x;", "DELETE\nFROM x;", False),
    ("UPDATE x SET a = 1;", "UPDATE x SET a = 1;", True),
    ("no sql here", None, False),
])
def test_screen_generated_sql(spark, answer, sql, unsafe):
    row = text.screen_generated_sql(spark.createDataFrame([(answer,)], "answer string")).first()
    assert (row.generated_sql, row.is_unsafe) == (sql, unsafe)


@pytest.mark.parametrize("answer", [
    "```sql\nSELECT 1\n```\ntext\n```sql\nDROP TABLE t\n```",
    "SELECT 1;\ntext\nDELETE FROM t;",
    "```sql\n" + "\n".join(["SELECT 1"] * 60) + "\nDROP TABLE t\n```",
])
def test_generated_sql_is_screened_as_a_whole(spark, answer):
    row = text.screen_generated_sql(spark.createDataFrame([(answer,)], "answer string")).first()
    assert row.is_unsafe and ("DROP TABLE t" in row.generated_sql or "DELETE FROM t;" in row.generated_sql)


def test_validation_covers_every_id(spark):
    def table(ids):
        return spark.createDataFrame([(i, dt.datetime(2024, 1, 1)) for i in ids], "activity_id string, ts timestamp_ntz")

    def status(a, b):
        return {r.check_name: r.match_status for r in quality.migration_validation(table(a), table(b)).collect()}

    ids = [f"id{i}" for i in range(300)]
    assert set(status(ids, ids[::-1]).values()) == {"MATCH"}
    assert status(ids, [*ids[:-1], "other"])["id_digest"] == "MISMATCH"


def test_windows_end_at_as_of(spark):
    from tidelog.functions import bound, since, span

    now = "2024-01-31 12:00:00"
    rows = spark.sql("SELECT timestamp_ntz'2024-01-31 11:30:00' AS ts, date'2024-01-31' AS dt UNION ALL SELECT timestamp_ntz'2024-01-31 12:00:01', date'2024-01-31' "
                     "UNION ALL SELECT timestamp_ntz'2024-02-01 00:00:00', date'2024-02-01'")
    assert since(rows, bound(now) - span(hours=1), to=bound(now)).count() == 1


def test_numbering_keeps_null_buckets(spark):
    from tidelog.plans.prefix import running_number

    rows = spark.createDataFrame([("a", 1), ("a", None), (None, 2), ("a", 2)], "k string, t int")
    got = running_number(rows, ["k"], ["t"], F.col("t"), "n").collect()
    assert sorted((r.k or "", r.t or 0, r.n) for r in got) == [("", 2, 1), ("a", 0, 1), ("a", 1, 2), ("a", 2, 3)]


@pytest.mark.parametrize("tokens,cost", [(50, 0.000002), (30, 0.000001), (0, 0.0), (1_000_000, 0.04)])
def test_token_cost_is_cut(spark, tokens, cost):
    assert spark.range(1).select(token_cost(F.lit(tokens))).first()[0] == pytest.approx(cost, abs=1e-12)


# --------------------------------------------------------------------- sources
def test_read_ndjson(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text(
        '{"activity_id":"1","ts":"2024-01-01T12:00:00Z","activity":"x","customer":"c","feature_json":{"a":1},"revenue_impact":2}\n'
        'broken\n{"activity":"no id"}\n\n{"activity_id":"2","activity":"x","customer":"c"}\n')
    rows = {r.activity_id: r for r in ndjson.read_ndjson(spark, str(tmp_path), DAY).collect()}
    assert set(rows) == {"1", "2"}
    assert (rows["1"].ts, rows["1"].feature_json, rows["1"].revenue_impact) == (T0, '{"a":1}', 2.0)
    assert (rows["2"].ts, rows["2"].feature_json, rows["2"].revenue_impact, rows["2"].anonymous_customer_id, rows["2"].link) == (
        dt.datetime(2024, 1, 31), "{}", 0.0, "unknown", None)


def test_enrich_and_degrade(spark):
    df = stream(spark, [(None, T0, "x", "c", "x" * 2000), ("1", T0, "x", "c", "{}")])
    assert all(r.activity_id for r in ndjson.enrich_events(df).collect())
    rows = ndjson.degrade_events(df, 130_000).orderBy(F.length("feature_json")).collect()
    assert [(r.degraded, r._truncated, r._original_size) for r in rows] == [(True, False, None), (True, True, 2000)]
    assert not ndjson.degrade_events(df, 1_000).first().degraded


def test_stream_table_prunes(spark, sf_dir, tmp_path):
    path = str(tmp_path / "table")
    write_stream(load(spark, sf_dir, "stream_v2"), path)
    table = read_stream(spark, path)
    assert table.count() == load(spark, sf_dir, "stream_v2").count()
    plan = product.product_metrics(table, "2024-01-10", days=2)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "GreaterThan(ts," in plan
    append_new(load(spark, sf_dir, "stream_v2"), path, same_day=True)
    assert read_stream(spark, path).count() == table.count()


@pytest.mark.parametrize("kind", ["json", "csv", "parquet"])
def test_write_result(spark, tmp_path, kind):
    write_result(spark.range(3), str(tmp_path / kind), kind)
    reader = spark.read.option("header", True) if kind == "csv" else spark.read
    assert getattr(reader, kind)(str(tmp_path / kind)).count() == 3


def test_backpressure_edges(spark):
    minute = dt.timedelta(minutes=1)
    hour = dt.timedelta(hours=1)
    rows = [("h", T0, "f1", T0 - 3 * minute), ("h", T0 + hour, "f2", T0), ("h", T0 + 2 * hour, "f3", T0 + 2 * hour - minute),
            ("h", T0 + 3 * hour, "f4", T0), ("h", T0 + 6 * hour, "f5", T0)]
    df = spark.createDataFrame(rows, "host string, checked_at timestamp_ntz, file string, marked_at timestamp_ntz")
    assert sorted(r.ts for r in ndjson.backpressure_events(df).collect()) == [T0, T0 + 3 * hour, T0 + 6 * hour]


def test_artifact_profile_without_schema(spark):
    rows = spark.createDataFrame([("a", i, f'{{"id":{i},"name":"n{i}"}}') for i in range(12)], "artifact_id string, i int, row_json string")
    row = artifacts.artifact_profile(rows, ["i"], F.floor(F.col("i") / 5), DAY).first()
    whole = "[" + ",".join(f'{{"id":{i},"name":"n{i}"}}' for i in range(12)) + "]"
    assert (row.row_count, row.column_count, row.total_bytes, row.row_group_bytes, row.is_external) == (12, 2, len(whole), [len(whole)], False)
    assert len(row.sample_rows) == 10
    assert row.content_schema == '[{"name":"id","type":"number","nullable":true},{"name":"name","type":"string","nullable":true}]'


def test_large_sample_is_cut(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    rows = spark.createDataFrame([("a", i, f'{{"id":{i},"t":"{"x" * 20000}"}}') for i in range(10)], "artifact_id string, i int, row_json string")
    row = artifacts.artifact_profile(rows, ["i"], F.lit(0), DAY, schema=schema, page_list=False).first()
    assert row.sample_chars > vocab.SAMPLE_MAX_CHARS and row.sample_rows[0] == f'{{"id":0,"t":"{"x" * 100}..."}}'


def test_contract_violations(spark):
    rows = [("1", T0, "tool_call", "c", '{"tool_name":5,"success":null,"tool_category":"nope","parameters":"{\\"a\\":1}"}'),
            ("2", T0, "tool_call", "c", '{"tool_name":"t","success":true,"tool_category":"file","parameters":{"a":1},"latency_ms":1.5}'),
            ("3", T0, "mcp_call", "c", "broken"), ("4", T0, "unknown", "c", "{}")]
    got = sorted((r.activity_id, r.field, r.violation) for r in quality.validate_events(stream(spark, rows)).collect())
    assert got == [("1", "parameters", "wrong_type"), ("1", "success", "missing"), ("1", "tool_category", "not_allowed"),
                   ("1", "tool_name", "wrong_type"), ("3", "latency_ms", "missing"), ("3", "method", "missing")]


def test_every_fixture_loads(spark, sf_dir):
    assert all(load(spark, sf_dir, name).limit(1).count() == 1 for name in TABLES)


@pytest.mark.parametrize("name", ["a5_tool_usage", "a6_error_analysis", "a7_project_activity", "a19_daily_user_metrics", "p13c_query_questions"])
def test_payload_is_parsed_once(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert sum(line.count("from_json") for line in plan) == 1


def test_context_pages_are_bounded(spark):
    schema = "customer string, section string, key string, n bigint, text string, confidence double, artifact_id string, valid_until timestamp_ntz, " \
             "warehouse string, ts timestamp_ntz, place int, avg_latency_ms double, p95_latency_ms double"
    rows = [("busy", "insights", f"k{i}", None, str(i), 0.5, None, None, None, None, None, None, None) for i in range(1234)]
    rows += [(f"c{i}", "activities", "x", i, None, None, None, None, None, None, None, None, None) for i in range(30)]
    entries = spark.createDataFrame(rows, schema)
    pages = state.context_pages(entries, page_rows=100)
    sizes = {(r.customer, r.page): len(r.entries) for r in pages.collect()}
    assert max(sizes.values()) == 100 and sum(sizes.values()) == 1264 and len([k for k in sizes if k[0] == "busy"]) == 13
    back = pages.select("customer", F.inline("entries"))
    assert back.exceptAll(entries.select(back.columns)).isEmpty() and entries.select(back.columns).exceptAll(back).isEmpty()


def _plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def test_backfill_by_day_prunes_both_tables_and_shuffles_each_once(spark, tmp_path):
    rows = [(f"a{i}", dt.datetime(2024, 1, 1 + i % 9), "x", "c", "h", None, 0.0, None) for i in range(90)] + [(None, dt.datetime(2024, 1, 4), "y", "c", "h", None, 0.0, None)] * 2
    write_stream(spark.createDataFrame(rows, STREAM), str(tmp_path / "old"))
    write_stream(spark.createDataFrame(rows[::2], STREAM).where("activity_id IS NOT NULL"), str(tmp_path / "new"))
    old, new = (read_stream(spark, str(tmp_path / x)) for x in ("old", "new"))
    out = state.backfill_rows(old, new, "2024-01-03", "2024-01-05", same_day=True)
    want = {r[0] for i, r in enumerate(rows) if r[0] and i % 2 and 3 <= r[1].day <= 5}
    got = [r.activity_id for r in out.collect()]
    assert len(got) == len(set(got)) == len(want) + 1 and want < set(got)
    plan = _plan(out)
    filters = [x for x in plan.splitlines() if x.startswith("PartitionFilters")]
    assert len(filters) == 2 and all("2024-01-03" in x and "2024-01-05" in x for x in filters)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _plan(out.select("*"), "simple").count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # a copy that lies on another day counts where all days are looked through
    assert {r.activity_id for r in state.backfill_rows(old, new.withColumn("ts", F.col("ts") + F.expr("INTERVAL 30 DAYS")).drop("dt"), "2024-01-03", "2024-01-05").collect()} == set(got)


@pytest.mark.parametrize("name", ["executive_summary", "user_adoption", "tool_usage", "project_activity"])
def test_distinct_counts_copy_partial_rows_only(spark, sf_dir, name):
    stream = load(spark, sf_dir, "activity_stream")
    build = {"executive_summary": lambda **k: executive.executive_summary(stream, DAY, **k)}.get(name, lambda **k: getattr(executive, name)(stream, **k))
    lines = build()._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = [i for i, x in enumerate(lines) if "Expand [" in x]
    assert at and all("Aggregate [" in lines[i + 1] or "Project [" in lines[i + 1] and "Aggregate [" in lines[i + 2] for i in at)
    assert not any("Expand [" in x for x in build(approx=True)._jdf.queryExecution().optimizedPlan().toString().splitlines())


def test_deviation_from_sums(spark):
    rows = spark.createDataFrame([("a", "s1", 3), ("a", "s1", 10**9), ("a", "s2", None), ("b", "s1", 4), ("a", "s3", 7)], "tool string, s string, ms long")
    sums = partial(rows, ("tool", "s"), {"n": F.count("ms"), "t": F.sum("ms"), "q": F.sum(F.col("ms").cast("decimal(19,0)") * F.col("ms").cast("decimal(19,0)"))})
    got = {r.tool: r.d for r in sums.groupBy("tool").agg(deviation("t", "q", "n").alias("d")).collect()}
    want = {r.tool: r.d for r in rows.groupBy("tool").agg(F.stddev("ms").alias("d")).collect()}
    assert got["b"] is None and want["b"] is None and abs(got["a"] - want["a"]) < 1e-3


def test_templates_by_rating_then_time(spark):
    kb = [(f"cost {i}", "q", 1, t, T0, True, r) for i, (r, t) in enumerate([("good", 5), (None, 1), ("excellent", 9), ("good", 2), ("poor", 0), ("excellent", 3)])]
    kb = spark.createDataFrame(kb, "user_prompt string, generated_query string, result_count int, execution_time_ms long, created_ts timestamp_ntz, query_success boolean, user_rating string").repartition(3)
    assert [r.execution_time_ms for r in knowledge.executive_templates(kb).collect()] == [3, 9, 2, 5, 0, 1]
    assert "Sort [" not in _plan(knowledge.executive_templates(kb, ordered=False), "simple")


def test_periods_in_their_order(spark, sf_dir):
    rows = dashboard.period_metrics(load(spark, sf_dir, "activity_stream"), "2024-01-30 12:00:00").collect()
    assert [r[0] for r in rows] == list(dashboard.PERIODS)


def test_views_without_order(spark, sf_dir):
    stream, meta = load(spark, sf_dir, "activity_stream"), load(spark, sf_dir, "meta_stream")
    for build in (lambda **k: views.recent_activities(stream, DAY, **k), lambda **k: views.todays_activities(stream, DAY, **k), lambda **k: views.meta_queries(meta, **k)):
        assert "Sort [" in _plan(build(), "simple") and "Sort [" not in _plan(build(ordered=False), "simple")
