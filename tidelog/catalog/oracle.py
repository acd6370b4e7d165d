"""The same results as DuckDB SQL, for the side-by-side check."""

from __future__ import annotations

from ..sources.fixtures import TABLES
from .queries import DAY, HALF, HOST, HOUR, JOBS_AS_OF, STUDY

_NEEDS = {"insight_atoms_later": ("insight_atoms",)}
ORACLE: dict[str, str] = {}


def t(field: str, column: str = "feature_json") -> str:
    """Payload field as text."""
    return f"json_extract_string({column}, '$.{field}')"


def n(field: str, column: str = "feature_json") -> str:
    """Payload field as whole number."""
    return f"CAST(TRY_CAST({t(field, column)} AS DECIMAL(38,0)) AS BIGINT)"


def d(field: str) -> str:
    return f"TRY_CAST({t(field)} AS DOUBLE)"


def b(field: str) -> str:
    return f"TRY_CAST({t(field)} AS BOOLEAN)"


def when(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def stable_id(at: str, *columns: str) -> str:
    """The hash of an instant and values, as the text of a JSON object without its NULLs."""
    parts = "".join(f" || COALESCE(',\"p{i}\":' || CAST(to_json({c}) AS VARCHAR), '')" for i, c in enumerate(columns, 1))
    return f"md5('{{\"p0\":\"{at.replace(' ', 'T')}.000\"'{parts} || '}}')"


def averages(sql: str) -> str:
    """``ROUND(AVG(x), d)`` by decimal arithmetic: a double on the edge, such as
    0.0635695, is rounded alike on both engines."""
    head, mark, tail = sql.partition("ROUND(AVG(")
    if not mark:
        return sql
    depth, end = 1, 0
    while depth:
        depth += {"(": 1, ")": -1}.get(tail[end], 0)
        end += 1
    inner, rest = tail[: end - 1], tail[end:]
    if not rest.startswith(", "):  # a window follows the aggregate
        return head + mark + averages(tail)
    digits, _, rest = rest[2:].partition(")")
    return f"{head}{money(f'AVG({inner})', int(digits))}{averages(rest)}"


def add(name: str, tables: str, body: str) -> None:
    """Registers ``body`` below the CTEs of the named stream tables.

    A body that begins with a comma goes on with further CTEs.
    """
    names: list[str] = []
    for table in tables.split():
        for need in (*_NEEDS.get(table, ()), table):
            if need not in names:
                names.append(need)
    body = averages(body)
    ctes = ",\n".join(f"{table} AS ({TABLES[table]})" for table in names)
    ORACLE[name] = f"WITH {ctes}\n{body}" if not body.lstrip().startswith(",") else f"WITH {ctes}{body}"


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def pct(part: str, total: str, digits: int) -> str:
    return f"ROUND(CAST({part} AS DOUBLE) * 100.0 / NULLIF({total}, 0), {digits})"


def money(value: str, digits: int) -> str:
    """Rounding of a sum of doubles, free of noise in the last bits."""
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,{digits + 6})), {digits}) AS DOUBLE)"


CORE = "activity_id, ts, customer, anonymous_customer_id"
IN_STREAM = "activity LIKE 'claude_%'"

# ------------------------------------------------------------------- views (P)
add("p1_stream_activities", "activity_stream", f"""
SELECT activity_id, ts, activity, customer AS session_id, anonymous_customer_id AS host_id,
 {t('tool_name')} AS tool_name, {t('command')} AS command, {t('parameters')} AS parameters, {t('result_type')} AS result_type,
 {t('error_message')} AS error_message, {n('duration_ms')} AS duration_ms, {n('tokens_used')} AS tokens_used,
 ROUND({d('confidence_score')}, 6) AS confidence_score, {t('project_path')} AS project_path, {t('git_branch')} AS git_branch,
 {t('file_path')} AS file_path, feature_json, ROUND(revenue_impact, 6) AS revenue_impact, link
FROM activity_stream WHERE activity LIKE 'claude_%' OR activity LIKE 'ccode_%'""")
add("p2_recent_activities", "activity_stream", f"""
SELECT activity_id, ts, activity, customer, anonymous_customer_id, feature_json, ROUND(revenue_impact, 6) AS revenue_impact, link,
 date_diff('second', ts, {when(DAY)}) AS seconds_ago, date_diff('minute', ts, {when(DAY)}) AS minutes_ago
FROM activity_stream WHERE ts >= {when(DAY)} - INTERVAL 24 HOUR AND ts <= {when(DAY)}""")
add("p3_sql_events", "stream_v2 query_history", f"""
SELECT cs.activity_id, cs.ts, cs.customer, cs.anonymous_customer_id, {t('query_id')} AS query_id, {t('sql')} AS sql_text,
 {t('warehouse')} AS warehouse, {t('role')} AS role, {t('database')} AS database, {t('schema')} AS schema,
 {n('rows')} AS rows_returned, {n('bytes_scanned')} AS bytes_scanned, {n('duration_ms')} AS duration_ms,
 ROUND({d('credits_used')}, 6) AS credits_used, {b('success')} AS success, {t('error')} AS error_message,
 {t('error_code')} AS error_code, cs.link AS artifact_id, qh.query_id AS history_query_id, qh.query_text AS actual_query_text,
 qh.database_name AS actual_database, qh.schema_name AS actual_schema, qh.warehouse_name AS actual_warehouse,
 qh.warehouse_size, qh.warehouse_type, qh.bytes_scanned AS history_bytes_scanned, qh.bytes_written,
 qh.rows_produced AS history_rows_produced, qh.rows_inserted, qh.rows_updated, qh.rows_deleted,
 ROUND(qh.credits_used_cloud_services, 6) AS history_credits, qh.execution_time AS history_execution_time_ms,
 qh.compilation_time, qh.queued_provisioning_time, qh.queued_repair_time, qh.queued_overload_time,
 qh.list_external_files_time, qh.error_code AS history_error_code, qh.error_message AS history_error_message,
 ROUND(COALESCE(cs.revenue_impact, qh.credits_used_cloud_services * 0.00003), 6) AS total_cost_usd,
 CASE WHEN {b('success')} THEN 'success' WHEN qh.error_code IS NOT NULL THEN 'failed'
  WHEN cs.link IS NOT NULL THEN 'completed' ELSE 'unknown' END AS status
FROM stream_v2 cs LEFT JOIN query_history qh ON qh.query_tag = 'cdesk:' || {t('query_id')}
 AND qh.start_time >= cs.ts - INTERVAL 5 MINUTE AND qh.start_time <= cs.ts + INTERVAL 5 MINUTE
WHERE cs.activity IN ('query_complete', 'query_submitted', 'sql_execution', 'claude_sql_execution')""")
add("p4_llm_events", "stream_v2", f"""
SELECT {CORE}, {t('model')} AS model, {t('prompt_hash')} AS prompt_hash, {n('prompt_tokens')} AS prompt_tokens,
 {n('completion_tokens')} AS completion_tokens, {n('total_tokens')} AS total_tokens, {n('latency_ms')} AS time_to_first_token_ms,
 {n('total_latency_ms')} AS total_latency_ms, ROUND({d('cost_usd')}, 6) AS cost_usd, ROUND({d('temperature')}, 6) AS temperature,
 {n('max_tokens')} AS max_tokens, {b('stream')} AS is_streamed, link AS artifact_id,
 ROUND(COALESCE({d('cost_usd')}, revenue_impact, CASE
   WHEN {t('model')} LIKE '%opus%' THEN ({n('prompt_tokens')} * 0.015::DOUBLE + {n('completion_tokens')} * 0.075::DOUBLE) / 1000
   WHEN {t('model')} LIKE '%sonnet%' THEN ({n('prompt_tokens')} * 0.003::DOUBLE + {n('completion_tokens')} * 0.015::DOUBLE) / 1000
   WHEN {t('model')} LIKE '%haiku%' THEN ({n('prompt_tokens')} * 0.00025::DOUBLE + {n('completion_tokens')} * 0.00125::DOUBLE) / 1000
   ELSE 0 END), 6) AS estimated_cost_usd,
 CASE WHEN {n('latency_ms')} < 300 THEN 'fast' WHEN {n('latency_ms')} < 1000 THEN 'normal' ELSE 'slow' END AS latency_category
FROM stream_v2 WHERE activity IN ('user_asked', 'claude_responded', 'llm_call', 'llm_response')""")
add("p5_tool_events", "stream_v2", f"""
SELECT {CORE}, {t('tool_name')} AS tool_name, {t('tool_category')} AS tool_category, {t('parameters')} AS parameters,
 {b('success')} AS success, {n('latency_ms')} AS latency_ms, {t('error')} AS error_message, {n('result_size')} AS result_size_bytes,
 {t('result_type')} AS result_type, {t('tool_name')} AS tool_name_normalized,
 CASE WHEN {n('latency_ms')} < 25 THEN 'excellent' WHEN {n('latency_ms')} < 100 THEN 'good'
  WHEN {n('latency_ms')} < 500 THEN 'acceptable' ELSE 'poor' END AS performance_tier,
 CAST(CASE WHEN {b('success')} THEN 1 ELSE 0 END AS BIGINT) AS success_flag
FROM stream_v2 WHERE activity IN ('claude_tool_call', 'tool_call', 'tool_execution')""")
add("p6_file_events", "stream_v2", f"""
SELECT {CORE}, {t('operation')} AS operation, {t('file_path')} AS file_path, {t('file_type')} AS file_type,
 {n('lines_affected')} AS lines_affected, {n('bytes_before')} AS bytes_before, {n('bytes_after')} AS bytes_after,
 {b('success')} AS success, {b('git_tracked')} AS git_tracked, {t('git_branch')} AS git_branch,
 COALESCE(link, 'file://' || {t('file_path')}) AS file_link, {n('bytes_after')} - {n('bytes_before')} AS bytes_changed,
 CASE {t('operation')} WHEN 'create' THEN 'write' WHEN 'write' THEN 'write' WHEN 'read' THEN 'read' WHEN 'edit' THEN 'modify'
  WHEN 'delete' THEN 'delete' WHEN 'rename' THEN 'delete' ELSE 'other' END AS operation_category
FROM stream_v2 WHERE activity IN ('claude_file_operation', 'file_op', 'file_operation')""")
add("p7_session_events", "stream_v2", f"""
SELECT activity_id, ts, customer AS session_id, anonymous_customer_id, {t('event_type')} AS event_type,
 {t('project_path')} AS project_path, {t('user')} AS "user", {t('host')} AS host, {t('cli_version')} AS cli_version,
 {n('total_activities')} AS total_activities, {n('total_tokens')} AS total_tokens, {n('session_duration_ms')} AS session_duration_ms,
 CASE activity WHEN 'claude_session_start' THEN 'started' WHEN 'claude_session_end' THEN 'completed'
  WHEN 'claude_context_hydration' THEN 'hydrating' ELSE 'active' END AS session_status,
 ROUND(COALESCE(revenue_impact, {n('total_tokens')} * 0.000003::DOUBLE), 6) AS session_cost_usd
FROM stream_v2 WHERE activity IN ('claude_session_start', 'claude_session_end', 'session_heartbeat', 'claude_context_hydration')""")
add("p8_mcp_events", "stream_v2", f"""
SELECT {CORE}, {t('method')} AS method, {b('cache_hit')} AS cache_hit, {n('cache_age_ms')} AS cache_age_ms,
 {n('latency_ms')} AS latency_ms, {b('stale')} AS is_stale_while_revalidate, {n('context_size')} AS context_size_bytes,
 CASE WHEN {n('latency_ms')} <= 25 THEN 'within_slo' ELSE 'slo_breach' END AS latency_slo_status,
 CASE WHEN {b('cache_hit')} AND {n('cache_age_ms')} < 30000 THEN 'fresh_hit' WHEN {b('cache_hit')} AND {b('stale')} THEN 'stale_hit'
  WHEN {b('cache_hit')} THEN 'hit' ELSE 'miss' END AS cache_status
FROM stream_v2 WHERE activity IN ('mcp_call', 'get_context', 'refresh_context', 'store_artifact')""")
add("p9_system_events", "stream_v2", f"""
SELECT activity_id, ts, customer, {t('event_type')} AS event_type, {t('severity')} AS severity, {t('message')} AS message,
 {t('metrics')} AS metrics, {t('action_taken')} AS action_taken,
 CASE {t('severity')} WHEN 'critical' THEN 'unhealthy' WHEN 'error' THEN 'degraded' WHEN 'warning' THEN 'warning' ELSE 'healthy' END AS system_health,
 CAST(CASE WHEN {t('event_type')} = 'backpressure' AND {t('severity')} IN ('error', 'critical') THEN 1
  WHEN {t('event_type')} = 'schema_drift' THEN 2 WHEN {t('severity')} = 'critical' THEN 1 WHEN {t('severity')} = 'error' THEN 2
  WHEN {t('severity')} = 'warning' THEN 3 ELSE 4 END AS BIGINT) AS alert_priority
FROM stream_v2 WHERE activity IN ('system_backpressure', 'schema_drift_detected', 'queue_rotation', 'artifact_cleanup', 'error_recovery', 'system_event')""")
add("p10_activity_log", "activity_stream", f"""
SELECT ts AS time, activity, customer AS session_id, anonymous_customer_id AS "user",
 CASE activity WHEN 'claude_meta_query' THEN {t('prompt')} WHEN 'claude_tool_call' THEN {t('tool_name')}
  WHEN 'claude_file_operation' THEN {t('file_path')} END AS details
FROM (SELECT * FROM activity_stream WHERE ts >= {when(DAY)} - INTERVAL 24 HOUR AND ts <= {when(DAY)} ORDER BY ts DESC, activity_id LIMIT 100)""")
add("p11_executive_templates", "knowledge_base", """
SELECT user_prompt, generated_query, result_count, execution_time_ms, created_ts FROM knowledge_base
WHERE query_success AND (lower(user_prompt) LIKE '%executive%' OR lower(user_prompt) LIKE '%cost%' OR lower(user_prompt) LIKE '%metric%'
 OR lower(user_prompt) LIKE '%dashboard%' OR lower(user_prompt) LIKE '%summary%')""")
PATTERN = """CASE WHEN lower(user_prompt) LIKE '%orphan%' THEN 'orphan_analysis' WHEN lower(user_prompt) LIKE '%cost%' THEN 'cost_analysis'
 WHEN lower(user_prompt) LIKE '%session%' THEN 'session_analysis' WHEN lower(user_prompt) LIKE '%tool%' THEN 'tool_usage'
 WHEN lower(user_prompt) LIKE '%metric%' OR lower(user_prompt) LIKE '%executive%' THEN 'executive_metrics'
 WHEN lower(user_prompt) LIKE '%trend%' OR lower(user_prompt) LIKE '%time%' THEN 'trend_analysis' ELSE 'general_query' END"""
add("p12_classify_prompts", "knowledge_base", f"SELECT *, {PATTERN} AS common_pattern FROM knowledge_base")
META = f"SELECT ts, customer AS session_id, {t('prompt')} AS question, "
add("p13_meta_queries", "meta_stream",
    f"{META} left({t('query_generated')}, 100) AS sql_text FROM meta_stream WHERE activity = 'claude_meta_query'")
add("p13b_recent_meta_queries", "meta_stream", f"""{META} {t('query_generated')} AS sql_text FROM meta_stream
WHERE activity = 'claude_meta_query' AND ts > {when(DAY)} - INTERVAL 24 HOUR AND ts <= {when(DAY)}""")
add("p13c_query_questions", "meta_stream", f"""{META} left({t('query_generated')}, 100) AS sql_text FROM meta_stream
WHERE activity = 'claude_meta_query' AND {t('prompt')} LIKE '%query%'""")
add("p14_todays_activities", "activity_stream", f"""
SELECT * REPLACE (ROUND(revenue_impact, 6) AS revenue_impact) FROM activity_stream WHERE CAST(ts AS DATE) = CAST({when(HOUR)} AS DATE)""")
add("p15_screen_generated_sql", "model_answers", r"""
, found AS (SELECT answer_id, answer, regexp_extract_all(answer, '(?s)```sql[^\n]*\n(.*?)\n?```', 1) AS fenced,
  regexp_extract_all(answer, '(?sm)^((?:SELECT|WITH|CREATE|INSERT|UPDATE|DELETE).*?)(?:;[ \t]*$|\z)', 0) AS bare FROM model_answers),
 cut AS (SELECT answer_id, answer, NULLIF(trim(array_to_string(CASE WHEN len(list_filter(fenced, lambda x: x <> '')) > 0 THEN list_filter(fenced, lambda x: x <> '') ELSE bare END, chr(10))), '') AS generated_sql FROM found)
SELECT answer_id, answer, generated_sql,
 COALESCE(regexp_matches(generated_sql, '(?i)DROP|TRUNCATE|DELETE.*FROM|UPDATE.*SET'), FALSE) AS is_unsafe FROM cut""")
add("p16_active_contexts", "context_cache", f"""
SELECT customer, context_type, context_blob, updated_at,
 CASE WHEN is_stale OR updated_at < {when(HOUR)} - INTERVAL 30 SECOND THEN 'stale' ELSE 'fresh' END AS served_as,
 date_diff('second', updated_at, {when(HOUR)}) AS age_seconds FROM context_cache""")

# ------------------------------------------------------------ aggregations (A)
add("a1_session_summary", "activity_stream", f"""
SELECT customer AS session_id, MIN(CASE WHEN activity = 'claude_session_start' THEN ts END) AS session_start,
 MAX(CASE WHEN activity = 'claude_session_end' THEN ts END) AS session_end, COUNT(*) AS total_activities,
 COUNT(DISTINCT activity) AS unique_activity_types,
 CAST(SUM(CASE WHEN activity = 'claude_tool_call' THEN 1 ELSE 0 END) AS BIGINT) AS tool_calls,
 CAST(SUM(CASE WHEN activity = 'claude_error' THEN 1 ELSE 0 END) AS BIGINT) AS errors,
 CAST(SUM({n('tokens_used')}) AS BIGINT) AS total_tokens, ROUND(SUM(revenue_impact), 6) AS total_cost,
 array_to_string(list_sort(list(DISTINCT {t('tool_name')})), ',') AS tools_used, MAX({t('project_path')}) AS project_path
FROM activity_stream WHERE {IN_STREAM} GROUP BY customer""")
add("a2_activity_stats", "activity_stream", f"""
SELECT activity, date_trunc('hour', ts) AS hour, COUNT(*) AS activity_count, COUNT(DISTINCT customer) AS unique_sessions,
 ROUND(AVG({n('duration_ms')}), 6) AS avg_duration_ms, ROUND(SUM(revenue_impact), 6) AS total_revenue_impact, MAX(ts) AS last_occurrence
FROM activity_stream GROUP BY 1, 2""")
add("a3_executive_summary", "activity_stream", f"""
SELECT CAST({when(DAY)} AS DATE) AS report_date, COUNT(DISTINCT customer) AS total_sessions,
 COUNT(DISTINCT anonymous_customer_id) AS unique_users, COUNT(*) AS total_activities,
 COUNT(*) FILTER (activity = 'claude_tool_call') AS tool_executions, COUNT(*) FILTER (activity = 'claude_file_operation') AS file_operations,
 COUNT(*) FILTER (activity = 'claude_error') AS errors_encountered, ROUND(SUM(revenue_impact), 6) AS total_cost_usd,
 ROUND(ROUND(AVG(revenue_impact), 8), 6) AS avg_cost_per_activity, COUNT(DISTINCT CAST(ts AS DATE)) AS days_active,
 COUNT(DISTINCT {t('project_path')}) AS projects_touched, COUNT(DISTINCT {t('git_branch')}) AS git_branches_worked,
 ROUND(AVG({n('duration_ms')}), 2) AS avg_response_time_ms, MAX({n('duration_ms')}) AS max_response_time_ms,
 CAST(SUM({n('tokens_used')}) AS BIGINT) AS total_tokens_consumed
FROM activity_stream WHERE {IN_STREAM} AND ts >= CAST({when(DAY)} AS DATE) - INTERVAL 30 DAY AND ts <= {when(DAY)}""")
ADOPTION = f"""
, days AS (SELECT date_trunc('day', ts) AS activity_date, COUNT(DISTINCT anonymous_customer_id) AS daily_active_users,
 COUNT(DISTINCT customer) AS daily_sessions, COUNT(*) AS daily_activities, COUNT(DISTINCT {t('tool_name')}) AS unique_tools_used,
 string_agg(DISTINCT anonymous_customer_id, ', ' ORDER BY anonymous_customer_id) AS user_list
 FROM activity_stream WHERE {IN_STREAM} GROUP BY 1),
 grown AS (SELECT *, LAG(daily_active_users) OVER (ORDER BY activity_date) AS previous_day_users FROM days)
"""
GROWTH = """ROUND((daily_active_users - previous_day_users) / NULLIF(CAST(previous_day_users AS DOUBLE), 0) * 100, 2) AS daily_growth_percentage"""
add("a4_user_adoption", "activity_stream", ADOPTION + f"""
SELECT CAST(activity_date AS TIMESTAMP) AS activity_date, daily_active_users, daily_sessions, daily_activities,
 ROUND(daily_activities / NULLIF(CAST(daily_sessions AS DOUBLE), 0), 2) AS avg_activities_per_session, unique_tools_used, user_list,
 previous_day_users, {GROWTH} FROM grown""")
add("w3_adoption_growth", "activity_stream", ADOPTION + f"""
SELECT CAST(activity_date AS TIMESTAMP) AS activity_date, daily_active_users, previous_day_users, {GROWTH} FROM grown""")
add("a5_tool_usage", "activity_stream", f"""
SELECT {t('tool_name')} AS tool_name, COUNT(*) AS usage_count, COUNT(DISTINCT customer) AS unique_sessions,
 COUNT(DISTINCT anonymous_customer_id) AS unique_users, ROUND(AVG({n('duration_ms')}), 2) AS avg_duration_ms,
 MIN({n('duration_ms')}) AS min_duration_ms, MAX({n('duration_ms')}) AS max_duration_ms,
 ROUND(STDDEV({n('duration_ms')}), 2) AS stddev_duration_ms, CAST(SUM({n('tokens_used')}) AS BIGINT) AS total_tokens,
 ROUND(AVG({n('tokens_used')}), 2) AS avg_tokens_per_call, COUNT(*) FILTER ({t('result_type')} = 'success') AS successful_calls,
 {pct(f"COUNT(*) FILTER ({t('result_type')} = 'success')", 'COUNT(*)', 2)} AS success_rate_percentage,
 ROUND(SUM(revenue_impact), 6) AS total_cost, ROUND(AVG(revenue_impact), 6) AS avg_cost_per_call, MIN(ts) AS first_used,
 MAX(ts) AS last_used, date_diff('hour', MIN(ts), MAX(ts)) AS hours_in_use
FROM activity_stream WHERE activity = 'claude_tool_call' AND {t('tool_name')} IS NOT NULL GROUP BY 1""")
add("a6_error_analysis", "activity_stream", f"""
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS error_date, {t('error_type')} AS error_type, {t('error_message')} AS error_message,
 COUNT(*) AS error_count, COUNT(DISTINCT customer) AS affected_sessions, COUNT(DISTINCT anonymous_customer_id) AS affected_users,
 string_agg(DISTINCT {t('tool_name')}, ', ' ORDER BY {t('tool_name')}) AS related_tools,
 COUNT({t('recovery_action')}) AS errors_with_recovery, MAX(ts) AS last_occurrence, MIN(ts) AS first_occurrence
FROM activity_stream WHERE activity = 'claude_error' OR {t('result_type')} = 'error' GROUP BY 1, 2, 3""")
add("a7_project_activity", "activity_stream", f"""
SELECT {t('project_path')} AS project_path, {t('git_branch')} AS git_branch, COUNT(DISTINCT customer) AS sessions,
 COUNT(DISTINCT anonymous_customer_id) AS users, COUNT(*) AS total_activities,
 COUNT(*) FILTER (activity = 'claude_tool_call') AS tool_calls, COUNT(*) FILTER (activity = 'claude_file_operation') AS file_operations,
 COUNT(DISTINCT {t('file_path')}) AS files_touched, CAST(SUM({n('lines_affected')}) AS BIGINT) AS total_lines_modified,
 MIN(ts) AS first_activity, MAX(ts) AS last_activity, date_diff('day', MIN(ts), MAX(ts)) AS project_age_days,
 ROUND(SUM(revenue_impact), 6) AS project_cost
FROM activity_stream WHERE {IN_STREAM} AND {t('project_path')} IS NOT NULL GROUP BY 1, 2""")
add("a8_orphaned_sessions", "activity_stream", f"""
, s AS (SELECT customer, MAX(CASE WHEN activity = 'claude_session_end' THEN 1 ELSE 0 END) AS has_end FROM activity_stream WHERE {IN_STREAM} GROUP BY 1)
SELECT COUNT(*) AS total_sessions, CAST(SUM(1 - has_end) AS BIGINT) AS orphaned_sessions, CAST(SUM(has_end) AS BIGINT) AS completed_sessions,
 {pct('SUM(1 - has_end)', 'COUNT(*)', 1)} AS orphan_rate_pct FROM s""")
add("a9_latest_sessions", "activity_stream", f"""
, s AS (SELECT customer AS session_id, MIN(ts) AS session_start, MAX(ts) AS last_activity, MAX({t('project_path')}) AS project_directory,
 COUNT(*) AS activity_count FROM activity_stream WHERE {IN_STREAM} GROUP BY 1 ORDER BY session_start DESC, session_id LIMIT 20)
SELECT session_id, session_start, last_activity, date_diff('minute', session_start, last_activity) AS duration_minutes, project_directory,
 CASE WHEN project_directory LIKE '%proj3%' THEN 'self_study' WHEN project_directory LIKE '%proj5%' THEN 'assistant_project' ELSE 'other' END AS work_label,
 activity_count, CASE WHEN session_start > TIMESTAMP '2024-01-30 23:40:00' THEN 'current' ELSE '' END AS session_marker FROM s""")
add("a10_system_evolution", "activity_stream", """
, s AS (SELECT CAST(ts AS DATE) AS day, COUNT(DISTINCT activity) AS unique_activity_types, COUNT(*) AS total_events,
 COUNT(DISTINCT customer) AS unique_sessions, COUNT(DISTINCT anonymous_customer_id) AS unique_users,
 string_agg(DISTINCT activity, ', ' ORDER BY activity) AS activities_logged
 FROM activity_stream WHERE activity LIKE 'claude_%' OR activity LIKE 'ccode_%' GROUP BY 1)
SELECT *, CASE WHEN unique_activity_types <= 2 THEN 'phase1' WHEN unique_activity_types <= 4 THEN 'phase2'
 WHEN unique_activity_types <= 6 THEN 'phase3' ELSE 'phase4' END AS maturity_level FROM s""")
add("a11_pattern_discovery", "activity_stream", f"""
, s AS (SELECT hour(ts) AS hour_of_day, left(dayname(ts), 3) AS day_of_week, COUNT(*) AS activity_count, COUNT(DISTINCT customer) AS session_count
 FROM activity_stream WHERE {IN_STREAM} GROUP BY 1, 2 ORDER BY activity_count DESC, hour_of_day, day_of_week LIMIT 20)
SELECT *, CASE WHEN hour_of_day BETWEEN 9 AND 17 THEN 'business' WHEN hour_of_day BETWEEN 18 AND 23 THEN 'evening'
 WHEN hour_of_day BETWEEN 0 AND 8 THEN 'early' ELSE 'unusual' END AS time_pattern FROM s""")
add("a12_cost_by_day", "activity_stream", f"""
, s AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS activities, SUM(revenue_impact) AS cost, CAST(SUM({n('tokens_used')}) AS BIGINT) AS reported_tokens,
 SUM({n('session_duration_ms')}) / 1000.0 AS secs FROM activity_stream WHERE {IN_STREAM} GROUP BY 1)
SELECT day, activities, ROUND(cost, 6) AS calculated_cost, reported_tokens, ROUND(CAST(secs AS DOUBLE), 6) AS total_seconds,
 {money('cost * 1000000', 2)} AS cost_in_microdollars,
 CASE WHEN cost = 0 THEN 'none' WHEN cost < 0.01 THEN 'efficient' WHEN cost < 0.10 THEN 'normal' ELSE 'heavy' END AS cost_assessment FROM s""")


def period(label: str, condition: str) -> str:
    return f"""SELECT '{label}' AS period, COUNT(DISTINCT customer) AS sessions, COUNT(DISTINCT anonymous_customer_id) AS users,
 COUNT(*) AS activities, COALESCE({money('SUM(revenue_impact) * 1000', 2)}, 0) AS cost_dollars FROM activity_stream WHERE {condition}"""


add("a13_period_metrics", "activity_stream", " UNION ALL ".join([
    period("Today", "CAST(ts AS DATE) = DATE '2024-01-30'"),
    period("This Week", "ts >= DATE '2024-01-30' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-30 12:00:00'"),
    period("This Month", "ts >= DATE '2024-01-30' - INTERVAL 1 MONTH AND ts <= TIMESTAMP '2024-01-30 12:00:00'")]))
add("a14_daily_trend", "activity_stream", """
SELECT CAST(ts AS DATE) AS day, COUNT(DISTINCT customer) AS sessions, COUNT(DISTINCT anonymous_customer_id) AS users, COUNT(*) AS activities
FROM activity_stream WHERE ts >= DATE '2024-01-31' - INTERVAL 30 DAY AND ts <= TIMESTAMP '2024-01-31 00:00:00' GROUP BY 1""")
add("a15_top_users", "activity_stream", f"""
SELECT anonymous_customer_id AS user_name, COUNT(DISTINCT customer) AS sessions_this_week, COUNT(*) AS activities_this_week,
 COALESCE({money('SUM(revenue_impact) * 1000', 2)}, 0) AS cost_this_week
FROM activity_stream WHERE ts >= DATE '2024-01-31' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-31 00:00:00' GROUP BY 1 ORDER BY sessions_this_week DESC, user_name LIMIT 10""")
add("a16_health_check", "activity_stream", f"""
, c AS (SELECT COUNT(DISTINCT customer) AS current_sessions, 12 AS h FROM activity_stream WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' AND ts <= TIMESTAMP '2024-01-30 12:40:00'),
 hours AS (SELECT date_trunc('hour', ts) AS hour, COUNT(DISTINCT customer) AS k FROM activity_stream
  WHERE ts >= CAST({when(HOUR)} AS DATE) - INTERVAL 7 DAY AND ts < date_trunc('hour', {when(HOUR)}) GROUP BY 1),
 base AS (SELECT extract(hour FROM hour) AS h, AVG(k) AS mean, STDDEV(k) AS spread FROM hours GROUP BY 1)
SELECT CASE WHEN current_sessions < mean - 2 * COALESCE(spread, 0) THEN 'low' WHEN current_sessions > mean + 2 * COALESCE(spread, 0) THEN 'high'
 ELSE 'normal' END AS status, current_sessions, ROUND(mean, 1) AS typical_sessions,
 ROUND((current_sessions - mean) / NULLIF(mean, 0) * 100, 1) AS percent_difference FROM c LEFT JOIN base USING (h)""")
USAGE = f"""
, by_day AS (SELECT CAST(ts AS DATE) AS date, anonymous_customer_id AS user_machine, split_part(anonymous_customer_id, '.', 1) AS "user",
 COUNT(DISTINCT CASE WHEN activity = 'claude_session_start' THEN customer END) AS sessions,
 CAST(SUM(CASE WHEN activity = 'claude_session_end' THEN COALESCE({n('total_tokens')}, 0) ELSE 0 END) AS BIGINT) AS tokens_used,
 CAST(SUM(CASE WHEN activity = 'claude_file_operation' AND {t('operation')} IN ('create', 'edit', 'write') THEN COALESCE({n('lines_affected')}, 0) ELSE 0 END) AS BIGINT) AS lines_written,
 COUNT(*) FILTER (activity = 'claude_tool_call') AS tools_used
 FROM activity_stream WHERE activity IN ('claude_session_start', 'claude_session_end', 'claude_file_operation', 'claude_tool_call') GROUP BY 1, 2, 3),
 priced AS (SELECT *, CAST(ROUND(tokens_used * 0.000003, 4) AS DOUBLE) AS estimated_cost_usd FROM by_day)
"""
add("a17_usage_by_day", "activity_stream", USAGE + "SELECT * FROM priced")
add("a18_usage_summary", "activity_stream", USAGE + """
SELECT "user", COUNT(DISTINCT date) AS active_days, CAST(SUM(sessions) AS BIGINT) AS total_sessions, CAST(SUM(tokens_used) AS BIGINT) AS total_tokens,
 CAST(SUM(lines_written) AS BIGINT) AS total_lines_written, CAST(SUM(tools_used) AS BIGINT) AS total_tools_used,
 ROUND(AVG(tokens_used), 0) AS avg_tokens_per_day, ROUND(AVG(lines_written), 0) AS avg_lines_per_day,
 ROUND(SUM(estimated_cost_usd), 6) AS total_cost_usd FROM priced GROUP BY 1""")
add("a19_daily_user_metrics", "activity_stream", f"""
, x AS (SELECT *, CAST(ts AS DATE) AS date, COALESCE({t('user')}, anonymous_customer_id) AS username FROM activity_stream),
 tok AS (SELECT date, username, SUM(COALESCE({n('total_tokens')}, 0)) AS tokens FROM x WHERE activity = 'claude_session_end' GROUP BY 1, 2),
 lin AS (SELECT date, username, SUM(COALESCE({n('lines_affected')}, 0)) AS lines FROM x WHERE activity = 'claude_file_operation'
  AND {t('operation')} IN ('create', 'edit', 'write') GROUP BY 1, 2),
 ses AS (SELECT date, username, COUNT(DISTINCT customer) AS k FROM x WHERE activity = 'claude_session_start' GROUP BY 1, 2)
SELECT date, username, COALESCE(k, 0) AS sessions, CAST(COALESCE(tokens, 0) AS BIGINT) AS tokens_used,
 CAST(COALESCE(lines, 0) AS BIGINT) AS lines_of_code_written, CAST(ROUND(CAST(COALESCE(tokens, 0) AS BIGINT) * 0.000003, 4) AS DOUBLE) AS estimated_cost_usd
FROM tok FULL JOIN lin USING (date, username) FULL JOIN ses USING (date, username)""")


def product_metrics(as_of: str, days: int) -> str:
    return f"""
, h AS (SELECT date_trunc('hour', ts) AS hour, customer, COUNT(*) AS total_activities, COUNT(DISTINCT activity) AS unique_activity_types,
 quantile_cont(CAST({n('latency_ms')} AS DOUBLE), 0.5) AS p50_latency_ms, quantile_cont(CAST({n('latency_ms')} AS DOUBLE), 0.95) AS p95_latency_ms,
 quantile_cont(CAST({n('latency_ms')} AS DOUBLE), 0.99) AS p99_latency_ms,
 COUNT(*) FILTER ({b('success')}) AS good, COUNT(*) FILTER (NOT {b('success')}) AS bad,
 CAST(SUM({n('total_tokens')}) AS BIGINT) AS total_tokens, CAST(SUM({n('prompt_tokens')}) AS BIGINT) AS prompt_tokens,
 CAST(SUM({n('completion_tokens')}) AS BIGINT) AS completion_tokens, SUM(revenue_impact) AS cost, COUNT(DISTINCT link) AS unique_artifacts,
 COUNT(link) AS linked FROM stream_v2 WHERE ts > {when(as_of)} - INTERVAL {days} DAY AND ts <= {when(as_of)} GROUP BY 1, 2),
 p AS (SELECT *, {pct('good', '(good + bad)', 2)} AS success_rate_pct, {pct('linked', 'total_activities', 2)} AS provenance_coverage_pct FROM h),
 s AS (SELECT *, (CASE WHEN p95_latency_ms <= 25 THEN 25 ELSE 0 END) + (CASE WHEN success_rate_pct >= 95 THEN 25 ELSE success_rate_pct * 0.25 END)
  + (CASE WHEN provenance_coverage_pct >= 98 THEN 25 ELSE provenance_coverage_pct * 0.25 END) + 25 AS total FROM p),
 product_metrics AS (SELECT hour, customer, total_activities, unique_activity_types, ROUND(p50_latency_ms, 6) AS p50_latency_ms,
 ROUND(p95_latency_ms, 6) AS p95_latency_ms, ROUND(p99_latency_ms, 6) AS p99_latency_ms,
 CASE WHEN p95_latency_ms <= 25 THEN 'met' ELSE 'missed' END AS mcp_latency_slo, success_rate_pct, total_tokens, prompt_tokens, completion_tokens,
 ROUND(CAST(total_tokens AS DOUBLE) / NULLIF(total_activities, 0), 2) AS avg_tokens_per_activity, ROUND(cost, 6) AS total_cost_credits,
 {money('cost * 3', 4)} AS total_cost_usd, unique_artifacts, provenance_coverage_pct,
 ROUND(CASE WHEN total IS NOT NULL THEN CAST(greatest(0, least(100, total)) AS DOUBLE) END, 6) AS health_score FROM s)
"""


add("a20_product_metrics", "stream_v2", product_metrics(DAY, 30) + "SELECT * FROM product_metrics")
add("a41_customer_health", "stream_v2", product_metrics(DAY, 7) + """
SELECT customer, total_activities, p50_latency_ms, p95_latency_ms, success_rate_pct, health_score FROM product_metrics
WHERE customer = (SELECT customer FROM stream_v2 WHERE ts < {w} ORDER BY ts DESC, customer LIMIT 1)
 AND hour >= (SELECT MAX(ts) FROM stream_v2 WHERE ts < {w}) - INTERVAL 1 HOUR AND hour <= (SELECT MAX(ts) FROM stream_v2 WHERE ts < {w})""".replace("{w}", when(DAY)))
add("a21_session_day_summary", "activity_stream", """
SELECT CAST(ts AS DATE) AS date, COUNT(DISTINCT customer) AS unique_sessions, COUNT(*) AS total_activities,
 COUNT(*) FILTER (activity = 'claude_session_start') AS sessions_started, COUNT(*) FILTER (activity = 'claude_session_end') AS sessions_ended
FROM activity_stream GROUP BY 1""")
add("a22_tool_breakdown", "activity_stream", f"""
SELECT {t('tool_name')} AS tool, COUNT(*) AS usage_count, ROUND(AVG({n('duration_ms')}), 6) AS avg_duration_ms
FROM activity_stream WHERE activity = 'claude_tool_call' GROUP BY 1""")
add("a23_files_touched", "activity_stream", f"""
SELECT {t('file_path')} AS file_path, COUNT(*) AS operations_count, MAX(ts) AS last_modified
FROM activity_stream WHERE activity = 'claude_file_operation' GROUP BY 1""")
add("a24_host_profile", "activity_stream", f"""
, mine AS (SELECT * FROM activity_stream WHERE anonymous_customer_id = '{HOST}'),
 a AS (SELECT COUNT(DISTINCT customer) AS sessions_started, COUNT(DISTINCT CAST(ts AS DATE)) AS days_active, COUNT(*) AS total_activities,
  CAST(MAX(ts) AS DATE) AS last_active FROM mine WHERE {IN_STREAM}),
 o AS (SELECT COUNT(*) AS orphaned_sessions FROM (SELECT customer FROM mine WHERE activity LIKE 'claude_session%' GROUP BY 1
  HAVING MAX(CASE WHEN activity = 'claude_session_end' THEN 1 ELSE 0 END) = 0)),
 s AS (SELECT COUNT(DISTINCT customer) AS study_sessions FROM mine WHERE {t('project_path')} LIKE '{STUDY}')
SELECT *, CASE WHEN study_sessions > 5 THEN 'expert' WHEN study_sessions > 2 THEN 'advanced' WHEN orphaned_sessions > 0 THEN 'discoverer'
 ELSE 'beginner' END AS level FROM a, o, s""")
add("a24b_host_sessions", "activity_stream", f"""
, s AS (SELECT customer AS session_id, MIN(ts) AS start_time, MAX(ts) AS end_time, COUNT(*) AS activity_count, MAX({t('project_path')}) AS project
 FROM activity_stream WHERE anonymous_customer_id = '{HOST}' AND {IN_STREAM} GROUP BY 1 ORDER BY start_time DESC, session_id LIMIT 5)
SELECT session_id, start_time, date_diff('minute', start_time, COALESCE(end_time, {when(DAY)})) AS duration_mins, activity_count,
 right(project, 30) AS project_name FROM s""")
add("a24c_host_progress", "activity_stream", f"""
, s AS (SELECT COUNT(DISTINCT CAST(ts AS DATE)) AS days_active, COUNT(DISTINCT customer) AS sessions_started,
 COUNT(*) FILTER ({t('project_path')} LIKE '{STUDY}') AS study_events FROM activity_stream WHERE anonymous_customer_id = '{HOST}')
SELECT *, CASE WHEN study_events > 10 THEN 'expert' WHEN study_events > 5 THEN 'advanced' WHEN sessions_started > 5 THEN 'growing'
 WHEN sessions_started > 0 THEN 'starting' ELSE 'new' END AS level FROM s""")
add("a25_session_gap_counts", "activity_stream", """
SELECT 'active' AS metric, COUNT(*) AS value FROM activity_stream WHERE activity = 'claude_session_start'
 AND customer NOT IN (SELECT customer FROM activity_stream WHERE activity = 'claude_session_end' AND customer IS NOT NULL)
 AND ts > TIMESTAMP '2024-01-30 19:00:00' AND ts <= TIMESTAMP '2024-01-30 20:00:00'
UNION ALL SELECT 'orphaned_today', COUNT(*) FROM (
 SELECT customer FROM activity_stream WHERE activity = 'claude_session_start' AND CAST(ts AS DATE) = DATE '2024-01-30'
 EXCEPT SELECT customer FROM activity_stream WHERE activity = 'claude_session_end' AND CAST(ts AS DATE) = DATE '2024-01-30')""")
add("a25b_active_sessions", "activity_stream", """
SELECT * REPLACE (ROUND(revenue_impact, 6) AS revenue_impact) FROM activity_stream WHERE activity = 'claude_session_start'
 AND customer NOT IN (SELECT customer FROM activity_stream WHERE activity = 'claude_session_end' AND customer IS NOT NULL)""")
add("o2_orphaned_today", "activity_stream", """
SELECT customer FROM activity_stream WHERE activity = 'claude_session_start' AND CAST(ts AS DATE) = DATE '2024-01-30'
 EXCEPT SELECT customer FROM activity_stream WHERE activity = 'claude_session_end' AND CAST(ts AS DATE) = DATE '2024-01-30'""")
CLASSED = f", kb AS (SELECT *, {PATTERN} AS common_pattern FROM knowledge_base)"
add("a26_successful_patterns", "knowledge_base", CLASSED + """
SELECT common_pattern, COUNT(*) AS usage_count, ROUND(AVG(execution_time_ms), 6) AS avg_execution_ms,
 CAST(COUNT(*) FILTER (query_success) AS DOUBLE) / COUNT(*) AS success_rate,
 COUNT(DISTINCT user_prompt) AS distinct_prompts, COUNT(DISTINCT generated_query) AS distinct_queries
FROM kb WHERE query_success GROUP BY 1""")
add("a26b_pattern_examples", "knowledge_base", CLASSED + """
SELECT common_pattern, 'prompt' AS kind, user_prompt AS text FROM kb WHERE query_success
UNION SELECT common_pattern, 'query', generated_query FROM kb WHERE query_success""")
INTELLIGENCE = CLASSED + """
, days AS (SELECT CAST(created_ts AS DATE) AS query_date, COUNT(*) AS total_queries, COUNT(*) FILTER (query_success) AS good,
 AVG(execution_time_ms) AS avg_ms, COUNT(DISTINCT common_pattern) AS pattern_diversity FROM kb GROUP BY 1),
 m AS (SELECT query_date, total_queries, ROUND(CAST(good AS DOUBLE) / NULLIF(total_queries, 0), 6) AS success_rate, ROUND(avg_ms, 6) AS avg_exec_time,
 pattern_diversity, CAST(SUM(total_queries) OVER (ORDER BY query_date) AS BIGINT) AS cumulative_queries,
 ROUND(AVG(CAST(good AS DOUBLE) / NULLIF(total_queries, 0)) OVER (ORDER BY query_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling_7day_success_rate
 FROM days)
"""
add("a27_intelligence_metrics", "knowledge_base", INTELLIGENCE + "SELECT * FROM m")
add("w4_running_totals", "knowledge_base", INTELLIGENCE + "SELECT query_date, cumulative_queries FROM m")
add("w5_rolling_rate", "knowledge_base", INTELLIGENCE + "SELECT query_date, rolling_7day_success_rate FROM m")
P95 = f"""SELECT customer, 'system_performance' AS subject, 'hourly_latency_p95' AS metric,
 ROUND(quantile_cont(CAST({n('latency_ms')} AS DOUBLE), 0.95), 6) AS value, 'hourly' AS grain, 1.0::DOUBLE AS confidence,
 'aggregate_calculation' AS derivation_method FROM stream_v2
WHERE activity = 'mcp_call' AND ts > {when(HOUR)} - INTERVAL 1 HOUR AND ts <= {when(HOUR)} AND {n('latency_ms')} IS NOT NULL GROUP BY 1"""


def rate(more_than: int) -> str:
    return f"""SELECT customer, 'query_performance' AS subject, 'success_rate' AS metric,
 ROUND(COUNT(*) FILTER ({b('success')}) * 100.0::DOUBLE / COUNT(*), 6) AS value, 'daily' AS grain, 0.95::DOUBLE AS confidence,
 'aggregate_calculation' AS derivation_method FROM stream_v2
WHERE activity IN ('query_complete', 'query_error') AND ts > {when(HOUR)} - INTERVAL 1 DAY AND ts <= {when(HOUR)} GROUP BY 1 HAVING COUNT(*) > {more_than}"""


add("a28_hourly_latency_p95", "stream_v2", P95)
add("a29_success_rate", "stream_v2", rate(2))
TEAMS = "(SELECT * REPLACE (substr(customer, 1, 2) AS customer) FROM stream_v2)"
BY_TEAM = f"{P95} UNION ALL {rate(10)}".replace("FROM stream_v2", f"FROM {TEAMS}")
add("t6_run_rollups", "stream_v2", BY_TEAM)
add("d8_record_insights", "stream_v2", f"""
SELECT {stable_id(HOUR, 'customer', 'subject', 'metric', 'grain')} AS id, {when(HOUR)} AS ts, customer, subject, metric, value, grain, confidence, CAST(NULL AS VARCHAR) AS artifact_id, derivation_method,
 {when(HOUR)} AS valid_from, {when(HOUR)} + INTERVAL 1 DAY AS valid_until, FALSE AS is_stale, FALSE AS is_quarantined,
 CAST(NULL AS VARCHAR) AS quarantine_reason FROM ({BY_TEAM})""")


def lag(name: str, table: str, condition: str = "TRUE") -> str:
    return f"""SELECT '{name}' AS stream_name, COUNT(*) AS pending_records, MIN(ts) AS oldest_record, MAX(ts) AS newest_record,
 date_diff('second', MIN(ts), {when(DAY)}) AS max_lag_seconds, date_diff('millisecond', MAX(ts), {when(DAY)}) AS min_lag_ms
FROM {table} WHERE {condition}"""


add("a30_stream_lag", "stream_v2 insight_atoms",
    f"{lag('stream_changes', 'stream_v2')} UNION ALL {lag('insight_changes', 'insight_atoms')}")
add("t7_pending_lag", "stream_v2", lag("stream_changes", "stream_v2", "ts > TIMESTAMP '2024-01-30 00:00:00'"))


def kinds(condition: str) -> str:
    return f"""
, f AS (SELECT feature_json, unnest(json_keys(feature_json)) AS column_name FROM stream_v2 WHERE {condition}),
 k AS (SELECT column_name, CASE json_type(feature_json, '$.' || column_name) WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'NUMBER'
  WHEN 'BIGINT' THEN 'NUMBER' WHEN 'DOUBLE' THEN 'NUMBER' ELSE json_type(feature_json, '$.' || column_name) END AS kind, COUNT(*) AS n FROM f GROUP BY 1, 2)
"""


DRIFT = kinds(f"ts > {when(DAY)} - INTERVAL 24 HOUR AND ts <= {when(DAY)}") + """
, e(column_name, expected_type) AS (VALUES ('tool_name', 'STRING'), ('parameters', 'OBJECT'), ('latency_ms', 'NUMBER'), ('success', 'BOOLEAN'),
 ('error', 'STRING'), ('warehouse', 'STRING'), ('role', 'STRING'), ('bytes_scanned', 'NUMBER'), ('rows', 'NUMBER'), ('model', 'STRING'),
 ('prompt_tokens', 'NUMBER'), ('completion_tokens', 'NUMBER')),
 s AS (SELECT column_name, COUNT(DISTINCT kind) AS type_variations, first(kind ORDER BY n DESC, kind) AS actual_type, CAST(SUM(n) AS BIGINT) AS occurrences FROM k GROUP BY 1),
 drift AS (SELECT * FROM (SELECT column_name, actual_type, expected_type, type_variations, occurrences,
  CASE WHEN expected_type IS NULL THEN 'NEW_COLUMN' WHEN actual_type <> expected_type THEN 'TYPE_CHANGE'
  WHEN type_variations > 1 THEN 'TYPE_INCONSISTENCY' ELSE 'OK' END AS drift_status FROM s LEFT JOIN e USING (column_name)) WHERE drift_status <> 'OK')
"""
add("a31_schema_drift", "stream_v2", DRIFT + "SELECT * FROM drift")
add("a31b_payload_kinds", "stream_v2", kinds("TRUE") + "SELECT * FROM k")
add("d7_drift_events", "stream_v2", DRIFT + f"""
SELECT {stable_id(DAY, 'feature_json')} AS activity_id, * FROM (SELECT {when(DAY)} AS ts, 'schema_drift_detected' AS activity, 'SYSTEM' AS customer,
 '{{"drift_type":"' || drift_status || '","column":"' || column_name || '"' || COALESCE(',"expected_type":"' || expected_type || '"', '')
 || ',"actual_type":"' || actual_type || '","action":"quarantine_insights","event_type":"schema_drift","severity":"warning"}}' AS feature_json FROM drift)""")
ENTRIES = f"""
, act AS (SELECT customer, activity || ':' || strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS key, COUNT(*) AS n FROM stream_v2
  WHERE ts > {when(HOUR)} - INTERVAL 24 HOUR AND ts <= {when(HOUR)} GROUP BY 1, 2),
 ins AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer, subject, metric ORDER BY confidence DESC, ts DESC, id) AS r FROM insight_atoms
  WHERE valid_until > {when(HOUR)} AND NOT is_stale AND NOT is_quarantined) WHERE r = 1),
 qry AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer ORDER BY ts DESC, activity_id) AS r FROM stream_v2
  WHERE activity = 'query_complete' AND {b('success')} AND ts > {when(HOUR)} - INTERVAL 2 HOUR AND ts <= {when(HOUR)}),
 tool AS (SELECT customer, {t('tool_name')} AS key, COUNT(*) AS n, AVG({n('latency_ms')}) AS a, quantile_cont(CAST({n('latency_ms')} AS DOUBLE), 0.95) AS q
  FROM stream_v2 WHERE activity = 'tool_call' AND ts > {when(HOUR)} - INTERVAL 6 HOUR AND ts <= {when(HOUR)} AND {t('tool_name')} IS NOT NULL GROUP BY 1, 2)
"""
ENTRY_ROWS = f"""
SELECT customer, 'activities' AS section, key, n, NULL::VARCHAR AS text, NULL::DOUBLE AS confidence, NULL::VARCHAR AS artifact_id,
 NULL::TIMESTAMP AS valid_until, NULL::VARCHAR AS warehouse, NULL::TIMESTAMP AS ts, NULL::BIGINT AS place, NULL::DOUBLE AS avg_latency_ms,
 NULL::DOUBLE AS p95_latency_ms FROM act
UNION ALL SELECT customer, 'insights', subject || ':' || metric, NULL, CAST(value AS VARCHAR), ROUND(confidence, 6), artifact_id, valid_until, NULL, NULL, NULL, NULL, NULL FROM ins
UNION ALL SELECT customer, 'recent_queries', activity_id, {n('row_count')}, {t('sql')}, NULL, link, NULL, {t('warehouse')}, ts, r, NULL, NULL FROM qry WHERE r <= 10
UNION ALL SELECT customer, 'tool_usage', key, n, NULL, NULL, NULL, NULL, NULL, NULL, NULL, ROUND(a, 6), ROUND(q, 6) FROM tool"""
for _name in ("a32_context_entries", "a32c_context_pages", "t2b_cached_entries", "d4c_refreshed_entries"):
    add(_name, "stream_v2 insight_atoms context_cache" if _name[0] == "d" else "stream_v2 insight_atoms", ENTRIES + ENTRY_ROWS)
BLOB_SIZES = """
, who AS (SELECT customer FROM act UNION SELECT customer FROM ins UNION SELECT customer FROM qry UNION SELECT customer FROM tool)
"""
add("a32b_context_blobs", "stream_v2 insight_atoms", ENTRIES + BLOB_SIZES + f"""
SELECT customer, 'default' AS context_type,
 (SELECT NULLIF(COUNT(*), 0) FROM act WHERE act.customer = who.customer) AS activity_keys,
 (SELECT NULLIF(COUNT(*), 0) FROM ins WHERE ins.customer = who.customer) AS insight_keys,
 (SELECT NULLIF(COUNT(*), 0) FROM qry WHERE qry.customer = who.customer AND r <= 10) AS query_count,
 (SELECT NULLIF(COUNT(*), 0) FROM tool WHERE tool.customer = who.customer) AS tool_keys,
 (SELECT activity_id FROM qry WHERE qry.customer = who.customer AND r = 1) AS newest_query,
 date_diff('millisecond', (SELECT MAX(ts) FROM stream_v2), {when(HOUR)}) AS refresh_lag_ms, 'false' AS is_stale FROM who""")
add("d4_refresh_context", "stream_v2 insight_atoms context_cache", ENTRIES + BLOB_SIZES + f"""
SELECT COALESCE(who.customer, c.customer) AS customer, COALESCE(c.context_type, 'default') AS context_type,
 CASE WHEN who.customer IS NOT NULL THEN {when(HOUR)} ELSE c.updated_at END AS updated_at,
 CASE WHEN c.customer IS NULL THEN 0 WHEN who.customer IS NOT NULL THEN c.access_count + 1 ELSE c.access_count END AS access_count,
 CASE WHEN who.customer IS NOT NULL THEN FALSE ELSE c.is_stale OR c.updated_at < {when(HOUR)} - INTERVAL 30 SECOND END AS is_stale,
 who.customer IS NOT NULL AS has_blob FROM who FULL JOIN context_cache c ON who.customer = c.customer AND c.context_type = 'default'""")
add("t2_context_stream", "stream_v2 insight_atoms", ENTRIES + BLOB_SIZES + f"""
SELECT customer, 'default' AS context_type, {when(HOUR)} AS updated_at, CAST(0 AS BIGINT) AS access_count, FALSE AS is_stale, TRUE AS has_blob FROM who""")
add("d4b_refresh_log", "stream_v2", """
SELECT 'context_refresh_20240130_120000' AS migration_name, COUNT(*) AS stream_records, COUNT(DISTINCT customer) AS customers_updated FROM stream_v2""")
NUMBERED = """
, num AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY artifact_id ORDER BY ts, event_id) - 1 AS i FROM result_rows),
 pages AS (SELECT artifact_id, i // 1000 AS page, COUNT(*) AS page_rows, CAST(SUM(length(row_json)) + COUNT(*) + 1 AS BIGINT) AS page_bytes FROM num GROUP BY 1, 2)
"""
add("a33b_page_sizes", "result_rows", NUMBERED + "SELECT * FROM pages")
add("a33_artifact_profile", "result_rows", NUMBERED + f"""
, tot AS (SELECT artifact_id, CAST(SUM(page_rows) AS BIGINT) AS row_count, CAST(SUM(page_bytes) - COUNT(*) + 1 AS BIGINT) AS total_bytes,
 COUNT(*) AS page_count FROM pages GROUP BY 1),
 smp AS (SELECT artifact_id, string_agg(row_json, ',' ORDER BY i) AS sample_rows FROM num WHERE i < 10 GROUP BY 1)
SELECT artifact_id, row_count, CAST(1 AS BIGINT) AS column_count, sample_rows, length('[' || sample_rows || ']') AS sample_chars,
 '[{{"name":"k","type":"long","nullable":true}}]' AS content_schema, page_count, total_bytes,
 row_count > 100 OR total_bytes > 1048576 AS is_external, {when(DAY)} + INTERVAL 24 HOUR AS expires_at FROM tot JOIN smp USING (artifact_id)""")


def validation(old: str, new: str) -> str:
    def facts(table: str) -> str:
        return f"""SELECT 'row_count' AS check_name, CAST(COUNT(*) AS VARCHAR) AS v FROM {table}
  UNION ALL SELECT 'min_timestamp', strftime(MIN(ts), '%Y-%m-%d %H:%M:%S.%f') FROM {table}
  UNION ALL SELECT 'max_timestamp', strftime(MAX(ts), '%Y-%m-%d %H:%M:%S.%f') FROM {table}
  UNION ALL SELECT 'id_digest', CAST(SUM(CAST(('0x' || substr(md5(activity_id), 1, 15)) AS BIGINT)) AS VARCHAR) FROM {table}"""

    return f"""
, o AS ({facts(old)}), w AS ({facts(new)})
SELECT check_name, o.v AS old_table_value, w.v AS new_table_value,
 CASE WHEN o.v = w.v THEN 'MATCH' WHEN o.v IS NULL OR w.v IS NULL THEN 'NULL_VALUE' ELSE 'MISMATCH' END AS match_status
FROM o JOIN w USING (check_name)"""


add("a34_migration_validation", "activity_stream stream_v2", validation("activity_stream", "stream_v2"))
add("o1_union_of_checks", "stream_v2 meta_stream", validation("stream_v2", "meta_stream"))
add("a35_study_sessions_by_day", "activity_stream", f"""
SELECT CAST(ts AS DATE) AS day, COUNT(*) AS study_sessions FROM activity_stream
WHERE activity = 'claude_session_start' AND {t('project_path')} LIKE '{STUDY}' GROUP BY 1""")
add("a36_table_stats", "activity_stream", """
SELECT COUNT(*) AS stream_rows, MAX(ts) AS last_insert, CASE WHEN COUNT(*) > 5000 THEN 'partition the stream table' END AS maintenance_hint FROM activity_stream""")
add("a37_quick_stats", "activity_stream", f"""
SELECT (SELECT COUNT(DISTINCT anonymous_customer_id) FROM activity_stream WHERE {IN_STREAM}) AS total_users,
 (SELECT COUNT(DISTINCT customer) FROM activity_stream WHERE CAST(ts AS DATE) = DATE '2024-01-30') AS sessions_today,
 (SELECT COUNT(*) FROM activity_stream WHERE ts >= TIMESTAMP '2024-01-30 19:00:00' AND ts <= TIMESTAMP '2024-01-30 20:00:00') AS activities_last_hour""")
add("a37b_successful_payloads", "meta_stream", f"""
SELECT DISTINCT feature_json FROM (SELECT feature_json FROM meta_stream WHERE activity = 'claude_sql_execution'
 AND ts > {when(DAY)} - INTERVAL 7 DAY AND ts <= {when(DAY)} AND {b('success')} ORDER BY ts DESC, activity_id LIMIT 10)""")
add("a38_stream_window_summary", "stream_v2", f"""
SELECT COUNT(*) AS total_events, COUNT(DISTINCT activity) AS activity_types, MIN(ts) AS first_event, MAX(ts) AS last_event,
 ROUND(SUM(revenue_impact), 6) AS total_cost FROM stream_v2 WHERE customer = 'c3' AND ts > {when(HOUR)} - INTERVAL 7 DAY AND ts <= {when(HOUR)}""")
add("a39_quarantine_counts", "insight_atoms", "SELECT COUNT(*) AS quarantined_count FROM insight_atoms WHERE is_quarantined")
add("a40_longest_sessions", "activity_stream", f"""
SELECT customer, date_diff('minute', MIN(ts), MAX(ts)) AS duration_minutes FROM activity_stream WHERE anonymous_customer_id = '{HOST}'
GROUP BY 1 ORDER BY duration_minutes DESC, customer LIMIT 10""")

# ----------------------------------------------------------------- windows (W)
add("w1_activity_occurrences", "activity_stream", """
SELECT a.activity_id,
 (SELECT COUNT(*) FROM activity_stream x WHERE x.customer = a.customer AND x.activity = a.activity AND x.ts <= a.ts) AS activity_occurrence,
 (SELECT MIN(x.ts) FROM activity_stream x WHERE x.customer = a.customer AND x.activity = a.activity AND x.ts > a.ts) AS activity_repeated_at
FROM activity_stream a""")
add("w2_repeated_for_one_activity", "stream_v2", """
SELECT a.activity_id, a.customer, a.activity, CASE WHEN a.activity = 'tool_call' THEN
 (SELECT COUNT(*) FROM stream_v2 x WHERE x.customer = a.customer AND x.activity = a.activity AND x.ts <= a.ts) END AS activity_occurrence,
 CASE WHEN a.activity = 'tool_call' THEN
 (SELECT MIN(x.ts) FROM stream_v2 x WHERE x.customer = a.customer AND x.activity = a.activity AND x.ts > a.ts) END AS activity_repeated_at
FROM stream_v2 a""")
add("w6_self_study_sessions", "activity_stream", f"""
, s AS (SELECT customer, ts, {t('project_path')} LIKE '{STUDY}' AS study FROM activity_stream WHERE activity = 'claude_session_start')
SELECT a.customer AS analyzing_session, a.ts AS analysis_time, COUNT(DISTINCT x.customer) AS sessions_studied,
 MIN(date_diff('minute', x.ts, a.ts)) AS minutes_after_latest
FROM s a JOIN s x ON a.customer <> x.customer AND a.ts > x.ts WHERE a.study GROUP BY 1, 2""")
add("w7_latest_per_customer", "stream_v2", """
SELECT * REPLACE (ROUND(revenue_impact, 6) AS revenue_impact) FROM
 (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer ORDER BY ts DESC, activity_id) AS place FROM stream_v2) WHERE place <= 10""")
LINES = f"""
, p AS (SELECT CASE WHEN json_valid(value) THEN value END AS j FROM ndjson_lines),
 lines AS (SELECT {t('activity_id', 'j')} AS activity_id, COALESCE(CAST({t('ts', 'j')} AS TIMESTAMP), {when(DAY)}) AS ts,
  {t('activity', 'j')} AS activity, {t('customer', 'j')} AS customer, COALESCE({t('anonymous_customer_id', 'j')}, 'unknown') AS anonymous_customer_id,
  COALESCE({t('feature_json', 'j')}, '{{}}') AS feature_json, COALESCE(CAST({t('revenue_impact', 'j')} AS DOUBLE), 0) AS revenue_impact,
  {t('link', 'j')} AS link FROM p WHERE {t('activity_id', 'j')} IS NOT NULL)
"""
FIRST = "(SELECT *, ROW_NUMBER() OVER (PARTITION BY activity_id ORDER BY ts, feature_json) AS r FROM lines)"
add("w8_dedup_keep_first", "ndjson_lines", LINES + f"SELECT * EXCLUDE (r) FROM {FIRST} WHERE r = 1")
add("s1_parse_lines", "ndjson_lines", LINES + "SELECT * FROM lines")
add("t1_ingest_stream", "ndjson_lines", LINES + f"SELECT * EXCLUDE (r) FROM {FIRST} WHERE r = 1")
add("o3_distinct_activities", "activity_stream", f"SELECT DISTINCT activity FROM activity_stream WHERE {IN_STREAM}")
add("o4_learning_opportunities", "knowledge_base", """
SELECT user_prompt, generated_query, created_ts, 'Query Failed' AS issue_type FROM knowledge_base WHERE NOT query_success
UNION ALL SELECT user_prompt, generated_query, created_ts, 'No Results' FROM knowledge_base WHERE query_success AND result_count = 0""")

# ------------------------------------------------------- table-changing jobs (D)
add("d1_insert_if_absent", "ndjson_lines", LINES + f"""
, old AS (SELECT DISTINCT activity_id FROM lines WHERE {HALF})
SELECT activity_id, NULL::TIMESTAMP AS ts, NULL::VARCHAR AS feature_json FROM old
UNION ALL SELECT activity_id, ts, feature_json FROM {FIRST} WHERE r = 1 AND activity_id NOT IN (SELECT activity_id FROM old)""")
ENVELOPE = "activity_id, ts, activity, customer, anonymous_customer_id, feature_json, ROUND(revenue_impact, 6) AS revenue_impact, link"
LEGACY = f"""COALESCE({t('feature_1')}, {t('tool_name')}, '') AS feature_1, COALESCE({t('feature_2')}, {t('parameters')}, '') AS feature_2,
 COALESCE({t('feature_3')}, {t('result_type')}, '') AS feature_3"""
NO_LEGACY = "NULL::VARCHAR AS feature_1, NULL::VARCHAR AS feature_2, NULL::VARCHAR AS feature_3"
MIGRATED = f"activity_stream WHERE {HALF}"
add("d2_dual_write", "activity_stream stream_v2", f"""
SELECT {ENVELOPE}, {NO_LEGACY}, 'old' AS generation FROM activity_stream
UNION ALL SELECT {ENVELOPE}, {LEGACY}, 'old' FROM stream_v2
UNION ALL SELECT {ENVELOPE}, {NO_LEGACY}, 'new' FROM {MIGRATED}
UNION ALL SELECT {ENVELOPE}, {LEGACY}, 'new' FROM stream_v2""")
add("s10_dual_sink", "stream_v2", f"SELECT {ENVELOPE}, {LEGACY}, unnest(['old', 'new']) AS generation FROM stream_v2")
add("s9_write_and_read", "activity_stream", f"SELECT {ENVELOPE}, CAST(ts AS DATE) AS dt FROM activity_stream")
add("s12_result_formats", "activity_stream", """
SELECT CAST(ts AS DATE) AS day, COUNT(DISTINCT customer) AS sessions, COUNT(DISTINCT anonymous_customer_id) AS users, COUNT(*) AS activities,
 unnest(['csv', 'json', 'parquet']) AS format
FROM activity_stream WHERE ts >= DATE '2024-01-31' - INTERVAL 30 DAY AND ts <= TIMESTAMP '2024-01-31 00:00:00' GROUP BY 1""")
add("d3_backfill", "activity_stream", f"""
SELECT {ENVELOPE} FROM {MIGRATED} UNION ALL SELECT {ENVELOPE} FROM activity_stream
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-20' AND activity_id NOT IN (SELECT activity_id FROM {MIGRATED})""")
add("d3b_backfill_rows_by_day", "activity_stream", f"""
SELECT {ENVELOPE} FROM activity_stream
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-20' AND activity_id NOT IN (SELECT activity_id FROM {MIGRATED})""")
EXPIRED = f"COALESCE(expires_at < {when(HOUR)} AND NOT is_pinned AND access_count < 2, FALSE)"
add("d5_clean_artifacts", "artifacts", f"SELECT * FROM artifacts WHERE NOT {EXPIRED}")
add("d5c_expired_count", "artifacts", f"SELECT COUNT(*) AS deleted_count FROM artifacts WHERE {EXPIRED}")
ATOM = "id, ts, customer, subject, metric, ROUND(value, 6) AS value, ROUND(confidence, 6) AS confidence, artifact_id, valid_until"
add("d5b_stale_insights", "insight_atoms",
    f"SELECT {ATOM}, is_stale OR valid_until < {when(HOUR)} AS is_stale, is_quarantined FROM insight_atoms")
HIT = f"""artifact_id IN (SELECT DISTINCT link FROM stream_v2 WHERE ts > {when(DAY)} - INTERVAL 24 HOUR AND ts <= {when(DAY)} AND feature_json IS NOT NULL
 AND link IS NOT NULL)"""
QUARANTINE = f"""SELECT {ATOM}, is_stale, is_quarantined OR COALESCE({HIT}, FALSE) AS is_quarantined,
 CASE WHEN NOT is_quarantined AND {HIT} THEN 'Schema drift detected' END AS quarantine_reason FROM insight_atoms"""
add("d6_quarantine_insights", "insight_atoms stream_v2", QUARANTINE)
add("d6b_quarantine_on_drift", "insight_atoms stream_v2", QUARANTINE)
add("d9_log_queries", "knowledge_base", f"""
SELECT {stable_id(DAY, 'user_prompt', 'generated_query', 'query_success', 'result_count', 'execution_time_ms')} AS kb_id, {when(DAY)} AS created_ts, user_prompt, generated_query, query_success, result_count, execution_time_ms,
 CAST(NULL AS VARCHAR) AS user_rating, {PATTERN} AS common_pattern FROM knowledge_base""")
add("d10_valid_insights", "insight_atoms", f"""
SELECT {ATOM}, is_stale, is_quarantined FROM insight_atoms WHERE valid_until > {when(HOUR)} AND NOT is_stale AND NOT is_quarantined""")
add("d11_seed_definitions", "activity_stream", """
SELECT DISTINCT activity AS activity_name FROM activity_stream UNION
SELECT * FROM (VALUES ('claude_session_start'), ('claude_tool_call'), ('claude_file_operation'), ('claude_decision'),
 ('claude_sql_execution'), ('claude_error'), ('claude_session_end'))""")


def violations() -> str:
    """Contract checks of the fields that occur in the fixture, spelled out."""

    def check(family: str, activities: str, field: str, kind: str, required: bool, allowed: str | None) -> str:
        kind_of = f"""CASE json_type(feature_json, '$.{field}') WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'NUMBER'
   WHEN 'BIGINT' THEN 'NUMBER' WHEN 'DOUBLE' THEN 'NUMBER' ELSE COALESCE(json_type(feature_json, '$.{field}'), 'NULL') END"""
        missing = "'missing'" if required else "NULL"
        listed = f"WHEN {t(field)} NOT IN {allowed} THEN 'not_allowed'" if allowed else ""
        return f"""SELECT activity_id, activity, '{family}' AS family, '{field}' AS field, CASE WHEN {kind_of} = 'NULL' THEN {missing}
  WHEN {kind_of} <> '{kind}' THEN 'wrong_type' {listed} END AS violation FROM stream_v2 WHERE activity IN {activities}"""

    sql = ("sql_event", "('query_complete', 'query_submitted', 'sql_execution', 'claude_sql_execution')")
    llm = ("llm_event", "('user_asked', 'claude_responded', 'llm_call', 'llm_response')")
    tool = ("tool_event", "('claude_tool_call', 'tool_call', 'tool_execution')")
    file = ("file_event", "('claude_file_operation', 'file_op', 'file_operation')")
    ses = ("session_event", "('claude_session_start', 'claude_session_end', 'session_heartbeat', 'claude_context_hydration')")
    mcp = ("mcp_event", "('mcp_call', 'get_context', 'refresh_context', 'store_artifact')")
    sysev = ("system_event", "('system_backpressure', 'schema_drift_detected', 'queue_rotation', 'artifact_cleanup', 'error_recovery', 'system_event')")
    rules = [
        (*sql, "query_id", "STRING", True, None), (*sql, "sql", "STRING", True, None), (*sql, "success", "BOOLEAN", True, None),
        (*sql, "rows", "NUMBER", False, None),
        (*llm, "model", "STRING", True, "('claude-3-opus', 'claude-3-sonnet', 'claude-3-haiku', 'gpt-4', 'gpt-3.5-turbo')"),
        (*llm, "prompt_tokens", "NUMBER", True, None), (*llm, "completion_tokens", "NUMBER", True, None),
        (*llm, "total_tokens", "NUMBER", False, None), (*llm, "latency_ms", "NUMBER", False, None),
        (*tool, "tool_name", "STRING", True, None), (*tool, "success", "BOOLEAN", True, None), (*tool, "latency_ms", "NUMBER", False, None),
        (*file, "operation", "STRING", True, "('read', 'write', 'create', 'edit', 'delete', 'rename')"),
        (*file, "file_path", "STRING", True, None), (*file, "bytes_before", "NUMBER", False, None),
        (*file, "bytes_after", "NUMBER", False, None), (*file, "success", "BOOLEAN", False, None),
        (*ses, "session_id", "STRING", True, None),
        (*ses, "event_type", "STRING", True, "('start', 'end', 'heartbeat', 'context_hydration')"),
        (*ses, "total_tokens", "NUMBER", False, None),
        (*mcp, "method", "STRING", True, "('get_context', 'query', 'store_artifact', 'refresh_context')"),
        (*mcp, "latency_ms", "NUMBER", True, None), (*mcp, "cache_hit", "BOOLEAN", False, None),
        (*mcp, "cache_age_ms", "NUMBER", False, None), (*mcp, "stale", "BOOLEAN", False, None),
        (*sysev, "event_type", "STRING", True,
         "('backpressure', 'schema_drift', 'queue_rotation', 'artifact_cleanup', 'error_recovery')"),
        (*sysev, "severity", "STRING", False, "('info', 'warning', 'error', 'critical')"),
    ]
    return " UNION ALL ".join(check(*rule) for rule in rules)


add("q1_validate_events", "stream_v2", f"SELECT * FROM ({violations()}) WHERE violation IS NOT NULL")
CHANGED = ("o.ts IS DISTINCT FROM w.ts OR o.customer IS DISTINCT FROM w.customer OR o.subject IS DISTINCT FROM w.subject "
           "OR o.metric IS DISTINCT FROM w.metric OR o.value IS DISTINCT FROM w.value OR o.confidence IS DISTINCT FROM w.confidence "
           "OR o.valid_until IS DISTINCT FROM w.valid_until")
add("t3_changes_between", "insight_atoms_later", f"""
SELECT id, 'DELETE' AS action, {ATOM[4:]}, is_stale, is_quarantined FROM insight_atoms WHERE id NOT IN (SELECT id FROM insight_atoms_later)
UNION ALL SELECT id, 'INSERT', {ATOM[4:]}, is_stale, is_quarantined FROM insight_atoms_later WHERE id NOT IN (SELECT id FROM insight_atoms)
UNION ALL SELECT id, 'UPDATE', {ATOM[4:]}, is_stale, is_quarantined FROM insight_atoms_later
 WHERE id IN (SELECT w.id FROM insight_atoms o JOIN insight_atoms_later w ON o.id = w.id WHERE {CHANGED})""")

# --------------------------------------------------------------- sources (S)
STREAM_ROUNDED = "* REPLACE (ROUND(revenue_impact, 6) AS revenue_impact)"
add("s3_enrich_events", "stream_v2", f"""
SELECT {STREAM_ROUNDED}, {when(DAY)} AS queued_at, CAST(2 AS BIGINT) AS queue_version FROM stream_v2""")
add("s4_degrade_events", "stream_v2", f"""
SELECT {STREAM_ROUNDED}, TRUE AS degraded, 'backpressure' AS degradation_reason, length(feature_json) > 390 AS _truncated,
 CASE WHEN length(feature_json) > 390 THEN length(feature_json) END AS _original_size FROM stream_v2""")
add("s5_backpressure_events", "backlog", """
, c AS (SELECT host, checked_at, COUNT(*) AS queue_depth, date_diff('microsecond', MIN(marked_at), checked_at) // 1000 AS age FROM backlog GROUP BY 1, 2),
 x AS (SELECT a.*, EXISTS (SELECT 1 FROM c p WHERE p.host = a.host AND p.checked_at = a.checked_at - INTERVAL 1 HOUR AND p.age > 1800000) AS was FROM c a)
SELECT 'system_backpressure' AS activity, checked_at AS ts, host, queue_depth, age AS oldest_age_ms, CAST(1800000 AS BIGINT) AS threshold_ms,
 'backpressure' AS event_type, 'warning' AS severity FROM x WHERE age > 1800000 AND NOT was""")


def bounds(source: str, counted: str, tokens: str) -> str:
    total = f"CAST(COALESCE({tokens}, 0) AS BIGINT)"
    return f"""
UNION ALL SELECT session_id, 'session_start', MIN(ts), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM {source} GROUP BY 1
UNION ALL SELECT session_id, 'session_end', MAX(ts), NULL, NULL, NULL, NULL, NULL, COUNT(*) FILTER ({counted}), {total},
 date_diff('millisecond', MIN(ts), MAX(ts)) FROM {source} GROUP BY 1"""


add("s6_parse_agent_log", "agent_lines", f"""
, j AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS e FROM agent_lines),
 m AS (SELECT *, {t('type', 'e')} AS kind FROM j)
SELECT session_id, 'tool_call' AS kind, ts, CASE WHEN kind = 'error' THEN 'error' ELSE COALESCE({t('tool', 'e')}, 'unknown') END AS tool_name,
 CASE WHEN kind = 'error' THEN '{{"error":"' || COALESCE({t('message', 'e')}, 'Unknown error') || '"}}' ELSE COALESCE({t('parameters', 'e')}, '{{}}') END AS parameters,
 CASE WHEN kind = 'error' THEN 'error' ELSE 'success' END AS result_type, CAST(CASE WHEN kind = 'error' THEN 0 ELSE 100 END AS BIGINT) AS duration_ms,
 CASE WHEN kind = 'error' THEN 0 ELSE length(value) // 4 END AS tokens_used, NULL::BIGINT AS total_activities, NULL::BIGINT AS total_tokens,
 NULL::BIGINT AS session_duration_ms FROM m WHERE kind IN ('tool_use', 'error')
{bounds('m', "kind = 'tool_use'", "SUM(CASE WHEN kind = 'tool_use' THEN length(value) // 4 END)")}""")
add("s7_detect_tools_in_text", "output_lines", f"""
, m AS (SELECT *, regexp_extract(value, 'Running tool: ([A-Za-z]+)', 1) AS tool, strlen(value) + 1 AS bytes FROM output_lines)
SELECT session_id, 'tool_call' AS kind, ts, tool AS tool_name, '{{"source":"output_parse"}}' AS parameters, 'success' AS result_type,
 CAST(100 AS BIGINT) AS duration_ms, CAST(50 AS BIGINT) AS tokens_used, NULL::BIGINT AS total_activities, NULL::BIGINT AS total_tokens,
 NULL::BIGINT AS session_duration_ms FROM m WHERE tool <> ''
{bounds('m', "tool <> '' OR regexp_matches(value, 'Executing|Running|Creating|Writing|Reading')", "SUM(bytes) // 4")}""")
add("s8_build_events", "stream_v2", f"""
, c AS (SELECT *, {t('tool_name')} AS tool, {n('prompt_tokens')} AS p, {t('operation')} AS op, {t('file_path')} AS f, {n('total_tokens')} AS tt FROM stream_v2),
 r AS (SELECT activity_id, ts, customer, anonymous_customer_id, unnest(['claude_session_start', 'claude_tool_call', 'claude_file_operation', 'claude_session_end']) AS activity, tool, p, op, f, tt FROM c)
SELECT activity_id, ts, activity, customer, anonymous_customer_id,
 CASE activity WHEN 'claude_session_start' THEN '{{"session_id":"' || customer || '","host":"' || anonymous_customer_id || '"}}'
  WHEN 'claude_tool_call' THEN '{{"tool_name":"' || tool || '","tokens_used":' || p || '}}'
  WHEN 'claude_file_operation' THEN '{{"operation":"' || op || '","file_path":"' || f || '"}}'
  ELSE '{{"session_id":"' || customer || '","total_tokens":' || tt || '}}' END AS feature_json,
 CASE activity WHEN 'claude_tool_call' THEN (p * 4 // 100) / 1000000.0::DOUBLE WHEN 'claude_session_end' THEN (tt * 4 // 100) / 1000000.0::DOUBLE
  ELSE 0::DOUBLE END AS revenue_impact, CASE activity WHEN 'claude_file_operation' THEN 'file://' || f END AS link FROM r""")

add("s8b_build_session_ends", "stream_v2", f"""
, c AS (SELECT *, {n('total_tokens')} AS tt FROM stream_v2 WHERE activity = 'claude_session_end')
SELECT activity_id, ts, 'session_end' AS activity, customer, anonymous_customer_id, '{{"session_id":"' || customer || '","total_tokens":' || tt || '}}' AS feature_json,
 ROUND(tt * 0.000003::DOUBLE, 6) AS revenue_impact, CAST(NULL AS VARCHAR) AS link FROM c""")

# ------------------------------------------------------------- streaming (T)
HOURLY = f"""
SELECT date_trunc('hour', ts) AS hour, customer, COUNT(*) AS total_activities, COUNT(DISTINCT activity) AS activity_types,
 quantile_disc({n('latency_ms')}, 0.95) AS p95_latency_ms, COUNT(*) FILTER ({b('success')}) AS successful_operations,
 CAST(SUM({n('total_tokens')}) AS BIGINT) AS total_tokens, ROUND(SUM(revenue_impact), 6) AS total_cost_credits FROM stream_v2 GROUP BY 1, 2"""
add("t5_hourly_metrics_stream", "stream_v2", HOURLY)
add("t5b_hourly_sketch_stream", "stream_v2", HOURLY)
add("t8_run_health", "job_runs", f"""
SELECT job_name, state, scheduled_time, completed_time, date_diff('second', scheduled_time, completed_time) AS duration_seconds, error_message,
 CASE state WHEN 'SUCCEEDED' THEN 'healthy' WHEN 'FAILED' THEN 'critical' WHEN 'SKIPPED' THEN 'warning' ELSE 'unknown' END AS health_status
FROM job_runs WHERE scheduled_time >= {when(JOBS_AS_OF)} - INTERVAL {24 * 365 * 5} HOUR AND scheduled_time <= {when(JOBS_AS_OF)}""")
ABANDONED = """
, g AS (SELECT *, CASE WHEN ts < LAG(ts) OVER w + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM activity_stream
  WINDOW w AS (PARTITION BY customer ORDER BY ts)),
 s AS (SELECT *, SUM(new) OVER (PARTITION BY customer ORDER BY ts ROWS UNBOUNDED PRECEDING) AS part FROM g)
SELECT customer, MIN(ts) AS first_event, MAX(ts) AS last_event, COUNT(*) AS activities FROM s GROUP BY customer, part
HAVING COUNT(*) FILTER (activity = 'claude_session_start') > 0 AND COUNT(*) FILTER (activity = 'claude_session_end') = 0"""
add("t9_abandoned_sessions", "activity_stream", ABANDONED)
# a stream reports a session when its watermark, 24 hours behind the newest event, has passed the silence
add("t9b_abandoned_sessions_stream", "activity_stream", ABANDONED + """
 AND MAX(ts) + INTERVAL 2 HOUR <= (SELECT date_trunc('millisecond', MAX(ts)) FROM activity_stream) - INTERVAL 24 HOUR""")
