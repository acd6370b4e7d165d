"""The stream tables, derived from the generic ``events`` table by one SQL each.

Each statement runs unchanged in Spark SQL and in DuckDB, so that the checks can
use it as a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ACTIVITY_STREAM = """
SELECT 'a' || CAST(event_id AS STRING) AS activity_id, ts,
 CASE event_type WHEN 'signup' THEN 'claude_session_start' WHEN 'purchase' THEN 'claude_session_end'
  WHEN 'click' THEN 'claude_file_operation' WHEN 'error' THEN 'claude_error' ELSE 'claude_tool_call' END AS activity,
 's' || CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS customer,
 'host' || CAST(user_id % 40 AS STRING) || '.local' AS anonymous_customer_id,
 '{"tool_name":"tool' || CAST(event_id % 7 AS STRING) || '","duration_ms":' || CAST(CAST(FLOOR(value * 10) AS BIGINT) AS STRING)
 || ',"tokens_used":' || CAST(CAST(FLOOR(value * 100) AS BIGINT) AS STRING)
 || ',"total_tokens":' || CAST(CAST(FLOOR(value * 1000) AS BIGINT) AS STRING)
 || ',"lines_affected":' || CAST(event_id % 120 AS STRING)
 || ',"operation":"' || CASE event_id % 4 WHEN 0 THEN 'read' WHEN 1 THEN 'create' WHEN 2 THEN 'edit' ELSE 'write' END
 || '","file_path":"/p/f' || CAST(event_id % 50 AS STRING) || '.py","project_path":"/p/proj' || CAST(user_id % 9 AS STRING)
 || '","git_branch":"b' || CAST(user_id % 3 AS STRING) || '","user":"u' || CAST(user_id AS STRING)
 || '","result_type":"' || CASE WHEN event_id % 10 = 0 THEN 'error' ELSE 'success' END
 || '","error_type":"E' || CAST(event_id % 5 AS STRING) || '","error_message":"m' || CAST(event_id % 3 AS STRING) || '"'
 || CASE WHEN event_id % 4 = 0 THEN ',"recovery_action":"retry"' ELSE '' END || '}' AS feature_json,
 value / 1000 AS revenue_impact,
 CASE WHEN event_id % 3 = 0 THEN 'art' || CAST(event_id % 100 AS STRING) END AS link
FROM events
"""

STREAM_V2 = """
SELECT 'v' || CAST(event_id AS STRING) AS activity_id, ts,
 CASE event_id % 12 WHEN 0 THEN 'query_complete' WHEN 1 THEN 'query_error' WHEN 2 THEN 'tool_call' WHEN 3 THEN 'llm_call' WHEN 4 THEN 'file_op'
  WHEN 5 THEN 'claude_session_start' WHEN 6 THEN 'claude_session_end' WHEN 7 THEN 'mcp_call' WHEN 8 THEN 'get_context' WHEN 9 THEN 'system_event' WHEN 10 THEN 'session_heartbeat' ELSE 'tool_call' END AS activity,
 'c' || CAST(user_id AS STRING) AS customer, 'host' || CAST(user_id % 40 AS STRING) || '.local' AS anonymous_customer_id,
 '{"tool_name":"tool' || CAST(event_id % 7 AS STRING) || '","latency_ms":' || CASE WHEN event_id % 97 = 0 THEN '"n/a"' ELSE CAST(CAST(FLOOR(value * 10) AS BIGINT) AS STRING) END
 || ',"success":' || CASE WHEN event_id % 9 = 0 THEN 'false' ELSE 'true' END
 || ',"model":"' || CASE event_id % 4 WHEN 0 THEN 'claude-3-opus' WHEN 1 THEN 'claude-3-sonnet' WHEN 2 THEN 'claude-3-haiku' ELSE 'gpt-4' END
 || '","prompt_tokens":' || CAST(event_id % 900 AS STRING) || ',"completion_tokens":' || CAST(event_id % 400 AS STRING)
 || ',"total_tokens":' || CAST(event_id % 900 + event_id % 400 AS STRING)
 || ',"query_id":"q' || CAST(event_id AS STRING) || '","rows":' || CAST(event_id % 500 AS STRING) || ',"sql":"SELECT ' || CAST(event_id AS STRING) || '"'
 || ',"cache_hit":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END || ',"cache_age_ms":' || CAST(event_id % 60000 AS STRING) || ',"stale":' || CASE WHEN event_id % 5 = 0 THEN 'true' ELSE 'false' END
 || ',"event_type":"' || CASE event_id % 3 WHEN 0 THEN 'backpressure' WHEN 1 THEN 'schema_drift' ELSE 'queue_rotation' END
 || '","severity":"' || CASE event_id % 4 WHEN 0 THEN 'info' WHEN 1 THEN 'warning' WHEN 2 THEN 'error' ELSE 'critical' END
 || '","operation":"' || CASE event_id % 6 WHEN 0 THEN 'read' WHEN 1 THEN 'write' WHEN 2 THEN 'create' WHEN 3 THEN 'edit' WHEN 4 THEN 'delete' ELSE 'rename' END
 || '","file_path":"/p/f' || CAST(event_id % 50 AS STRING) || '.py","bytes_before":' || CAST(event_id % 1000 AS STRING) || ',"bytes_after":' || CAST(event_id % 1300 AS STRING) || '}' AS feature_json,
 CASE WHEN event_id % 2 = 0 THEN value / 1000 END AS revenue_impact,
 CASE WHEN event_id % 3 = 0 THEN 'art' || CAST(event_id % 100 AS STRING) END AS link
FROM events
"""

# Every event has one history row; start times lie up to 8 minutes to either side.
QUERY_HISTORY = """
SELECT 'h' || CAST(event_id AS STRING) AS query_id, 'cdesk:q' || CAST(event_id AS STRING) AS query_tag,
 ts + (event_id % 17 - 8) * INTERVAL '1' MINUTE AS start_time, 'SELECT ' || CAST(event_id AS STRING) AS query_text,
 'db' || CAST(event_id % 2 AS STRING) AS database_name, 'sch' || CAST(event_id % 4 AS STRING) AS schema_name,
 'wh' || CAST(event_id % 3 AS STRING) AS warehouse_name, CASE WHEN event_id % 2 = 0 THEN 'S' ELSE 'L' END AS warehouse_size,
 'STANDARD' AS warehouse_type, event_id % 100000 AS bytes_scanned, event_id % 70000 AS bytes_written,
 event_id % 500 AS rows_produced, event_id % 13 AS rows_inserted, event_id % 11 AS rows_updated, event_id % 7 AS rows_deleted,
 value AS credits_used_cloud_services, CAST(FLOOR(value * 10) AS BIGINT) AS execution_time,
 event_id % 90 AS compilation_time, event_id % 3 AS queued_provisioning_time, event_id % 2 AS queued_repair_time,
 event_id % 5 AS queued_overload_time, event_id % 19 AS list_external_files_time,
 CASE WHEN event_id % 5 = 0 THEN 'E' || CAST(event_id % 4 AS STRING) END AS error_code,
 CASE WHEN event_id % 5 = 0 THEN 'failed ' || CAST(event_id % 4 AS STRING) END AS error_message
FROM events
"""

INSIGHT_ATOMS = """
SELECT 'i' || CAST(event_id AS STRING) AS id, ts, 'c' || CAST(user_id AS STRING) AS customer,
 'subj' || CAST(event_id % 4 AS STRING) AS subject, 'm' || CAST(event_id % 5 AS STRING) AS metric, value,
 CAST(event_id % 100 AS DOUBLE) / 100 AS confidence, CASE WHEN event_id % 2 = 0 THEN 'art' || CAST(event_id % 100 AS STRING) END AS artifact_id,
 ts + (event_id % 20) * INTERVAL '1' DAY AS valid_until, event_id % 7 = 0 AS is_stale, event_id % 11 = 0 AS is_quarantined
FROM events
"""

# The same table a day later: new insights, some re-rated, expired ones gone.
INSIGHT_ATOMS_LATER = """
SELECT id, ts, customer, subject, metric, value,
 CASE WHEN subject = 'subj1' THEN confidence / 2 ELSE confidence END AS confidence,
 artifact_id, valid_until, is_stale, is_quarantined
FROM insight_atoms WHERE valid_until > TIMESTAMP '2024-01-03 00:00:00'
UNION ALL
SELECT id || 'b' AS id, ts + INTERVAL '1' DAY AS ts, customer, subject, metric, value * 2 AS value, confidence,
 artifact_id, valid_until + INTERVAL '1' DAY AS valid_until, FALSE AS is_stale, FALSE AS is_quarantined
FROM insight_atoms WHERE subject = 'subj2'
"""

ARTIFACTS = """
SELECT 'art' || CAST(event_id AS STRING) AS artifact_id, ts AS created_ts, 'c' || CAST(user_id AS STRING) AS customer,
 CASE WHEN event_id % 9 <> 0 THEN ts + (event_id % 30) * INTERVAL '1' DAY END AS expires_at, event_id % 6 = 0 AS is_pinned, event_id % 4 AS access_count
FROM events
"""

KNOWLEDGE_BASE = """
SELECT 'k' || CAST(event_id AS STRING) AS kb_id, ts AS created_ts,
 CASE event_id % 8 WHEN 0 THEN 'Find orphan rows' WHEN 1 THEN 'Show COST by user' WHEN 2 THEN 'list session length' WHEN 3 THEN 'tool counts'
  WHEN 4 THEN 'executive summary' WHEN 5 THEN 'usage trend' WHEN 6 THEN 'metric dashboard' ELSE 'hello' END AS user_prompt,
 'SELECT ' || CAST(event_id % 20 AS STRING) AS generated_query, event_id % 6 <> 0 AS query_success, event_id % 5 AS result_count,
 CAST(FLOOR(value * 10) AS BIGINT) AS execution_time_ms,
 CASE event_id % 3 WHEN 0 THEN 'excellent' WHEN 1 THEN 'good' END AS user_rating
FROM events
"""

# A context of every customer, of one of two types; some were last refreshed at the first event, some at the last.
CONTEXT_CACHE = """
SELECT 'c' || CAST(user_id AS STRING) AS customer, CASE WHEN user_id % 4 = 0 THEN 'brief' ELSE 'default' END AS context_type, '{}' AS context_blob,
 CASE WHEN user_id % 3 = 0 THEN MIN(ts) ELSE MAX(ts) END AS updated_at, COUNT(*) AS access_count, user_id % 11 = 0 AS is_stale
FROM events GROUP BY user_id
"""

# A stream of question-to-SQL and SQL-execution events.
META_STREAM = """
SELECT 'q' || CAST(event_id AS STRING) AS activity_id, ts,
 CASE WHEN event_type IN ('click', 'view') THEN 'claude_meta_query' ELSE 'claude_sql_execution' END AS activity,
 's' || CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS customer,
 'host' || CAST(user_id % 40 AS STRING) || '.local' AS anonymous_customer_id,
 '{"prompt":"' || CASE event_id % 3 WHEN 0 THEN 'how many query rows' WHEN 1 THEN 'top tools' ELSE 'show query cost' END
 || '","query_generated":"SELECT tool_name, count(*) FROM activity_stream WHERE user_id = ' || CAST(user_id AS STRING)
 || ' AND duration_ms > ' || CAST(CAST(FLOOR(value * 10) AS BIGINT) AS STRING) || ' GROUP BY tool_name ORDER BY tool_name"'
 || ',"success":' || CASE WHEN event_id % 4 = 0 THEN 'false' ELSE 'true' END || ',"rows_affected":' || CAST(event_id % 6 AS STRING) || '}' AS feature_json,
 value / 1000 AS revenue_impact, CAST(NULL AS STRING) AS link
FROM events
"""

# One queued file per event; a check runs at every full hour on every host.
BACKLOG = """
SELECT 'host' || CAST(user_id % 40 AS STRING) || '.local' AS host,
 date_trunc('hour', ts) + INTERVAL '1' HOUR AS checked_at, 'f' || CAST(event_id AS STRING) AS file, ts AS marked_at
FROM events
"""

# Runs of a scheduled job.
JOB_RUNS = """
SELECT 'refresh_' || CAST(o_custkey % 5 AS STRING) AS job_name,
 CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCEEDED' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'SKIPPED' ELSE 'EXECUTING' END END AS state,
 o_orderdate AS scheduled_time,
 CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + (o_orderkey % 600) * INTERVAL '1' SECOND END AS completed_time,
 CASE WHEN o_orderstatus = 'F' THEN 'error ' || CAST(o_orderkey % 4 AS STRING) END AS error_message,
 o_orderkey AS run_id
FROM orders
"""

# NDJSON lines: optional fields are missing, some lines are cut, some ids repeat.
NDJSON_LINES = """
SELECT CASE
 WHEN event_id % 13 = 0 THEN '{"activity_id":"n' || CAST(event_id AS STRING) || '","activity":'
 ELSE '{"activity_id":"n' || CAST(event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END AS STRING)
  || '","ts":"' || CAST(ts AS STRING) || '","activity":"' || event_type || '","customer":"c' || CAST(user_id AS STRING) || '"'
  || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',"anonymous_customer_id":"host' || CAST(user_id % 40 AS STRING) || '"' END
  || CASE WHEN event_id % 5 = 0 THEN '' ELSE ',"feature_json":{"k":' || CAST(event_id % 50 AS STRING) || ',"s":"x' || CAST(event_id % 9 AS STRING) || '"}' END
  || CASE WHEN event_id % 2 = 0 THEN '' ELSE ',"revenue_impact":' || CAST(event_id % 100 AS STRING) || '.5' END
  || CASE WHEN event_id % 7 = 0 THEN ',"link":"art' || CAST(event_id % 100 AS STRING) || '"' ELSE '' END || '}' END AS value
FROM events
"""

# One JSON line per conversation turn; user turns are errors, system turns plain text.
AGENT_LINES = """
SELECT 'conv' || CAST(conv_id AS STRING) AS session_id, turn AS line_no,
 TIMESTAMP '2024-01-01 00:00:00' + (conv_id * 60 + turn * 3) * INTERVAL '1' SECOND AS ts,
 CASE role
  WHEN 'assistant' THEN '{"type":"tool_use"' || CASE WHEN turn % 5 = 0 THEN '' ELSE ',"tool":"t' || CAST(turn % 4 AS STRING) || '"' END
   || CASE WHEN conv_id % 3 = 0 THEN '' ELSE ',"parameters":{"n":' || CAST(turn AS STRING) || ',"size":' || CAST(length(text) AS STRING) || '}' END || '}'
  WHEN 'user' THEN CASE WHEN turn % 4 = 0 THEN '{"type":"error","message":"bad ' || CAST(length(text) AS STRING) || '"}' ELSE '{"type":"text","size":' || CAST(length(text) AS STRING) || '}' END
  ELSE text END AS value
FROM conversations
"""

# Plain output lines; the whole turn text follows the marker.
OUTPUT_LINES = """
SELECT 'conv' || CAST(conv_id AS STRING) AS session_id, turn AS line_no,
 TIMESTAMP '2024-01-01 00:00:00' + (conv_id * 60 + turn * 3) * INTERVAL '1' SECOND AS ts,
 CASE WHEN role = 'assistant' AND turn % 3 = 0 THEN 'Running tool: grep ' || text
  WHEN role = 'assistant' THEN 'Running tool: Edit' || CAST(turn AS STRING) || ' ' || text
  WHEN role = 'user' AND turn % 4 = 0 THEN 'Reading ' || text
  WHEN role = 'user' AND turn % 4 = 2 THEN 'Executing ' || text ELSE text END AS value
FROM conversations
"""

# Model answers: a fenced block, a bare statement, or prose only; some unsafe.
MODEL_ANSWERS = """
SELECT CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS answer_id,
 CASE WHEN role = 'assistant' THEN text || chr(10) || '```sql' || chr(10) || 'SELECT ' || CAST(turn AS STRING) || chr(10) || 'FROM t' || CAST(conv_id % 7 AS STRING)
   || chr(10) || '```' || chr(10) || 'done'
  WHEN turn % 4 = 0 THEN 'Answer' || chr(10) || 'SELECT count(*)' || chr(10) || 'FROM s' || CAST(conv_id % 5 AS STRING) || ';' || chr(10) || 'as asked'
  WHEN turn % 4 = 2 THEN 'Use' || chr(10) || CASE conv_id % 3 WHEN 0 THEN 'DELETE FROM s' WHEN 1 THEN 'UPDATE s SET a = 1' ELSE 'CREATE TABLE z AS SELECT 1' END || ';'
  ELSE text END AS answer
FROM conversations
"""

# Result sets as tables: one artifact per event type, rows ordered by (ts, event_id).
RESULT_ROWS = """
SELECT event_type AS artifact_id, ts, event_id, props AS row_json FROM events
"""

TABLES = {
    "activity_stream": ACTIVITY_STREAM,
    "stream_v2": STREAM_V2,
    "query_history": QUERY_HISTORY,
    "insight_atoms": INSIGHT_ATOMS,
    "insight_atoms_later": INSIGHT_ATOMS_LATER,
    "artifacts": ARTIFACTS,
    "knowledge_base": KNOWLEDGE_BASE,
    "context_cache": CONTEXT_CACHE,
    "meta_stream": META_STREAM,
    "backlog": BACKLOG,
    "job_runs": JOB_RUNS,
    "ndjson_lines": NDJSON_LINES,
    "agent_lines": AGENT_LINES,
    "output_lines": OUTPUT_LINES,
    "model_answers": MODEL_ANSWERS,
    "result_rows": RESULT_ROWS,
}
_BASE = {"job_runs": "orders", "agent_lines": "conversations", "output_lines": "conversations",
         "model_answers": "conversations", "insight_atoms_later": "insight_atoms"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stream table ``name`` over the Parquet files in ``sf_dir``."""
    base = _BASE.get(name, "events")
    if base in TABLES:
        source = load(spark, sf_dir, base)
    else:
        source = spark.read.parquet(f"{sf_dir}/{base}.parquet")
    source.createOrReplaceTempView(base)
    return spark.sql(TABLES[name])
