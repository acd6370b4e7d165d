"""Fixed values of the event vocabulary.

Everything here is a constant that must match the data: activity names, payload
field contracts, price tables and thresholds.  Operators take them as default
arguments, so a stream with another vocabulary can pass its own.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# First-generation stream: activity names.
SESSION_START = "claude_session_start"
SESSION_END = "claude_session_end"
TOOL_CALL = "claude_tool_call"
FILE_OPERATION = "claude_file_operation"
ERROR = "claude_error"
META_QUERY = "claude_meta_query"
SQL_EXECUTION = "claude_sql_execution"
# Name prefixes; the character after each prefix may be anything.
STREAM_PREFIX = "claude"
LEGACY_PREFIX = "ccode"
SESSION_PREFIX = "claude_session"

# Second-generation stream: activity names of each typed family.
SQL_ACTIVITIES = ("query_complete", "query_submitted", "sql_execution", "claude_sql_execution")
LLM_ACTIVITIES = ("user_asked", "claude_responded", "llm_call", "llm_response")
TOOL_ACTIVITIES = ("claude_tool_call", "tool_call", "tool_execution")
FILE_ACTIVITIES = ("claude_file_operation", "file_op", "file_operation")
SESSION_ACTIVITIES = ("claude_session_start", "claude_session_end", "session_heartbeat", "claude_context_hydration")
MCP_ACTIVITIES = ("mcp_call", "get_context", "refresh_context", "store_artifact")
SYSTEM_ACTIVITIES = (
    "system_backpressure",
    "schema_drift_detected",
    "queue_rotation",
    "artifact_cleanup",
    "error_recovery",
    "system_event",
)
HYDRATION = "claude_context_hydration"
BACKPRESSURE = "system_backpressure"
SCHEMA_DRIFT = "schema_drift_detected"
SYSTEM_CUSTOMER = "SYSTEM"
QUERY_TAG_PREFIX = "cdesk:"

# Model name fragment -> (prompt, completion) price in USD per 1000 tokens.
MODEL_PRICES = {
    "opus": (0.015, 0.075),
    "sonnet": (0.003, 0.015),
    "haiku": (0.00025, 0.00125),
}
USD_PER_CREDIT = 0.00003
USD_PER_SESSION_TOKEN = 0.000003
USD_PER_CREDIT_REPORTED = 3

# Operations that count as written lines.
WRITE_OPERATIONS = ("create", "edit", "write")

# Ordered prompt classifier: the first row with a contained word wins.
PROMPT_PATTERNS = (
    (("orphan",), "orphan_analysis"),
    (("cost",), "cost_analysis"),
    (("session",), "session_analysis"),
    (("tool",), "tool_usage"),
    (("metric", "executive"), "executive_metrics"),
    (("trend", "time"), "trend_analysis"),
)
DEFAULT_PATTERN = "general_query"
EXECUTIVE_WORDS = ("executive", "cost", "metric", "dashboard", "summary")
# Prompt -> (statement kind, rows, ms, pattern) rows that seed an empty knowledge base.
SEED_PROMPTS = (
    ("show executive metrics", 1, 120, "executive_metrics"),
    ("find orphaned sessions", 45, 230, "orphan_analysis"),
    ("calculate costs", 1, 89, "cost_analysis"),
    ("show usage trends", 30, 156, "trend_analysis"),
)

# Expected payload keys of the drift check.
EXPECTED_TYPES = {
    "tool_name": "STRING",
    "parameters": "OBJECT",
    "latency_ms": "NUMBER",
    "success": "BOOLEAN",
    "error": "STRING",
    "warehouse": "STRING",
    "role": "STRING",
    "bytes_scanned": "NUMBER",
    "rows": "NUMBER",
    "model": "STRING",
    "prompt_tokens": "NUMBER",
    "completion_tokens": "NUMBER",
}

# Payload contracts: family -> (required fields, field types, allowed values).
CONTRACTS = {
    "sql_event": (
        ("query_id", "sql", "success"),
        {
            "query_id": "string", "sql": "string", "warehouse": "string", "role": "string", "database": "string",
            "schema": "string", "rows": "number", "bytes_scanned": "number", "duration_ms": "number",
            "credits_used": "number", "success": "boolean", "error": "string", "error_code": "string",
        },
        {},
    ),
    "llm_event": (
        ("model", "prompt_tokens", "completion_tokens"),
        {
            "model": "string", "prompt_hash": "string", "prompt_tokens": "number", "completion_tokens": "number",
            "total_tokens": "number", "latency_ms": "number", "total_latency_ms": "number", "cost_usd": "number",
            "temperature": "number", "max_tokens": "number", "stream": "boolean",
        },
        {"model": ("claude-3-opus", "claude-3-sonnet", "claude-3-haiku", "gpt-4", "gpt-3.5-turbo")},
    ),
    "tool_event": (
        ("tool_name", "success"),
        {
            "tool_name": "string", "tool_category": "string", "parameters": "object", "success": "boolean",
            "latency_ms": "number", "error": "string", "result_size": "number", "result_type": "string",
        },
        {"tool_category": ("file", "search", "execute", "analyze", "transform")},
    ),
    "file_event": (
        ("operation", "file_path"),
        {
            "operation": "string", "file_path": "string", "file_type": "string", "lines_affected": "number",
            "bytes_before": "number", "bytes_after": "number", "success": "boolean", "git_tracked": "boolean",
            "git_branch": "string",
        },
        {"operation": ("read", "write", "create", "edit", "delete", "rename")},
    ),
    "session_event": (
        ("session_id", "event_type"),
        {
            "session_id": "string", "event_type": "string", "project_path": "string", "user": "string",
            "host": "string", "cli_version": "string", "total_activities": "number", "total_tokens": "number",
            "session_duration_ms": "number",
        },
        {"event_type": ("start", "end", "heartbeat", "context_hydration")},
    ),
    "mcp_event": (
        ("method", "latency_ms"),
        {
            "method": "string", "cache_hit": "boolean", "cache_age_ms": "number", "latency_ms": "number",
            "stale": "boolean", "context_size": "number",
        },
        {"method": ("get_context", "query", "store_artifact", "refresh_context")},
    ),
    "system_event": (
        ("event_type",),
        {
            "event_type": "string", "severity": "string", "message": "string", "metrics": "object",
            "action_taken": "string",
        },
        {
            "event_type": ("backpressure", "schema_drift", "queue_rotation", "artifact_cleanup", "error_recovery"),
            "severity": ("info", "warning", "error", "critical"),
        },
    ),
}
FAMILY_ACTIVITIES = {
    "sql_event": SQL_ACTIVITIES,
    "llm_event": LLM_ACTIVITIES,
    "tool_event": TOOL_ACTIVITIES,
    "file_event": FILE_ACTIVITIES,
    "session_event": SESSION_ACTIVITIES,
    "mcp_event": MCP_ACTIVITIES,
    "system_event": SYSTEM_ACTIVITIES,
}

# Activity definitions: name, description, field -> type.
ACTIVITY_DEFINITIONS = (
    ("claude_session_start",
     {"session_id": "string", "project_path": "string", "git_branch": "string", "user": "string", "host": "string"}),
    ("claude_tool_call",
     {"tool_name": "string", "parameters": "object", "result_type": "string", "duration_ms": "number",
      "tokens_used": "number"}),
    ("claude_file_operation",
     {"operation": "string", "file_path": "string", "lines_affected": "number", "success": "boolean"}),
    ("claude_decision",
     {"decision_type": "string", "confidence_score": "number", "alternatives_considered": "array",
      "reasoning": "string"}),
    ("claude_sql_execution",
     {"database": "string", "query_type": "string", "tables_affected": "array", "rows_affected": "number"}),
    ("claude_error",
     {"error_type": "string", "error_message": "string", "stack_trace": "string", "recovery_action": "string"}),
    ("claude_session_end",
     {"session_id": "string", "total_activities": "number", "total_tokens": "number",
      "session_duration_ms": "number"}),
)

# Text patterns of agent output and of generated SQL.
RUNNING_TOOL = "Running tool: ([A-Za-z]+)"
ACTIVITY_VERBS = "Executing|Running|Creating|Writing|Reading"
DETECTED_TOOL_MS = 100
DETECTED_TOOL_TOKENS = 50
SQL_OPENERS = ("SELECT", "WITH", "CREATE", "INSERT", "UPDATE", "DELETE")
UNSAFE_SQL = "DROP|TRUNCATE|DELETE.*FROM|UPDATE.*SET"

# Thresholds and horizons.
BACKPRESSURE_MS = 120_000
DEGRADE_CHARS = 1024
LATENCY_SLO_MS = 25
CONTEXT_STALE_SECONDS = 30
SAMPLE_ROWS = 10
SAMPLE_MAX_CHARS = 131_072
SAMPLE_CUT_CHARS = 100
PAGE_ROWS = 1000
EXTERNAL_ROWS = 100
EXTERNAL_BYTES = 1_048_576
# -----------------------------------------------------------------------------
