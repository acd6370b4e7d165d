"""Agent logs, plain output lines and generated SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import vocab

_LOG_LINE = T.StructType([T.StructField(n, T.StringType()) for n in ("type", "tool", "parameters", "message")])


def _bounds(lines: DataFrame, counted: Column, tokens: Column) -> DataFrame:
    """One start and one end row per session."""
    sessions = lines.groupBy("session_id").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.count_if(counted).alias("total_activities"),
        F.coalesce(F.sum(tokens), F.lit(0)).alias("total_tokens"),
    )
    took = F.timestamp_diff("MILLISECOND", F.col("first"), F.col("last"))
    ends = F.array(
        F.struct(F.lit("session_start").alias("kind"), F.col("first").alias("ts"),
                 *[F.lit(None).cast("bigint").alias(n)
                   for n in ("total_activities", "total_tokens", "session_duration_ms")]),
        F.struct(F.lit("session_end").alias("kind"), F.col("last").alias("ts"),
                 F.col("total_activities").cast("bigint").alias("total_activities"),
                 F.col("total_tokens").cast("bigint").alias("total_tokens"), took.alias("session_duration_ms")),
    )
    return sessions.select("session_id", F.explode(ends).alias("e")).select("session_id", "e.*")


def parse_agent_log(lines: DataFrame) -> DataFrame:
    """Events of JSON log lines (session_id, ts, value).

    A ``tool_use`` line is a tool call, an ``error`` line a failed one that counts
    neither as activity nor in tokens; other lines and broken JSON give nothing.
    Every session also has a start and an end event.  Tokens are characters / 4.
    """
    parsed = lines.select("session_id", "ts", F.length("value").alias("chars"),
                          F.from_json("value", _LOG_LINE).alias("e"))
    used, failed = F.col("e.type") == "tool_use", F.col("e.type") == "error"
    tokens = F.floor(F.col("chars") / 4)
    given = F.when(F.col("e.parameters").isin("", "null", "0", "false", "[]"), None).otherwise(F.col("e.parameters"))
    message = F.to_json(F.struct(F.coalesce("e.message", F.lit("Unknown error")).alias("error")))
    calls = parsed.where(used | failed).select(
        "session_id", F.lit("tool_call").alias("kind"), "ts",
        F.when(failed, "error").otherwise(F.coalesce("e.tool", F.lit("unknown"))).alias("tool_name"),
        F.when(failed, message).otherwise(F.coalesce(given, F.lit("{}"))).alias("parameters"),
        F.when(failed, "error").otherwise("success").alias("result_type"),
        F.when(failed, 0).otherwise(vocab.DETECTED_TOOL_MS).cast("bigint").alias("duration_ms"),
        F.when(failed, F.lit(0)).otherwise(tokens).cast("bigint").alias("tokens_used"),
    )
    return calls.unionByName(_bounds(parsed, used, F.when(used, tokens)), allowMissingColumns=True)


def detect_tools_in_text(lines: DataFrame) -> DataFrame:
    """Events of plain output lines (session_id, ts, value).

    A line naming a running tool is a tool call; a line with an activity verb
    counts as an activity.  Tokens of a session are bytes / 4, one newline per line.
    """
    tool = F.regexp_extract("value", vocab.RUNNING_TOOL, 1)
    marked = lines.select(
        "session_id", "ts", tool.alias("tool"), F.col("value").rlike(vocab.ACTIVITY_VERBS).alias("active"),
        (F.octet_length("value") + 1).alias("bytes"),
    )
    named = F.col("tool") != ""
    calls = marked.where(named).select(
        "session_id", F.lit("tool_call").alias("kind"), "ts", F.col("tool").alias("tool_name"),
        F.lit('{"source":"output_parse"}').alias("parameters"), F.lit("success").alias("result_type"),
        F.lit(vocab.DETECTED_TOOL_MS).cast("bigint").alias("duration_ms"),
        F.lit(vocab.DETECTED_TOOL_TOKENS).cast("bigint").alias("tokens_used"),
    )
    ends = _bounds(marked, named | F.col("active"), F.col("bytes")).withColumn(
        "total_tokens", F.floor(F.col("total_tokens") / 4)
    )
    return calls.unionByName(ends, allowMissingColumns=True)


def screen_generated_sql(df: DataFrame, column: str = "answer") -> DataFrame:
    """SQL in a model answer, and whether it is safe to run.

    The SQL is all fenced blocks, else all stretches of lines from one that opens a
    statement to the one that ends it with a semicolon, whole and one after the
    other.  It is unsafe if any of it has a dangerous operation, in any case.
    """
    openers = "|".join(vocab.SQL_OPENERS)
    text = F.col(column)
    fenced = F.filter(F.regexp_extract_all(text, F.lit(r"(?s)```sql[^\n]*\n(.*?)\n?```"), 1), lambda x: x != "")
    bare = F.regexp_extract_all(text, F.lit(rf"(?sm)^((?:{openers}).*?)(?:;[ \t]*$|\z)"), 0)
    found = F.array_join(F.when(F.size(fenced) > 0, fenced).otherwise(bare), "\n")
    sql = F.nullif(F.trim(found), F.lit(""))
    return df.withColumn("generated_sql", sql).withColumn(
        "is_unsafe", F.coalesce(F.col("generated_sql").rlike(f"(?i){vocab.UNSAFE_SQL}"), F.lit(False))
    )
