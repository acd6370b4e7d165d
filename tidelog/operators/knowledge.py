"""The knowledge base of questions and generated SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import vocab
from ..functions import day_of


def prompt_pattern(prompt: Column) -> Column:
    text, code = F.lower(prompt), F.lit(vocab.DEFAULT_PATTERN)
    for words, name in reversed(vocab.PROMPT_PATTERNS):
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        code = F.when(hit, name).otherwise(code)
    return code


def classify_prompts(df: DataFrame, column: str = "user_prompt") -> DataFrame:
    """Adds the pattern of each prompt."""
    return df.withColumn("common_pattern", prompt_pattern(F.col(column)))


def executive_templates(kb: DataFrame, ordered: bool = True) -> DataFrame:
    """Successful management questions, best rated and fastest first unless ``ordered=False``."""
    text, hit = F.lower("user_prompt"), F.lit(False)
    for word in vocab.EXECUTIVE_WORDS:
        hit = hit | text.contains(word)
    rank = F.when(F.col("user_rating") == "excellent", 1).when(F.col("user_rating") == "good", 2).otherwise(3)
    rows = kb.where(F.col("query_success") & hit)
    return (
        (rows.orderBy(rank, F.asc("execution_time_ms")) if ordered else rows)
        .select("user_prompt", "generated_query", "result_count", "execution_time_ms", "created_ts")
    )


def pattern_examples(kb: DataFrame) -> DataFrame:
    """Distinct (pattern, kind, text) rows: the prompts and queries of each pattern."""
    texts = F.array(
        F.struct(F.lit("prompt").alias("kind"), F.col("user_prompt").alias("text")),
        F.struct(F.lit("query").alias("kind"), F.col("generated_query").alias("text")),
    )
    return (
        kb.where("query_success").select("common_pattern", F.explode(texts).alias("e"))
        .select("common_pattern", "e.kind", "e.text").where(F.col("text").isNotNull()).distinct()
    )


def successful_patterns(kb: DataFrame, examples: bool = False) -> DataFrame:
    """Patterns of successful questions.

    ``examples=True`` adds all distinct prompts and queries of a pattern as arrays.
    An array is one cell in one task, so this is for knowledge bases whose texts
    fit one; ``pattern_examples`` gives them as rows at any size.
    """
    good = kb.where("query_success")
    stats = good.groupBy("common_pattern").agg(
        F.count("*").alias("usage_count"), F.avg("execution_time_ms").alias("avg_execution_ms"),
        (F.count_if("query_success") / F.count("*")).alias("success_rate"),
        F.countDistinct("user_prompt").alias("distinct_prompts"),
        F.countDistinct("generated_query").alias("distinct_queries"),
    )
    if not examples:
        return stats
    for column, name in (("user_prompt", "example_prompts"), ("generated_query", "example_queries")):
        texts = (
            good.select(F.col("common_pattern").alias("_pattern"), column).distinct()
            .groupBy("_pattern").agg(F.array_sort(F.collect_list(column)).alias(name))
        )
        stats = stats.join(texts, F.col("common_pattern").eqNullSafe(F.col("_pattern")), "left").drop("_pattern")
    return stats


def learning_opportunities(kb: DataFrame, ordered: bool = True) -> DataFrame:
    """Failed questions and successful ones without rows, newest first unless ``ordered=False``."""
    issue = F.when(~F.col("query_success"), "Query Failed").when(F.col("result_count") == 0, "No Results")
    out = kb.select("user_prompt", "generated_query", "created_ts", issue.alias("issue_type")).where(F.col("issue_type").isNotNull())
    return out.orderBy(F.desc("created_ts")) if ordered else out


def intelligence_metrics(kb: DataFrame) -> DataFrame:
    """Question volume and success by day, cumulative and over seven rows."""
    days = kb.groupBy(day_of("created_ts").alias("query_date")).agg(
        F.count("*").alias("total_queries"), F.count_if("query_success").alias("good"),
        F.avg("execution_time_ms").alias("avg_exec_time"), F.countDistinct("common_pattern").alias("pattern_diversity"),
    )
    order = Window.orderBy("query_date")  # over one row per day
    rate = F.col("good") / F.nullif("total_queries", F.lit(0))
    return days.select(
        "query_date", "total_queries", rate.alias("success_rate"), "avg_exec_time", "pattern_diversity",
        F.sum("total_queries").over(order).alias("cumulative_queries"),
        F.avg(rate).over(order.rowsBetween(-6, 0)).alias("rolling_7day_success_rate"),
    )


def log_queries(df: DataFrame, as_of=None) -> DataFrame:
    """Knowledge-base rows for a batch of questions (prompt, query, success, row_count, exec_time)."""
    from ..functions import bound, stable_id

    return df.select(
        stable_id(bound(as_of), *(F.col(c) for c in ("prompt", "query", "success", "row_count", "exec_time"))).alias("kb_id"), bound(as_of).alias("created_ts"), F.col("prompt").alias("user_prompt"),
        F.col("query").alias("generated_query"), F.col("success").alias("query_success"),
        F.col("row_count").alias("result_count"), F.col("exec_time").alias("execution_time_ms"),
        F.lit(None).cast("string").alias("user_rating"), prompt_pattern(F.col("prompt")).alias("common_pattern"),
    )


def seed_knowledge_base(kb: DataFrame) -> DataFrame:
    """``kb``, or the seed questions where it is empty."""
    spark = kb.sparkSession
    seeds = spark.createDataFrame(
        [(f"seed-{i}", *row) for i, row in enumerate(vocab.SEED_PROMPTS)],
        "kb_id string, user_prompt string, result_count bigint, execution_time_ms bigint, common_pattern string",
    ).withColumn("query_success", F.lit(True))
    guard = kb.limit(1).select(F.lit(True).alias("_any"))
    wanted = seeds.join(guard, F.col("_any"), "left_anti")
    return kb.unionByName(wanted, allowMissingColumns=True)
