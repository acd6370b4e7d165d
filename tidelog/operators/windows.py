"""Occurrence tracking, self-study detection, deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import vocab
from ..functions import opt, payload_of, ts_diff
from ..plans.prefix import running_number, running_peers
from ..plans.stored import stored
from ..plans.upsert import keep_first

__all__ = ["activity_occurrences", "self_study_sessions", "dedup_keep_first", "running_number"]


def dedup_keep_first(df: DataFrame, key: str = "activity_id", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    return keep_first(df, key, list(order))


def activity_occurrences(stream: DataFrame, activity: str | None = None, unit: str = "hour") -> DataFrame:
    """Fills ``activity_occurrence`` and ``activity_repeated_at`` where they are NULL.

    The first is the number of rows of the same customer and activity up to this
    instant, the second the next later instant of the same.  A customer is cut
    into ``unit`` buckets, so that one very busy customer is many tasks.  With
    ``activity`` given, only its rows are windowed and filled; others pass unchanged.
    """
    chosen = F.lit(True) if activity is None else F.col("activity").eqNullSafe(activity)
    done = running_peers(stream.where(chosen), ["customer", "activity"], "ts", unit, "_count", "_next")
    if activity is not None:
        done = done.unionByName(stream.where(~chosen), allowMissingColumns=True)
    old_count = opt(stream, "activity_occurrence", "bigint")
    old_next = opt(stream, "activity_repeated_at", "timestamp_ntz")
    return (
        done.withColumn("activity_occurrence", F.coalesce(old_count, "_count"))
        .withColumn("activity_repeated_at", F.coalesce(old_next, "_next"))
        .drop("_count", "_next")
    )


def self_study_sessions(stream: DataFrame, project_like: str, levels: Sequence[str] = ("minute", "hour", "day")) -> DataFrame:
    """For each session start in a matching project: how many other sessions began
    earlier, and the minutes since the latest of them.

    Equal to joining all starts with all earlier starts of other sessions, without
    the pairs.  The stream is read once, for a table of its starts in the work folder.  Time is cut into
    buckets of the first level, inside which an ordered window gives (a) first starts so far and (b) the latest earlier
    start of another session.  What precedes a bucket is carried from level to level: minutes inside
    their hour, hours inside their day, days; a bucket hands on two rows, so no window holds more than its level has buckets.
    """
    p = payload_of(
        stream.where((F.col("activity") == vocab.SESSION_START) & F.col("customer").isNotNull()), "project_path"
    )
    starts = p.df.select("customer", "ts", p.text("project_path").like(project_like).alias("study"))
    starts = stored(starts.groupBy("customer", "ts").agg(F.max("study").alias("study")), "session-starts")
    firsts = starts.groupBy("customer").agg(F.min("ts").alias("first_ts"))
    study = starts.where("study").select("customer", "ts")

    # One row per instant: lowest and highest customer starting then, first starts then.
    none = F.lit(None).cast("string")
    ticks = (
        starts.select("ts", F.col("customer").alias("lo"), F.col("customer").alias("hi"), F.lit(0).alias("n"))
        .unionByName(firsts.select(F.col("first_ts").alias("ts"), none.alias("lo"), none.alias("hi"), F.lit(1).alias("n")))
        .groupBy("ts")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))
        .select(F.date_trunc(levels[0], "ts").alias("b"), "*")
    )
    inside = Window.partitionBy("b").orderBy("ts")
    state = _with_previous(ticks, inside).withColumn(
        "earlier", F.coalesce(F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("b", "ts", "earlier", *[F.col(c).alias(f"in_{c}") for c in _STATE])

    newest = starts.groupBy(F.date_trunc(levels[0], "ts").alias("b"), "customer").agg(F.max("ts").alias("ts"))
    counts = firsts.groupBy(F.date_trunc(levels[0], "first_ts").alias("b")).agg(F.count("*").alias("n"))
    sides = ["in"]
    for level, above in zip(levels, [*levels[1:], None]):
        newest = newest.groupBy(F.date_trunc(level, "b").alias("b"), "customer").agg(F.max("ts").alias("ts"))
        place = Window.partitionBy("b").orderBy(F.desc("ts"), F.asc("customer"))
        newest = newest.withColumn("place", F.row_number().over(place)).where("place <= 2").drop("place")
        counts = counts.groupBy(F.date_trunc(level, "b").alias("b")).agg(F.sum("n").alias("n"))
        carried = _carry(newest, counts, above).withColumnsRenamed({"before": f"{level}_before", **{c: f"{level}_{c}" for c in _STATE}})
        state = state.withColumn("_bucket", F.date_trunc(level, "b")).join(carried.withColumnRenamed("b", "_bucket"), "_bucket", "left").drop("_bucket")
        sides.append(level)
    earlier = F.col("earlier")
    for level in levels:
        earlier = earlier + F.coalesce(f"{level}_before", F.lit(0))
    other = F.coalesce(*[_foreign(side) for side in sides])
    return (
        study.join(state, "ts")
        .join(firsts, "customer")
        .select(
            F.col("customer").alias("analyzing_session"), F.col("ts").alias("analysis_time"),
            (earlier - F.when(F.col("first_ts") < F.col("ts"), 1).otherwise(0)).alias("sessions_studied"),
            ts_diff("minute", other, F.col("ts")).alias("minutes_after_latest"),
        )
        .where(F.col("sessions_studied") > 0)
    )


_STATE = ("prev_ts", "prev_lo", "prev_hi", "prev_change")


def _with_previous(rows: DataFrame, order) -> DataFrame:
    """Adds the previous instant, who started then, and the latest instant before
    it at which somebody else did (``prev_change``)."""
    prev = rows.select(
        "*", F.lag("ts").over(order).alias("prev_ts"), F.lag("lo").over(order).alias("prev_lo"),
        F.lag("hi").over(order).alias("prev_hi"),
    )
    same = (F.col("prev_lo") == F.col("prev_hi")) & (F.col("lo") == F.col("hi")) & (F.col("lo") == F.col("prev_lo"))
    change = F.when(~same, F.col("prev_ts"))
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return prev.withColumn("_change", F.max(change).over(running)).withColumn(
        "prev_change", F.lag("_change").over(order)
    )


def _foreign(side: str):
    """Latest instant of the given state at which somebody other than ``customer`` started."""
    who = F.col("customer")
    only_self = (F.col(f"{side}_prev_lo") == who) & (F.col(f"{side}_prev_hi") == who)
    return F.when(only_self, F.col(f"{side}_prev_change")).otherwise(F.col(f"{side}_prev_ts"))


def _carry(two: DataFrame, first_counts: DataFrame, above: str | None) -> DataFrame:
    """State before each bucket inside its bucket of the level ``above``: number of first starts, and the newest
    instants of two different customers, which is all a later row can need."""
    two = two.groupBy("b", "ts").agg(F.min("customer").alias("lo"), F.max("customer").alias("hi"))
    two = two.withColumn("_above", F.date_trunc(above, "b") if above else F.lit(0))
    ends = _with_previous(two, Window.partitionBy("_above").orderBy("ts")).groupBy("_above", "b").agg(
        F.max("ts").alias("ts"), F.max_by("lo", "ts").alias("lo"), F.max_by("hi", "ts").alias("hi"),
        F.max_by("_change", "ts").alias("change"),
    )
    by_bucket = Window.partitionBy("_above").orderBy("b")
    return ends.join(first_counts, "b", "left").select(
        "b",
        F.coalesce(F.sum("n").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.lag("ts").over(by_bucket).alias("prev_ts"), F.lag("lo").over(by_bucket).alias("prev_lo"),
        F.lag("hi").over(by_bucket).alias("prev_hi"), F.lag("change").over(by_bucket).alias("prev_change"),
    )
