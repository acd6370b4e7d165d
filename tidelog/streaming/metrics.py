"""Windowed metrics over an event stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import vocab
from ..functions import between, n_distinct, payload_of, span, trunc_ts
from ..plans.upsert import complete_versions, keep_first, write_version


def hourly_metrics(stream: DataFrame, watermark: str | None = None) -> DataFrame:
    """Tumbling one-hour measures per customer of a streaming or batch DataFrame.

    A streaming DataFrame with a ``watermark`` forgets hours that lie further back, and loses their late rows; without
    one it keeps all hours in its state.  ``hourly_metrics_stream`` does neither.
    """
    p = payload_of(stream.withColumn("at", F.col("ts").cast("timestamp")), "latency_ms", "success", "total_tokens")
    rows = p.df.select(
        "at", "customer", "activity", "revenue_impact", p.whole("latency_ms").alias("latency"),
        p.flag("success").alias("success"), p.whole("total_tokens").alias("tokens"),
    )
    if watermark is not None:
        rows = rows.withWatermark("at", watermark)
    return (
        rows.groupBy(F.window("at", "1 hour"), "customer")
        .agg(
            F.count("*").alias("total_activities"),
            n_distinct("activity", approx=stream.isStreaming).alias("activity_types"),
            F.percentile_approx("latency", 0.95, 10_000).alias("p95_latency_ms"),
            F.count_if("success").alias("successful_operations"),
            F.sum("tokens").alias("total_tokens"),
            F.sum("revenue_impact").alias("total_cost_credits"),
        )
        .select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "customer", "total_activities",
                "activity_types", "p95_latency_ms", "successful_operations", "total_tokens", "total_cost_credits")
    )


def touched_hours(batch: DataFrame, table: DataFrame) -> DataFrame:
    """The rows of ``table`` in the hours and customers that ``batch`` has rows of.

    The table is read between the first and the last touched hour only, on ``ts`` and on ``dt``.
    """
    hours = batch.select(trunc_ts("hour", "ts").alias("_hour"), F.col("customer").alias("_customer")).distinct()
    first, last = batch.agg(F.min("ts"), F.max("ts")).first()
    if first is None:
        return table.limit(0)
    low, high = (trunc_ts("hour", F.lit(x).cast("timestamp_ntz")) for x in (first, last))
    rows = between(table, low, high + span(hours=1))
    same = (trunc_ts("hour", "ts") == F.col("_hour")) & F.col("customer").eqNullSafe(F.col("_customer"))
    return rows.join(hours, same, "left_semi")


def hourly_metrics_stream(stream: DataFrame, out: str, checkpoint: str, table: Callable[[], DataFrame] | None = None, *,
                          watermark: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Keep the hourly measures up to date: each batch writes the hours it changed.

    With ``table``, the stored rows that ``stream`` is read from, each batch measures the hours it touches anew from
    these: no row is too late, nothing is kept in a state, and a repeated batch gives the same hours again.  Without it the
    measures live in the state of the query, for ever or until ``watermark``.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_version(batch, out, batch_id + 1)

    def again(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write_version(hourly_metrics(touched_hours(batch, table())), out, batch_id + 1)
        finally:
            batch.unpersist()

    if table is None:
        writer = hourly_metrics(stream, watermark).writeStream.outputMode("update").foreachBatch(sink)
    else:
        writer = stream.select("ts", "customer").writeStream.foreachBatch(again)
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_hourly_metrics(spark: SparkSession, out: str, compacted: str | None = None, *, version: bool = False) -> DataFrame:
    """Newest measures of every hour and customer, of completely written versions and of what was compacted."""
    paths = complete_versions(spark, out)
    parts = [spark.read.option("basePath", out).parquet(*paths)] if paths else []
    parts += [spark.read.parquet(compacted).drop("dt")] if compacted else []
    if not parts:
        raise ValueError(f"no complete version in {out}")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    newest = keep_first(rows, ["hour", "customer"], [F.desc("version")])
    return newest if version else newest.drop("version")


def compact_hourly_metrics(spark: SparkSession, out: str, target: str, earlier: str | None = None) -> None:
    """Writes the newest measures, one row per hour and customer, to another folder, those of an ``earlier`` one included.

    The folder is what ``read_hourly_metrics`` takes as ``compacted``; versions that were there before it may go.
    """
    rows = read_hourly_metrics(spark, out, earlier, version=True).withColumn("dt", F.to_date("hour"))
    rows.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(target)


def abandoned_sessions(stream: DataFrame, timeout: str = "2 hours", watermark: str = "24 hours") -> DataFrame:
    """Session activity that began, fell silent for ``timeout`` and has no end event.

    On a streaming DataFrame (append mode) a session is reported when the
    watermark has passed its silence.
    """
    rows = stream.select(F.col("ts").cast("timestamp").alias("at"), "customer", "activity")
    return (
        rows.withWatermark("at", watermark)
        .groupBy(F.session_window("at", timeout), "customer")
        .agg(
            F.max(F.col("activity") == vocab.SESSION_START).alias("started"),
            F.max(F.col("activity") == vocab.SESSION_END).alias("ended"),
            F.count("*").alias("activities"), F.max("at").alias("last"),
        )
        .where(F.col("started") & ~F.col("ended"))
        .select(
            "customer", F.col("session_window.start").cast("timestamp_ntz").alias("first_event"),
            F.col("last").cast("timestamp_ntz").alias("last_event"), "activities",
        )
    )
