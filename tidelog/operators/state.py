"""Jobs that compute new contents of keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import vocab
from ..functions import bound, opt, payload_of, since, span, stable_id, trunc_ts, ts_diff
from ..plans.prefix import running_number
from ..plans.upsert import insert_if_absent, keep_first
from .sessions import latest_per_customer

LEGACY_FIELDS = (("feature_1", "tool_name"), ("feature_2", "parameters"), ("feature_3", "result_type"))


# ------------------------------------------------------------------ migration
def with_legacy_fields(events: DataFrame) -> DataFrame:
    """Adds the three legacy text columns and takes the host from the payload."""
    p = payload_of(events, "host", *[n for pair in LEGACY_FIELDS for n in pair])
    legacy = [F.coalesce(p.text(a), p.text(b), F.lit("")).alias(a) for a, b in LEGACY_FIELDS]
    kept = [c for c in events.columns if c not in {"anonymous_customer_id", *[a for a, _ in LEGACY_FIELDS]}]
    host = F.coalesce(p.text("host"), opt(events, "anonymous_customer_id"))
    return p.df.select(*kept, host.alias("anonymous_customer_id"), *legacy)


def dual_write(events: DataFrame, old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New contents of both generations: appended to the old, inserted into the new."""
    rows = with_legacy_fields(events)
    return old.unionByName(rows, allowMissingColumns=True), insert_if_absent(new, rows)


def backfill_rows(old: DataFrame, new: DataFrame, start: str | None = None, end: str | None = None, same_day: bool = False) -> DataFrame:
    """Rows of ``old`` in the inclusive day range that ``new`` lacks, one for each id.

    A missing id becomes a hash of the row, so a re-run finds it again.  Each side is shuffled once, by id.  A copy of an event may lie on
    any day of ``new``; where copies carry their event's time, ``same_day=True`` bounds both sides by the day range, which
    prunes the partitions of both.
    """

    def days(rows: DataFrame) -> DataFrame:
        if start is not None:
            rows = since(rows, F.lit(start).cast("date").cast("timestamp_ntz"))
        if end is not None:
            rows = rows.where(F.col("ts") < F.lit(end).cast("date").cast("timestamp_ntz") + span(days=1))
            rows = rows.where(F.col("dt") <= F.lit(end).cast("date")) if "dt" in rows.columns else rows
        return rows

    stable = F.md5(F.to_json(F.struct("ts", "activity", "customer", "anonymous_customer_id", "feature_json", "link")))
    rows = days(old).withColumn("activity_id", F.coalesce("activity_id", stable))
    known = (days(new) if same_day else new).select(F.col("activity_id").alias("_k"))
    # both steps need the rows by id, so they share a shuffle
    fresh = rows.join(known, F.col("activity_id") == F.col("_k"), "left_anti")
    return keep_first(fresh, "activity_id", ["ts"])


def backfill(old: DataFrame, new: DataFrame, start: str | None = None, end: str | None = None, same_day: bool = False) -> DataFrame:
    return new.unionByName(backfill_rows(old, new, start, end, same_day), allowMissingColumns=True)


# ------------------------------------------------------------- context refresh
def valid_insights(insights: DataFrame, as_of=None) -> DataFrame:
    """Insights that may be served."""
    return insights.where(
        (F.col("valid_until") > bound(as_of)) & ~F.col("is_stale") & ~F.col("is_quarantined")
    )


def context_entries(
    changes: DataFrame, insights: DataFrame, stream: DataFrame, as_of=None, n_queries: int = 10
) -> DataFrame:
    """All parts of the customers' contexts as rows (customer, section, key, value...).

    Sections: activity counts per hour from the change feed (24 h), valid insights,
    newest successful queries (2 h), tool statistics (6 h).
    """
    now = bound(as_of)
    recent = since(changes, now - span(hours=24), strict=True, to=now)
    hour_text = F.date_format(trunc_ts("hour", "ts"), "yyyy-MM-dd HH:mm:ss")
    activities = (
        recent.groupBy("customer", F.concat("activity", F.lit(":"), hour_text).alias("key"))
        .agg(F.count("*").alias("n"))
        .select("customer", F.lit("activities").alias("section"), "key", "n")
    )
    # Best copy of each (subject, metric): highest confidence, then newest.
    best = Window.partitionBy("customer", "subject", "metric").orderBy(F.desc("confidence"), F.desc("ts"), F.asc("id"))
    facts = (
        valid_insights(insights, as_of)
        .withColumn("_place", F.row_number().over(best)).where("_place = 1")
        .select(
            "customer", F.lit("insights").alias("section"), F.concat("subject", F.lit(":"), "metric").alias("key"),
            F.col("value").cast("string").alias("text"), "confidence", "artifact_id", "valid_until",
        )
    )
    p = payload_of(
        since(stream.where(F.col("activity") == "query_complete"), now - span(hours=2), strict=True, to=now),
        "success", "sql", "row_count", "warehouse", once=True,
    )
    good = p.df.where(p.flag("success")).select(
        "customer", "activity_id", "ts", p.text("sql").alias("text"), p.whole("row_count").alias("n"),
        F.col("link").alias("artifact_id"), p.text("warehouse").alias("warehouse"),
    )
    queries = latest_per_customer(good, n_queries).select(
        "customer", F.lit("recent_queries").alias("section"), F.col("activity_id").alias("key"), "n", "text",
        "artifact_id", "warehouse", "ts", "place",
    )
    t = payload_of(
        since(stream.where(F.col("activity") == "tool_call"), now - span(hours=6), strict=True, to=now),
        "tool_name", "latency_ms", once=True,
    )
    calls = t.df.select("customer", t.text("tool_name").alias("key"), t.whole("latency_ms").alias("ms")).where(
        F.col("key").isNotNull()
    )
    tools = calls.groupBy("customer", "key").agg(
        F.count("*").alias("n"), F.avg("ms").alias("avg_latency_ms"),
        F.percentile("ms", F.lit(0.95)).alias("p95_latency_ms"),
    ).withColumn("section", F.lit("tool_usage"))
    rows = activities
    for part in (facts, queries, tools):
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.where(F.col("customer").isNotNull())


def context_blobs(
    changes: DataFrame, insights: DataFrame, stream: DataFrame, as_of=None, n_queries: int = 10
) -> DataFrame:
    """One JSON object per customer, in one shuffle over all sections.

    A customer's groups are small: each entry is already aggregated or limited.
    """
    now = bound(as_of)
    rows = context_entries(changes, insights, stream, as_of, n_queries)
    section = F.col("section")

    def mapped(name: str, value: Column) -> Column:
        pairs = F.collect_list(F.when(section == name, F.struct("key", value.alias("value"))))
        return F.when(F.size(pairs) > 0, F.map_from_entries(F.array_sort(pairs))).alias(name)

    queries = F.array_sort(F.collect_list(F.when(section == "recent_queries", F.struct(
        "place", F.col("key").alias("activity_id"), "ts", F.col("text").alias("sql"), F.col("n").alias("rows"),
        "artifact_id", "warehouse",
    ))))
    grouped = rows.groupBy("customer").agg(
        mapped("activities", F.col("n")),
        mapped("insights", F.struct(F.col("text").alias("value"), "confidence", "artifact_id", "valid_until")),
        F.when(F.size(queries) > 0, F.transform(queries, lambda q: q.dropFields("place"))).alias("recent_queries"),
        mapped("tool_usage", F.struct(F.col("n").alias("count"), "avg_latency_ms", "p95_latency_ms")),
    )
    newest = changes.agg(F.max("ts").alias("_newest")).withColumn("_one", F.lit(1))  # one row
    return (
        grouped.withColumn("_one", F.lit(1))
        .join(F.broadcast(newest), "_one")
        .select(
            "customer", F.lit("default").alias("context_type"),
            F.to_json(F.struct(
                "activities", "insights", "recent_queries", "tool_usage", now.alias("refreshed_at"),
                ts_diff("millisecond", F.col("_newest"), now).alias("refresh_lag_ms"), F.lit(False).alias("is_stale"),
            ), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("context_blob"),
        )
    )


ENTRY = ("section", "key", "n", "text", "confidence", "artifact_id", "valid_until", "warehouse", "ts", "place", "avg_latency_ms", "p95_latency_ms")


def context_pages(entries: DataFrame, page_rows: int = 500) -> DataFrame:
    """The entries of ``context_entries`` in pages (customer, page, entries) of ``page_rows`` at most, whatever a customer has.

    Entries are numbered by a hash of their key, in 256 stretches of a customer, so no task holds all of a busy one.
    """
    rows = entries.withColumn("_h", F.xxhash64("section", "key")).select("customer", "_h", F.struct(*ENTRY).alias("entry"))
    rows = rows.withColumns({"_section": F.col("entry.section"), "_key": F.col("entry.key")})
    rows = running_number(rows, ["customer"], ["_h", "_section", "_key"], F.shiftright("_h", 56), "_no")
    return rows.groupBy("customer", F.floor((F.col("_no") - 1) / page_rows).alias("page")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_no", "entry"))), lambda x: x["entry"]).alias("entries"))


_BLOB = (
    "activities map<string, bigint>, insights map<string, struct<value: string, confidence: double, artifact_id: string, valid_until: timestamp_ntz>>, "
    "recent_queries array<struct<activity_id: string, ts: timestamp_ntz, sql: string, rows: bigint, artifact_id: string, warehouse: string>>, "
    "tool_usage map<string, struct<count: bigint, avg_latency_ms: double, p95_latency_ms: double>>"
)


def blob_entries(blobs: DataFrame) -> DataFrame:
    """The entries that context blobs hold, as rows like those of ``context_entries``."""
    p = blobs.select("customer", F.from_json("context_blob", _BLOB).alias("p")).select("customer", "p.*")
    activities = p.select("customer", F.explode("activities").alias("key", "n")).select("customer", F.lit("activities").alias("section"), "key", "n")
    facts = p.select("customer", F.explode("insights").alias("key", "v")).select(
        "customer", F.lit("insights").alias("section"), "key", F.col("v.value").alias("text"), "v.confidence", "v.artifact_id", "v.valid_until")
    queries = p.select("customer", F.posexplode("recent_queries").alias("at", "v")).select(
        "customer", F.lit("recent_queries").alias("section"), F.col("v.activity_id").alias("key"), F.col("v.rows").alias("n"),
        F.col("v.sql").alias("text"), "v.artifact_id", "v.warehouse", "v.ts", (F.col("at") + 1).alias("place"))
    tools = p.select("customer", F.explode("tool_usage").alias("key", "v")).select(
        "customer", F.lit("tool_usage").alias("section"), "key", F.col("v.count").alias("n"), "v.avg_latency_ms", "v.p95_latency_ms")
    rows = activities
    for part in (facts, queries, tools):
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def refresh_context(cache: DataFrame, blobs: DataFrame, as_of=None,
                    stale_after_s: int = vocab.CONTEXT_STALE_SECONDS) -> DataFrame:
    """New cache contents.

    A refreshed context gets the new blob, is fresh and counts one more access; a
    new one is added; the others become stale once older than ``stale_after_s``.
    """
    now = bound(as_of)
    keys = ["customer", "context_type"]
    fresh = blobs.select(*keys, F.col("context_blob").alias("_blob"))
    kept = [c for c in cache.columns if c not in keys]
    both = cache.withColumn("_old", F.lit(True)).join(fresh, keys, "full")
    new = F.col("_blob").isNotNull()
    updated = F.when(new, now).otherwise(F.col("updated_at"))
    values = {
        "context_blob": F.coalesce("_blob", "context_blob"),
        "updated_at": updated,
        "access_count": F.when(F.col("_old").isNull(), F.lit(0)).when(new, F.col("access_count") + 1)
        .otherwise(F.col("access_count")).cast("bigint"),
        "is_stale": F.when(new, False).otherwise(
            F.col("is_stale") | F.coalesce(F.col("updated_at") < now - span(seconds=stale_after_s), F.lit(False))
        ),
    }
    return both.select(*keys, *[values.get(c, F.col(c)).alias(c) for c in kept])


def refresh_log(changes: DataFrame, as_of=None) -> DataFrame:
    """The record of one refresh."""
    name = F.concat(F.lit("context_refresh_"), F.date_format(bound(as_of), "yyyyMMdd_HHmmss"))
    return changes.agg(
        F.count("*").alias("stream_records"), F.countDistinct("customer").alias("customers_updated")
    ).select(name.alias("migration_name"), "*")


def active_contexts(cache: DataFrame, as_of=None, fresh_s: int = vocab.CONTEXT_STALE_SECONDS) -> DataFrame:
    """Cache reads: every context is served, marked fresh or stale."""
    old = F.col("is_stale") | F.coalesce(F.col("updated_at") < bound(as_of) - span(seconds=fresh_s), F.lit(False))
    return cache.select(
        "customer", "context_type", "context_blob", "updated_at",
        F.when(old, "stale").otherwise("fresh").alias("served_as"),
        ts_diff("second", F.col("updated_at"), bound(as_of)).alias("age_seconds"),
    )


# ------------------------------------------------------------------- insights
def record_insights(df: DataFrame, as_of=None) -> DataFrame:
    """Insight rows for measured values (customer, subject, metric, value, ...)."""
    now = bound(as_of)
    return df.select(
        stable_id(now, F.col("customer"), F.col("subject"), F.col("metric"), opt(df, "grain")).alias("id"), now.alias("ts"), "customer", "subject", "metric", "value",
        opt(df, "grain").alias("grain"), F.coalesce(opt(df, "confidence", "double"), F.lit(1.0)).alias("confidence"),
        opt(df, "artifact_id").alias("artifact_id"), opt(df, "derivation_method").alias("derivation_method"),
        now.alias("valid_from"), (now + span(days=1)).alias("valid_until"), F.lit(False).alias("is_stale"),
        F.lit(False).alias("is_quarantined"), F.lit(None).cast("string").alias("quarantine_reason"),
    )


def changes_between(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Full change feed of two snapshots: INSERT, UPDATE and DELETE rows."""
    shared = [c for c in new.columns if c in old.columns and c != key]

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.select(F.col(key).alias(key), F.struct(*shared).alias(mark))

    both = side(old, "_old").join(side(new, "_new"), key, "full")
    action = (
        F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "UPDATE")
    )
    return (
        both.withColumn("action", action).where(F.col("action").isNotNull())
        .select(key, "action", F.coalesce("_new", "_old").alias("_row"))
        .select(key, "action", "_row.*")
    )


def seed_definitions(definitions: DataFrame, descriptions: dict[str, str] | None = None) -> DataFrame:
    """``definitions`` plus the known activities it lacks, with the ``descriptions`` given for them."""
    import json

    rows = [(name, (descriptions or {}).get(name), json.dumps(fields)) for name, fields in vocab.ACTIVITY_DEFINITIONS]
    known = definitions.sparkSession.createDataFrame(
        rows, "activity_name string, description string, expected_features string"
    )
    missing = known.join(definitions.select("activity_name"), "activity_name", "left_anti")
    return definitions.unionByName(missing, allowMissingColumns=True)
