"""Schema drift, contract validation, migration checks, quarantine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import vocab
from ..functions import bound, since, span, stable_id


def json_kind(value: Column) -> Column:
    """NUMBER, STRING, BOOLEAN, OBJECT, ARRAY, or NULL of a variant value."""
    return kind_of_type(F.schema_of_variant(value))


def kind_of_type(name: Column) -> Column:
    return (
        F.when(name == "VOID", "NULL")
        .when(name.isin("STRING", "BOOLEAN"), name)
        .when(name.startswith("OBJECT"), "OBJECT")
        .when(name.startswith("ARRAY"), "ARRAY")
        .when(name.isNotNull(), "NUMBER")
    )


def payload_kinds(stream: DataFrame) -> DataFrame:
    """Occurrences of each (payload key, value type)."""
    variant = stream.select(F.try_parse_json("feature_json").alias("v"))
    fields = variant.lateralJoin(
        stream.sparkSession.tvf.variant_explode(F.col("v").outer()), how="inner"
    )
    return (
        fields.where(F.col("key").isNotNull())
        .select(F.col("key").alias("column_name"), F.schema_of_variant("value").alias("type"))
        .groupBy("column_name", kind_of_type(F.col("type")).alias("kind"))
        .agg(F.count("*").alias("n"))
    )


def schema_drift(stream: DataFrame, as_of=None, expected: Mapping[str, str] = vocab.EXPECTED_TYPES,
                 hours: int = 24) -> DataFrame:
    """Payload keys of the last hours that are new, changed or mixed in type."""
    kinds = payload_kinds(since(stream, bound(as_of) - span(hours=hours), strict=True, to=bound(as_of)))
    by_key = kinds.groupBy("column_name").agg(
        F.count("kind").alias("type_variations"),
        F.min_by("kind", F.struct(-F.col("n"), F.col("kind"))).alias("actual_type"),
        F.sum("n").alias("occurrences"),
    )
    declared = stream.sparkSession.createDataFrame(list(expected.items()), "column_name string, expected_type string")
    status = (
        F.when(F.col("expected_type").isNull(), "NEW_COLUMN")
        .when(F.col("actual_type") != F.col("expected_type"), "TYPE_CHANGE")
        .when(F.col("type_variations") > 1, "TYPE_INCONSISTENCY")
    )
    return (
        by_key.join(F.broadcast(declared), "column_name", "left")  # a dozen declared rows
        .withColumn("drift_status", status)
        .where(F.col("drift_status").isNotNull())
        .select("column_name", "actual_type", "expected_type", "type_variations", "occurrences", "drift_status")
    )


def drift_events(drift: DataFrame, as_of=None) -> DataFrame:
    """One stream event per drifted key."""
    body = F.to_json(F.struct(
        F.col("drift_status").alias("drift_type"), F.col("column_name").alias("column"), "expected_type",
        "actual_type", F.lit("quarantine_insights").alias("action"), F.lit("schema_drift").alias("event_type"),
        F.lit("warning").alias("severity"),
    ))
    return drift.select(
        stable_id(bound(as_of), body).alias("activity_id"), bound(as_of).alias("ts"), F.lit(vocab.SCHEMA_DRIFT).alias("activity"),
        F.lit(vocab.SYSTEM_CUSTOMER).alias("customer"), body.alias("feature_json"),
    )


def quarantine_insights(
    insights: DataFrame, stream: DataFrame, as_of=None, drift: DataFrame | None = None, hours: int = 24
) -> DataFrame:
    """Insights whose artifact a recent event links to become quarantined.

    This does not depend on drift; pass ``drift`` to do it only where drift was found.
    """
    linked = (
        since(stream, bound(as_of) - span(hours=hours), strict=True, to=bound(as_of))
        .where(F.col("feature_json").isNotNull() & F.col("link").isNotNull())
        .select(F.col("link").alias("_link"))
        .distinct()
    )
    if drift is not None:
        linked = linked.join(drift.limit(1).select(F.lit(True).alias("_any")), F.col("_any"), "left_semi")
    hit = F.col("_link").isNotNull() & ~F.col("is_quarantined")
    reason = F.col("quarantine_reason") if "quarantine_reason" in insights.columns else F.lit(None).cast("string")
    return (
        insights.join(linked, F.col("artifact_id") == F.col("_link"), "left")
        .withColumn("quarantine_reason", F.when(hit, "Schema drift detected").otherwise(reason))
        .withColumn("is_quarantined", F.when(hit, True).otherwise(F.col("is_quarantined")))
        .drop("_link")
    )


def quarantine_counts(insights: DataFrame) -> DataFrame:
    return insights.where("is_quarantined").agg(F.count("*").alias("quarantined_count"))


def migration_validation(old: DataFrame, new: DataFrame) -> DataFrame:
    """Row count, time bounds and id digest of two stream tables, each in one scan.

    The digest adds a number made from each id's hash, so it covers every id, does
    not depend on order, and is combined map side.
    """

    def facts(df: DataFrame, side: str) -> DataFrame:
        number = F.conv(F.substring(F.md5("activity_id"), 1, 15), 16, 10).cast("decimal(38,0)")
        bounds = df.agg(F.count("*").alias("rows"), F.min("ts").alias("low"), F.max("ts").alias("high"), F.sum(number).alias("ids"))

        def text(ts: str) -> Column:
            return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")

        row = bounds.select(
            F.col("rows").cast("string").alias("rows"), text("low").alias("low"), text("high").alias("high"), F.col("ids").cast("string").alias("ids")
        )
        return row.select(F.expr(
            "stack(4, 'row_count', rows, 'min_timestamp', low, 'max_timestamp', high, 'id_digest', ids) "
            f"AS (check_name, {side})"
        ))

    a, b = F.col("old_table_value"), F.col("new_table_value")
    return (
        facts(old, "old_table_value")
        .join(facts(new, "new_table_value"), "check_name")
        .withColumn("match_status", F.when(a == b, "MATCH").when(a.isNull() | b.isNull(), "NULL_VALUE")
                    .otherwise("MISMATCH"))
    )


def validate_events(stream: DataFrame, contracts: Mapping[str, tuple] = vocab.CONTRACTS,
                    families: Mapping[str, tuple] = vocab.FAMILY_ACTIVITIES) -> DataFrame:
    """Contract violations: one row per event, field and kind of violation.

    An event is dispatched by its family to one parse of that family's fields, a variant each, whose
    types are named once; only violations become rows.
    """
    family = F.lit(None).cast("string")
    for name, activities in families.items():
        family = F.when(F.col("activity").isin(*activities), name).otherwise(family)
    rows = stream.select("activity_id", "activity", family.alias("family"), "feature_json").where(F.col("family").isNotNull())
    # a column for each family, of which an event has one
    parsed = rows.select("activity_id", "activity", "family", *[
        F.when(F.col("family") == name, F.from_json("feature_json", T.StructType([T.StructField(f, T.VariantType()) for f in types]))).alias(f"p_{name}")
        for name, (_, types, _) in contracts.items()])
    typed = parsed.select("activity_id", "activity", "family", *[
        F.when(F.col("family") == name, F.struct(
            *[F.schema_of_variant(F.col(f"p_{name}.`{f}`")).alias(f) for f in types],
            *[F.try_variant_get(F.col(f"p_{name}.`{f}`"), "$", "string").alias(f"text {f}") for f in allowed])).alias(f"t_{name}")
        for name, (_, types, allowed) in contracts.items()])
    found = F.lit(None)
    for name, (required, types, allowed) in contracts.items():
        checks = F.array(*[
            F.struct(F.lit(f).alias("field"), _check(
                F.col(f"t_{name}.`{f}`"), F.col(f"t_{name}.`text {f}`") if f in allowed else None, kind, f in required, allowed.get(f)).alias("violation"))
            for f, kind in types.items()])
        found = F.when(F.col("family") == name, checks).otherwise(found)
    # inline_outer: for a plain inline the optimizer adds a size filter, which would repeat the checks below it
    return typed.select("activity_id", "activity", "family", F.inline_outer(found)).where(F.col("violation").isNotNull())


def _check(name: Column, text: Column | None, kind: str, required: bool, allowed: tuple | None) -> Column:
    """The kind of violation, else NULL."""
    absent = name.isNull() | (name == "VOID")
    matches = {
        "string": name == "STRING", "boolean": name == "BOOLEAN", "object": name.startswith("OBJECT"),
        "array": name.startswith("ARRAY"),
        "number": (name == "BIGINT") | (name == "DOUBLE") | name.startswith("DECIMAL"),
    }[kind]
    problem = F.when(absent, F.lit("missing" if required else None)).when(~matches, "wrong_type")
    if allowed:
        problem = problem.when(~text.isin(*allowed), "not_allowed")
    return problem
