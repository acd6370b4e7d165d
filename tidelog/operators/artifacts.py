"""Profiles of stored result sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import vocab
from ..functions import bound
from ..plans.prefix import running_number
from ..plans.stored import stored
from .quality import json_kind


def numbered_rows(rows: DataFrame, order: Sequence[str], bucket: Column, key: str = "artifact_id") -> DataFrame:
    """Adds ``row_no`` (from 0) in each artifact, by ``order``.

    ``bucket`` is a value that does not decrease along ``order``; an artifact is
    numbered bucket by bucket, so a very large one is many tasks.
    """
    return running_number(rows, [key], order, bucket, "row_no").withColumn("row_no", F.col("row_no") - 1)


def page_sizes(numbered: DataFrame, page_rows: int = vocab.PAGE_ROWS, key: str = "artifact_id", chars: Column | None = None) -> DataFrame:
    """Rows and bytes of each page; ``row_json`` is the text of a row, and ``chars`` its length where that is known.

    A page is a JSON array, hence one separator or bracket per row and one more.
    """
    return (
        numbered.groupBy(key, F.floor(F.col("row_no") / page_rows).alias("page"))
        .agg(F.count("*").alias("page_rows"), F.sum(F.length("row_json") if chars is None else chars).alias("_text"))
        .select(key, "page", "page_rows", (F.col("_text") + F.col("page_rows") + 1).alias("page_bytes"))
    )


def sample_rows(numbered: DataFrame, n: int = vocab.SAMPLE_ROWS, key: str = "artifact_id") -> DataFrame:
    """First ``n`` rows of each artifact as one array of at most ``n`` texts, with its size."""
    return (
        numbered.where(F.col("row_no") < n)
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("row_no", "row_json"))).alias("_rows"))
        .select(key, F.transform("_rows", lambda r: r["row_json"]).alias("sample_rows"))
        .withColumn("sample_chars", F.length(F.concat(F.lit("["), F.array_join("sample_rows", ","), F.lit("]"))))
    )


def cut_text_fields(row_json: Column, schema, limit: int = vocab.SAMPLE_CUT_CHARS) -> Column:
    """The row with every text field longer than ``limit`` cut and marked by dots."""
    parsed = F.from_json(row_json, schema)
    fields = []
    for field in schema.fields:
        value = parsed[field.name]
        if field.dataType.typeName() == "string":
            value = F.when(F.length(value) > limit, F.concat(F.left(value, F.lit(limit)), F.lit("..."))).otherwise(value)
        fields.append(value.alias(field.name))
    return F.to_json(F.struct(*fields))


def artifact_profile(
    rows: DataFrame, order: Sequence[str], bucket: Column, as_of=None, schema=None, expires_hours: int = 24,
    key: str = "artifact_id", page_list: bool = True,
) -> DataFrame:
    """One row per artifact: counts, sample, columns, page sizes, storage flag, expiry.

    ``rows`` has one row per result row with its JSON text in ``row_json``;
    ``schema`` (a StructType) describes that text, else the first row does.  The
    page list has one number per page; with ``page_list=False`` it is left out
    (``page_sizes`` gives it as rows).  The rows are read twice: for their sizes, which are stored without the texts and
    numbered, and for the samples.
    """
    # sizes without texts: what numbers, pages and totals need of a row
    slim = stored(rows.select(key, *order, bucket.alias("_bucket"), F.length("row_json").alias("_chars")), "result-rows")
    numbered = running_number(slim, [key], order, F.col("_bucket"), "row_no").withColumn("row_no", F.col("row_no") - 1)
    pages = page_sizes(numbered, key=key, chars=F.col("_chars"))
    totals = pages.groupBy(key).agg(
        F.sum("page_rows").alias("row_count"), (F.sum("page_bytes") - F.count("*") + 1).alias("total_bytes"),
        F.count("*").alias("page_count"), *([_page_list()] if page_list else []),
    )
    # the first rows are chosen in each task before any text is shuffled
    place = Window.partitionBy(key).orderBy(*order)
    first_rows = rows.select(key, "row_json", (F.row_number().over(place) - 1).alias("row_no")).where(F.col("row_no") < vocab.SAMPLE_ROWS)
    samples = sample_rows(first_rows, key=key)
    if schema is not None:
        samples = samples.withColumn(
            "sample_rows",
            F.when(F.col("sample_chars") > vocab.SAMPLE_MAX_CHARS,
                   F.transform("sample_rows", lambda r: cut_text_fields(r, schema))).otherwise(F.col("sample_rows")),
        )
        columns = F.lit(F.to_json(F.array(*[
            F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.typeName()).alias("type"), F.lit(True).alias("nullable"))
            for f in schema.fields
        ])))
        count = F.lit(len(schema.fields))
    else:
        first = F.get(F.col("sample_rows"), 0)
        names = F.json_object_keys(first)
        columns = F.to_json(F.transform(names, lambda k: F.struct(
            k.alias("name"),
            F.lower(json_kind(F.try_variant_get(F.try_parse_json(first), F.concat(F.lit("$."), k), "variant")))
            .alias("type"),
            F.lit(True).alias("nullable"),
        )))
        count = F.size(names)
    return totals.join(samples, key).select(
        key, "row_count", count.cast("bigint").alias("column_count"), "sample_rows", "sample_chars",
        columns.alias("content_schema"), *(["row_group_bytes"] if page_list else []), "page_count", "total_bytes",
        ((F.col("row_count") > vocab.EXTERNAL_ROWS) | (F.col("total_bytes") > vocab.EXTERNAL_BYTES))
        .alias("is_external"),
        (bound(as_of) + F.make_dt_interval(hours=F.lit(expires_hours))).alias("expires_at"),
    )


def _page_list() -> Column:
    pages = F.array_sort(F.collect_list(F.struct("page", "page_bytes")))
    return F.transform(pages, lambda p: p["page_bytes"]).alias("row_group_bytes")


def clean_artifacts(artifacts: DataFrame, as_of=None) -> DataFrame:
    """Artifacts that stay: not expired, or pinned, or read twice; no expiry stays."""
    return artifacts.where(~_expired(as_of))


def expired_artifacts(artifacts: DataFrame, as_of=None) -> DataFrame:
    return artifacts.where(_expired(as_of))


def _expired(as_of) -> Column:
    gone = (F.col("expires_at") < bound(as_of)) & ~F.col("is_pinned") & (F.col("access_count") < 2)
    return F.coalesce(gone, F.lit(False))


def mark_stale_insights(insights: DataFrame, as_of=None) -> DataFrame:
    """Insights past their validity become stale."""
    past = F.coalesce(F.col("valid_until") < bound(as_of), F.lit(False))
    return insights.withColumn("is_stale", F.when(past, True).otherwise(F.col("is_stale")))
