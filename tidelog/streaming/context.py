"""Context refresh driven by new stream rows.

The cache is a base and versions after it, each in folders by customer bucket; reading merges them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import vocab
from ..functions import bound, span
from ..operators.state import context_blobs
from ..plans.upsert import complete_versions, merged_versions, retire_versions, write_version

CACHE_COLUMNS = (
    "customer string, context_type string, context_blob string, updated_at timestamp_ntz, access_count bigint, "
    "is_stale boolean"
)
BUCKETS = 64


def _bucket(customer: Column) -> Column:
    return F.pmod(F.xxhash64(customer), F.lit(BUCKETS)).cast("int")


def read_cache(spark: SparkSession, base: str, as_of=None, customer: str | None = None,
               stale_after_s: int = vocab.CONTEXT_STALE_SECONDS) -> DataFrame:
    """The cache: each context's newest row, of the base and of the versions after it; empty where there is none.

    A context counts as stale once it is older than ``stale_after_s`` at ``as_of``, which is found here, so that a batch writes nothing for
    contexts that it does not refresh.  With ``customer`` only that customer's bucket is read.
    """
    rows = merged_versions(spark, base)
    if rows is None:
        return spark.createDataFrame([], CACHE_COLUMNS)
    if customer is not None:
        rows = rows.where((F.col("bucket") == _bucket(F.lit(customer))) & (F.col("customer") == customer))
    newest = merge_cache(rows)
    old = F.coalesce(F.col("updated_at") < bound(as_of) - span(seconds=stale_after_s), F.lit(False)) if as_of is not None else F.lit(False)
    return newest.select(
        "customer", "context_type", "context_blob", "updated_at", (F.col("refreshes") - 1).alias("access_count"), (F.col("is_stale") | old).alias("is_stale"))


def merge_cache(rows: DataFrame) -> DataFrame:
    """One row per context: the newest version's, and how often it was refreshed."""
    kept = F.struct("context_blob", "updated_at", "is_stale")
    return rows.groupBy("customer", "context_type").agg(F.max_by(kept, "version").alias("row"), F.sum("refreshes").alias("refreshes")).select(
        "customer", "context_type", "row.*", "refreshes")


def cache_rows(cache: DataFrame) -> DataFrame:
    """Rows of a cache table in the form of a version."""
    return cache.select("customer", "context_type", "context_blob", "updated_at", "is_stale", (F.col("access_count") + 1).alias("refreshes"),
                        _bucket(F.col("customer")).alias("bucket"))


def refresh_batch(
    cache_base: str, insights: Callable[[], DataFrame], stream: Callable[[], DataFrame], as_of=None
) -> Callable[[DataFrame, int], None]:
    """The work of one micro-batch: activities from it, the rest from the full tables.

    A version holds the contexts that its batch refreshed, in the folders of their buckets, and no others; the cache is not read.
    The version number is the batch number, so a repeated batch writes the same version again.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read for its activities and for its newest event
        try:
            if not batch.isEmpty():
                write(batch, batch_id + 1)
        finally:
            batch.unpersist()

    def write(batch: DataFrame, version: int) -> None:
        blobs = context_blobs(batch, insights(), stream(), as_of)
        fresh = blobs.select("customer", "context_type", "context_blob", bound(as_of).alias("updated_at"), F.lit(False).alias("is_stale"),
                             F.lit(1).cast("bigint").alias("refreshes"), _bucket(F.col("customer")).alias("bucket"))
        # one file a bucket
        write_version(fresh.repartition("bucket"), cache_base, version, buckets="bucket")

    return run


def compact_cache(spark: SparkSession, base: str, retire: bool = False) -> None:
    """Merge all versions of the cache to a new base; with ``retire`` what it replaces is removed."""
    versions = complete_versions(spark, base)
    rows = merged_versions(spark, base)
    if rows is None or not versions:
        return
    merged = merge_cache(rows).withColumn("bucket", _bucket(F.col("customer")))
    write_version(merged.repartition("bucket"), base, int(versions[-1].rsplit("=", 1)[1]), kind="base", buckets="bucket")
    if retire:
        retire_versions(spark, base)


def context_stream(
    rows: DataFrame, cache_base: str, checkpoint: str, insights: Callable[[], DataFrame],
    stream: Callable[[], DataFrame], as_of=None, available_now: bool = True,
) -> StreamingQuery:
    """Refresh the cache whenever the stream table has new rows."""
    writer = (
        rows.writeStream.foreachBatch(refresh_batch(cache_base, insights, stream, as_of))
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()
