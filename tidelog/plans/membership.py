"""Stored Bloom filters of ids: which days of a table may hold which ids.

A filter is rows (write, dt, words, word, bits): 64 bits each, ``words`` of them for the ids of one write and day, about 32 bits
an id.  An id sets ``BITS`` bits in each of ``PROBES`` words.  Building is an aggregation by bit_or, asking an equi-join
with a bit test, so both shuffle a few bytes an id.  A filter may name a day too many, about one in a hundred thousand
ids and writes, and never one too few.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

PROBES, BITS, BITS_PER_ID = 2, 6, 32
SCHEMA = "write string, dt date, words bigint, word bigint, bits bigint"


def _hash(key: str, probe: Column, part: int) -> Column:
    return F.xxhash64(F.col(key), probe, F.lit(part))


def _mask(key: str, probe: Column) -> Column:
    bits = F.lit(0).cast("bigint")
    for i in range(BITS):
        place = F.shiftrightunsigned(_hash(key, probe, 1), 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return bits


def _probed(ids: DataFrame, key: str) -> DataFrame:
    """A row for each id and probe: word and bits, of a filter of ``words`` words."""
    rows = ids.withColumn("probe", F.explode(F.array(*[F.lit(p) for p in range(PROBES)])))
    return rows.withColumns({"word": F.pmod(_hash(key, F.col("probe"), 0), "words"), "mask": _mask(key, F.col("probe"))})


def filter_rows(rows: DataFrame, key: str = "activity_id") -> DataFrame:
    """The filter of ``rows``: their ids by the day of ``ts``.  NULL ids are not in it."""
    ids = rows.where(F.col(key).isNotNull()).select(F.to_date("ts").alias("dt"), F.col(key)).distinct()
    days = ids.groupBy("dt").agg(F.count("*").alias("n"))  # one row per day
    # a power of two, so that asking meets few sizes
    words = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") * BITS_PER_ID / 64))).cast("bigint")
    days = days.select(F.col("dt").alias("_dt"), F.greatest(words, F.lit(1)).alias("words"))
    sized = ids.join(days, F.col("dt").eqNullSafe(F.col("_dt"))).drop("_dt")
    out = _probed(sized, key).groupBy("dt", "words", "word").agg(F.bit_or("mask").alias("bits"))
    return out.select(F.lit(uuid.uuid4().hex).alias("write"), "dt", "words", "word", "bits")


def candidates(ids: DataFrame, filters: DataFrame, key: str = "activity_id") -> DataFrame:
    """(key, dt): the days on which an id may be."""
    sizes = [row[0] for row in filters.select("words").distinct().collect()]  # powers of two: 63 at most
    if not sizes:
        return ids.select(key, F.lit(None).cast("date").alias("dt")).limit(0)
    ids = ids.where(F.col(key).isNotNull()).select(key).distinct()
    asked = _probed(ids.withColumn("words", F.explode(F.array(*[F.lit(w).cast("bigint") for w in sizes]))), key)
    hits = asked.join(filters, ["words", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    found = hits.groupBy(key, "write", "dt").agg(F.count_distinct("probe").alias("n")).where(F.col("n") == PROBES)
    return found.select(key, "dt").distinct()
