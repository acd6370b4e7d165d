"""Exact duplicates by deterministic block naming.

A text is normalised (white space deleted), cut into blocks of ``BLOCK`` bytes, and every distinct block is given an
integer, its place among the sorted distinct blocks.  Then adjacent pairs of names are named in the same way, round by round,
until each document has one name.  Equal names of a round stand for equal bytes, and documents that end in different
rounds differ in length, so (round, name) is an identity without collisions.

Blocks travel once, to be sorted; their names come back by a 64-bit key.  A key that two distinct blocks share is found
when the blocks are named, and its blocks are then matched by their bytes, so no result rests on a hash.  A name, pair or
group that stands for more than a thousandth of all rows is joined through copies of its one row: there are 1,000 such
rows at most, so the list of them may be broadcast.

Null texts are empty; empty texts are equal to each other.  Of equal texts the row with the most code points stays, then the
one of the least doc_id (null last), then any one of rows that are equal in both.  Repeated rows count one by one.  An empty table
gives an empty result.  Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, cut

BLOCK, SHARES = 1024, 1000
_APART = 1 << 62  # names of blocks whose key is shared begin here


def _blocks(docs: DataFrame, size: int, mask: int, *columns: Column) -> DataFrame:
    """``columns``, i, n, block and its key: a row for each block; an empty text has one empty block."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*columns, text.alias("_whole"))
    rows = rows.withColumns({"_bytes": F.regexp_replace("_whole", f"[{SPACE}]+", "").cast("binary"), "points": F.length("_whole")}).drop("_whole")
    rows = rows.withColumns({"n": F.greatest(F.ceil(F.octet_length("_bytes") / F.lit(size)), F.lit(1)), "text_sha256": F.sha2("_bytes", 256)})
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.withColumn("block", F.substring("_bytes", (F.col("i") * size + 1).cast("int"), F.lit(size))).drop("_bytes")
    return rows.withColumn("key", F.xxhash64("block").bitwiseAND(F.lit(mask)))


def _named(distinct: DataFrame, on: list[str], label: str, first: int = 0, columns: list[str] | None = None) -> DataFrame:
    """``columns`` (all, if none are named) of distinct rows, with an integer each: the place among those of a partition, sorted by ``on``."""
    return cut(distinct.sortWithinPartitions(*on).select(*(columns or distinct.columns), (F.monotonically_increasing_id() + F.lit(first)).alias("name")), label)


def spread_join(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for each ``on``, and in ``count`` how many rows ask for it.

    A row that many ask for is copied, and each asker takes one of the copies.
    """
    total = table.agg(F.sum("count")).first()[0] or 0
    limit = total // SHARES + 1
    hot = table.filter(F.col("count") > limit).select(*on, F.ceil(F.col("count") / F.lit(limit)).cast("int").alias("_copies"))
    asked = rows.withColumn("_salt", F.xxhash64(*rows.columns)).join(F.broadcast(hot), on, "left")
    asked = asked.withColumn("_salt", F.pmod("_salt", F.coalesce("_copies", F.lit(1))).cast("int")).drop("_copies")
    copies = F.when(F.col("count") > limit, F.ceil(F.col("count") / F.lit(limit)).cast("int")).otherwise(F.lit(1))
    copied = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    return asked.join(copied, [*on, "_salt"]).drop("_salt")


def _block_names(docs: DataFrame, size: int, mask: int) -> DataFrame:
    """(rid, i, n, name, doc_id, points, text_sha256); the last three stand at the first block only."""
    distinct = _blocks(docs, size, mask).groupBy("key", "block").agg(F.count("*").alias("count"))
    names = _named(distinct, ["block"], "block-names", columns=["key", "count"])
    shared = cut(names.groupBy("key").agg(F.count("*").alias("blocks")).filter("blocks > 1").select("key"), "shared-keys")
    apart = not shared.isEmpty()
    at_first = [F.when(F.col("i") == 0, F.col(c)).alias(c) for c in ("doc_id", "points", "text_sha256")]
    rows = _blocks(docs, size, mask, F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"))
    rows = cut(rows.select("rid", "i", "n", "key", *at_first, *(["block"] if apart else [])), "blocks")
    if not apart:
        return spread_join(rows, names, ["key"]).drop("key", "count")
    some = rows.join(shared, "key", "left_semi")
    by_bytes = _named(some.groupBy("key", "block").agg(F.count("*").alias("count")), ["block"], "shared-names", _APART)
    plain = spread_join(rows.join(shared, "key", "left_anti"), names.join(shared, "key", "left_anti"), ["key"]).drop("key", "count", "block")
    return plain.unionByName(spread_join(some, by_bytes, ["key", "block"]).drop("key", "count", "block"))


def identities(docs: DataFrame, size: int = BLOCK, mask: int = -1) -> DataFrame:
    """(rid, doc_id, points, text_sha256, round, name) of each row; rows share (round, name) if their normalised texts are equal."""
    level = cut(_block_names(docs, size, mask), "names-0")
    rows = level.filter("i = 0").select("rid", "doc_id", "points", "text_sha256")
    ended, number = [], 0
    while True:
        ended.append(level.filter("n = 1").select("rid", F.lit(number).alias("round"), "name"))
        longer = level.filter("n > 1")
        if longer.isEmpty():
            break
        number += 1
        right = F.col("i") % 2 == 1
        pairs = longer.groupBy("rid", F.floor(F.col("i") / 2).alias("i")).agg(
            F.max(F.when(~right, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(right, F.col("name"))), F.lit(-1)).alias("b"),
            F.ceil(F.max("n") / 2).alias("n"))
        names = _named(pairs.groupBy("a", "b").agg(F.count("*").alias("count")), ["a", "b"], f"pair-names-{number}")
        level = cut(spread_join(pairs, names, ["a", "b"]).select("rid", "i", "n", "name"), f"names-{number}")
    found = ended[0]
    for more in ended[1:]:
        found = found.unionByName(more)
    return rows.join(found, "rid")


def exact_classes(docs: DataFrame, size: int = BLOCK, mask: int = -1) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row.  ``mask`` keeps these bits of the blocks' keys."""
    rows = cut(identities(docs, size, mask), "identities")
    best = F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    groups = rows.groupBy("round", "name").agg(F.count("*").alias("count"), F.min(best).alias("best"))
    groups = cut(groups.select("round", "name", "count", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid")), "groups")
    return spread_join(rows, groups, ["round", "name"]).select(
        "doc_id", "keep_id", F.col("count").alias("group_size"), (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256")
