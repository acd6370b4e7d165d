"""Sharding by minimax contiguous partition: documents with equal texts are an atomic group, groups are ordered by a hash of the
text, and shards are stretches of this order whose largest size is as small as can be.

A capacity is feasible if filling shards greedily, each up to the capacity, needs no more shards than there are; the
smallest feasible one is found by binary search.  The cuts then go, within that capacity, to the edge of a group nearest to the mean of what
is left, so that no shard is empty while there are groups enough.

The driver never holds all groups.  It holds cells, stretches of the order with their sizes: ``2 ** CELLS`` of equal width, and the groups
above the share of one (fewer than that) as cells of their own.  The search runs on the cells and notes those inside which
it had to ask for the edge of a group; these are divided by ``2 ** SPLIT``, and the search runs again until all its questions fall
on known edges, which is what it would have answered with all groups at hand.  A run asks about a few cells for each
shard and capacity that is still in doubt, so what is collected does not depend on the number of groups but for a logarithm.

Null texts count as empty ones.  Repeated rows are told apart by nothing, and which of them takes which slot is
immaterial.  A group larger than the mean shard has a shard of its own at least in size.  Shards are empty only
where there are fewer groups than shards.  An empty table gives an empty result.  Further columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

CELLS, SPLIT, OVERHEAD, SPREAD = 12, 6, 8, 256
KEY_BITS = 60


@dataclass(frozen=True)
class Cell:
    """Groups with keys from ``low`` to below ``high``."""

    low: int
    high: int
    size: int
    largest: int
    groups: int


def _sums(bounds: np.ndarray):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            total = batch.column("total").to_numpy()
            cell = np.searchsorted(bounds, batch.column("key").to_numpy(), "right") - 1
            order = np.argsort(cell, kind="stable")
            cell, total = cell[order], total[order]
            begin = np.flatnonzero(np.diff(cell, prepend=-2))
            count = np.diff(np.append(begin, len(cell)))
            sums = (np.add.reduceat(total, begin), np.maximum.reduceat(total, begin)) if len(begin) else (total, total)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (cell[begin], *sums, count)], ["cell", "size", "largest", "groups"])

    return run


def _cells(groups: DataFrame, stretches: list[tuple[int, int]], edges: list[int]) -> list[Cell]:
    """The cells between ``edges`` inside ``stretches`` (both in order), without empty ones."""
    inside = None
    for low, high in stretches:
        one = (F.col("key") >= low) & (F.col("key") < high)
        inside = one if inside is None else inside | one
    bounds = np.array(edges, np.int64)
    rows = groups.filter(inside) if len(stretches) <= 256 else groups
    found = rows.mapInArrow(_sums(bounds), "cell long, size long, largest long, groups long").filter("cell >= 0").groupBy("cell").agg(
        F.sum("size").alias("size"), F.max("largest").alias("largest"), F.sum("groups").alias("groups")).collect()
    ends = [*edges[1:], 1 << KEY_BITS]
    cells = [Cell(edges[r["cell"]], ends[r["cell"]], r["size"], r["largest"], r["groups"]) for r in found]
    highs = [h for _, h in stretches]
    lows = [x for x, _ in stretches]
    return sorted((c for c in cells if (i := bisect.bisect_right(lows, c.low) - 1) >= 0 and c.low < highs[i]), key=lambda c: c.low)


class Order:
    """Edges of groups, as places in the sum of all sizes; notes the cells that it would have to know better."""

    def __init__(self, cells: list[Cell]) -> None:
        self.cells, self.starts, self.asked = cells, [0], set()
        for c in cells:
            self.starts.append(self.starts[-1] + c.size)
        self.total = self.starts[-1]

    def down(self, x: int, note: bool = True, hopeful: bool = False) -> int:
        """The last edge at or before ``x``; inside a cell that is not known, the best or the worst it may be."""
        if x >= self.total:
            return self.total
        i = bisect.bisect_right(self.starts, x) - 1
        c = self.cells[i]
        if x == self.starts[i] or c.groups == 1:
            return self.starts[i]
        if note:
            self.asked.add(i)
        return x if hopeful else max(self.starts[i], x - c.largest + 1)

    def up(self, x: int) -> int:
        """The first edge at or behind ``x``."""
        if x <= 0:
            return 0
        i = min(bisect.bisect_left(self.starts, x), len(self.starts) - 1)
        if self.starts[i] != x and self.cells[i - 1].groups > 1:
            self.asked.add(i - 1)
        return self.starts[i]


def fits(order: Order, capacity: int, shards: int) -> bool:
    """Whether shards of this capacity, filled greedily, suffice."""

    def fill(**how) -> bool:
        at = 0
        for _ in range(shards):
            end = order.down(at + capacity, **how)
            if end >= order.total:
                return True
            if end <= at:
                return False
            at = end
        return False

    # where the best and the worst that cells may hold agree, nothing need be known of them
    if fill(note=False):
        return True
    return fill(note=False, hopeful=True) and fill()


def least_capacity(order: Order, shards: int) -> int:
    low, high = max([-(-order.total // shards), *(c.largest for c in order.cells)]), order.total
    while low < high:
        middle = (low + high) // 2
        if fits(order, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def balanced_cuts(order: Order, capacity: int, shards: int) -> list[int]:
    """Places at which the shards from the second on begin."""
    # from the right: where the rest fits into k shards, and where k groups are left
    fit, left = [order.total], [order.total]
    for _ in range(shards - 1):
        fit.append(order.up(fit[-1] - capacity))
        left.append(order.down(left[-1] - 1) if left[-1] else 0)
    at, out = 0, []
    for n in range(shards - 1, 0, -1):
        target = at + -(-(order.total - at) // (n + 1))
        below, above = order.down(target), order.up(target)
        nearest = below if target - below <= above - target else above
        first, last = max(fit[n], order.up(at + 1) if at < order.total else at), min(order.down(at + capacity), left[n])
        at = max(first, min(nearest, last))
        out.append(at)
    return out


def boundaries(groups: DataFrame, shards: int) -> list[int]:
    """First keys of the shards from the second on; ``groups`` has key (``KEY_BITS`` bits, unique) and total."""
    total = groups.agg(F.sum("total")).first()[0] or 0
    # fewer than cells, as each is above the share of one
    large = [row[0] for row in groups.filter(F.col("total") > total >> CELLS).select("key").collect()]
    top = 1 << KEY_BITS
    edges = sorted({k << (KEY_BITS - CELLS) for k in range(1 << CELLS)} | {k for x in large for k in (x, x + 1) if k < top})
    cells = _cells(groups, [(0, top)], edges)
    while True:
        order = Order(cells)
        cuts = balanced_cuts(order, least_capacity(order, shards), shards) if cells else []
        if not order.asked:
            break
        stretches, edges = [], []
        for i in sorted(order.asked):
            c = cells[i]
            stretches.append((c.low, c.high))
            wide = c.high - c.low
            edges += sorted({c.low + (wide * k >> SPLIT) for k in range(1 << SPLIT)})
            edges.append(c.high)  # opens what lies between two stretches
        edges = [e for e in dict.fromkeys(edges) if e < top]
        cells = sorted([c for i, c in enumerate(cells) if i not in order.asked] + _cells(groups, stretches, edges), key=lambda c: c.low)
    begin = {start: c.low for start, c in zip(order.starts, cells)}
    return [begin.get(place, top) for place in cuts]


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.shiftrightunsigned(F.xxhash64(text), 64 - KEY_BITS).alias("key"))
    rows = cut(rows, "sizes")  # each round of refinement reads numbers only
    # in order, so that a look into some stretches reads some row groups
    groups = rows.groupBy("key").agg(F.sum("size").alias("total")).repartitionByRange("key").sortWithinPartitions("key")
    cuts = boundaries(cut(groups, "groups"), shards)
    shard = F.lit(0)
    for n, key in enumerate(cuts, 1):  # one comparison for each shard
        shard = F.when(F.col("key") >= key, n).otherwise(shard)
    # slots: a shard is numbered in parts, by the first bits of the key and a hash of the id, since one group may be most of it
    rows = rows.withColumn("shard", shard.cast("int")).withColumn(
        "_part", F.shiftright("key", KEY_BITS - 8) * SPREAD + F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)))
    parts = rows.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_part").orderBy("key", "doc_id", "size")
    rows = rows.withColumn("_row", F.row_number().over(inside) - 1).join(parts, ["shard", "_part"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_before") + F.col("_row")).cast("long").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))
