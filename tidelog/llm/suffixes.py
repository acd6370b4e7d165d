"""Exact removal of repeated byte strings by a common-prefix-aware distributed merge sort of suffixes.

1. *Anchors.*  Of the 50-byte strings inside each 200-byte window the one of least hash is the window's anchor.  The
   choice depends on the window's bytes alone, so equal windows have equal anchors.  An anchor whose hash occurs once
   in the corpus has no repeated window; only the others go on.  This prunes suffixes and decides nothing.
2. *Runs.*  A task sorts its remaining suffixes (from the anchor on, to the end of the last window that has it), merges
   equal ones, and writes the run front-coded: length of the prefix shared with the entry before, and the rest.
   Each entry carries its left context too.  Runs are dealt by the first 50 bytes, so equal anchors meet.
3. *Merge.*  A loser tree merges the runs.  It keeps for every player the prefix shared with the last winner: the longer
   one wins without a look at the bytes, and equal ones are compared behind the shared prefix.  The merged order gives
   each suffix with the prefix it shares with its neighbour: an anchor's suffixes stand together, whole copies
   are recognised by the shared length, and only entries that differ have their windows compared, those with the anchor in
   the same place and in so far as the shared prefix allows.
4. *Spans.*  Stretches of repeated windows go back to their document and are joined to spans.

An anchor with more than ``hot`` occurrences is expanded into single windows, which are dealt by all their bytes; equal
ones are merged in the run before, so however common a passage is, a task receives one entry per run.

Nulls are empty texts.  Rows with equal doc_id and text are two occurrences: they are merged to one row before the anchors, and each goes
whole where it has a window.  A text below the window length is kept whole.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _SPAN, batches, cut, lean, mix, powers, prefix_sums, row_key, text_buffer
from .naming import spread_join

WINDOW, CORE, HOT = 200, 50, 20_000
PART_BYTES, _AT_ONCE = 16 << 20, 512
_BYTES = 1 << 20  # of texts whose anchors are in memory at once, if no text is longer
_TEXTS = 8 << 20  # of texts that are cut into runs or freed from repeats at once, if no text is longer
_WINDOWS, _PLACES = 16_384, 256  # windows of a group compared at once; more than the starts a block can have
_ROWS = 4_000
_FIELDS = "part int, k1 long, k2 long, spans array<int>, lcp array<int>, tail array<binary>, left array<binary>, " \
          "d1 array<long>, d2 array<long>, pos array<int>"
_ARROW = pa.schema([
    ("part", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("spans", pa.list_(pa.int32())), ("lcp", pa.list_(pa.int32())),
    ("tail", pa.list_(pa.binary())), ("left", pa.list_(pa.binary())), ("d1", pa.list_(pa.int64())), ("d2", pa.list_(pa.int64())),
    ("pos", pa.list_(pa.int32())),
])
_SPANS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("spans", pa.list_(pa.int32()))])


def anchors(data: np.ndarray, at: np.ndarray, window: int = WINDOW, core: int = CORE):
    """For each anchor: hash, text number, place, first and last start of the windows it stands for (within the text)."""
    n, wide = len(data), window - core + 1
    found = []
    step = _SPAN - window
    for low in range(0, max(n - window + 1, 0), step):
        piece = data[low:low + step + window - 1]
        count = len(piece) - core + 1
        sums = prefix_sums(piece)
        hashes = mix((sums[core:] - sums[:-core]) * powers(_SPAN + 1)[_SPAN - np.arange(count)])
        least = (hashes & ~np.uint64(_SPAN - 1)) | np.arange(count, dtype=np.uint64)
        span = 1
        while 2 * span <= wide:
            least, span = np.minimum(least[:-span], least[span:]), 2 * span
        if span < wide:
            least = np.minimum(least[:-(wide - span)], least[wide - span:])
        place = (least & np.uint64(_SPAN - 1)).astype(np.int64)
        valid = np.ones(len(place), bool)
        for edge in at[np.searchsorted(at, low, "right"):np.searchsorted(at, low + len(piece))] - low:
            valid[max(0, edge - window + 1):edge] = False
        start = np.flatnonzero(valid)
        if not len(start):
            continue
        new = np.flatnonzero(np.concatenate(([True], (np.diff(start) > 1) | (np.diff(place[start]) != 0))))
        first, last = start[new], start[np.concatenate((new[1:] - 1, [len(start) - 1]))]
        where = place[first]
        text = np.searchsorted(at, where + low, "right") - 1
        shift = low - at[text]
        found.append((hashes[where].view(np.int64), text, where + shift, first + shift, last + shift))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found))


@lean
def _anchor_counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(it, size=_BYTES):
        h, *_ = anchors(*text_buffer(batch.column("text")))
        values, counts = np.unique(h, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], ["h", "n"])


@lean
def _anchor_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text and hash: a text that repeats a short string has the same anchor over and over."""
    for batch in batches(it, size=_BYTES):
        h, text, place, first, last = anchors(*text_buffer(batch.column("text")))
        packed = place << 16 | (place - first) << 8 | (last - first)  # the last two are below 256
        order = np.lexsort((packed, h, text))
        h, text, packed = h[order], text[order], packed[order]
        new = np.concatenate(([True], (np.diff(text) != 0) | (np.diff(h) != 0)))[:len(h)]
        begin = np.flatnonzero(new)
        rest = np.concatenate(([0], np.cumsum(np.diff(np.concatenate((begin, [len(h)]))) - 1))).astype(np.int32)
        more = pa.ListArray.from_arrays(pa.array(rest), pa.array(packed[~new]), mask=pa.array(np.diff(rest) == 0))
        k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False)[text[begin]] for c in ("k1", "k2"))
        yield pa.RecordBatch.from_arrays([pa.array(h[begin]), pa.array(k1), pa.array(k2), pa.array(packed[begin]), more], ["h", "k1", "k2", "packed", "more"])


def common(a: bytes, b: bytes, skip: int = 0) -> int:
    """Length of the shared prefix, of which ``skip`` bytes are known."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[skip:n], "big") ^ int.from_bytes(b[skip:n], "big")
    return n - (differ.bit_length() + 7) // 8


def front_code(run: list[tuple]) -> Iterator[tuple]:
    """(shared prefix, rest, *others) of a sorted run."""
    before = b""
    for right, *others in run:
        shared = common(before, right)
        yield shared, right[shared:], *others
        before = right


def decode_run(coded) -> Iterator[tuple]:
    """(suffix, prefix shared with the one before, *others)."""
    before = b""
    for shared, rest, *others in coded:
        before = before[:shared] + rest
        yield before, shared, *others


def merge_runs(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """(suffix, prefix shared with the one before, *others) in order, by a loser tree of shared prefixes."""
    k = 1
    while k < len(runs):
        k *= 2
    players: list[tuple | None] = [next(r, None) for r in runs] + [None] * (k - len(runs))
    shared = [0] * k  # with the last winner

    def loses(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)."""
        x, y = players[a], players[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        both = common(x[0], y[0], shared[a])
        first, second = (a, b) if x[0][both:both + 1] <= y[0][both:both + 1] else (b, a)
        shared[second] = both
        return first, second

    tree = [0] * k
    level = list(range(k))
    base = k
    while len(level) > 1:
        base //= 2
        up = []
        for i in range(0, len(level), 2):
            winner, tree[base + i // 2] = loses(level[i], level[i + 1])
            up.append(winner)
        level = up
    winner = level[0]
    while (x := players[winner]) is not None:
        yield x[0], shared[winner], *x[2:]
        x = players[winner] = next(runs[winner], None) if winner < len(runs) else None
        shared[winner] = x[1] if x is not None else 0
        node = (k + winner) // 2
        while node:
            winner, tree[node] = loses(winner, tree[node])
            node //= 2


def _runs(parts: int, hot: int):
    @lean
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, size=_TEXTS):
            data, at = text_buffer(batch.column("text"))
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            entries: dict[tuple[int, bytes, bytes], list] = {}  # (hot, right, left): first owner, more
            local = defaultdict(list)
            for i, found in enumerate(batch.column("found").to_pylist()):
                raw = data[at[i]:at[i + 1]].tobytes()
                for packed, n in ((p, x["n"]) for x in found for p in (x["packed"], *(x["more"] or ()))):
                    place, left, windows = packed >> 16, packed >> 8 & 255, packed & 255
                    first = place - left
                    pieces = [(0, place, first, first + windows)] if n <= hot else [(1, s, s, s) for s in range(first, first + windows + 1)]
                    for kind, place, low, high in pieces:
                        key = kind, raw[place:high + WINDOW], raw[low:place]
                        if (own := entries.get(key)) is None:
                            entries[key] = [i, low, high, False]
                        else:
                            if not own[3]:
                                local[own[0]] += own[1], own[2] + WINDOW
                                own[3] = True
                            local[i] += low, high + WINDOW
            dealt = defaultdict(list)
            for (kind, right, left), (i, low, _, more) in entries.items():
                part = 2 * (zlib.crc32(right if kind else right[:CORE]) % parts) + kind
                dealt[part].append((right, left, None if more else k1[i], None if more else k2[i], low))
            rows = [(2 * (zlib.crc32(k2[i].to_bytes(8, "big", signed=True)) % parts), k1[i], k2[i], spans, *[None] * 6) for i, spans in local.items()]
            for part, entry in dealt.items():
                entry.sort(key=lambda x: x[:2])
                rows.append((part, None, None, None, *map(list, zip(*front_code(entry)))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    return run


def repeated(merged: Iterator[tuple], least: int) -> Iterator[tuple[int, int, int, int]]:
    """(k1, k2, first start, last start) of windows that occur twice or more, of suffixes in order; groups share ``least`` bytes."""
    group: list[tuple] = []

    def solve() -> Iterator[tuple[int, int, int, int]]:
        blocks: dict[tuple[bytes, bytes], list] = {}
        near, lowest = [], 0  # prefix that a block shares with the one before
        for right, shared, left, k1, k2, low in group:
            lowest = min(lowest, shared)
            if (owners := blocks.get((right, left))) is None:
                owners = blocks[right, left] = []
                near.append(lowest)
                lowest = WINDOW
            owners.append((k1, k2, low))
        for (right, left), owners in blocks.items():
            if len(owners) > 1 or owners[0][0] is None:
                last = len(left) + len(right) - WINDOW
                yield from ((k1, k2, low, low + last) for k1, k2, low in owners if k1 is not None)
        if len(blocks) > 1:
            yield from apart(blocks, near)

    for right, shared, *others in merged:
        if shared < least and group:
            if len(group) > 1:
                yield from solve()
            group = []
        group.append((right, shared, *others))
    if len(group) > 1:
        yield from solve()


def apart(blocks: dict[tuple[bytes, bytes], list], near: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Windows that blocks of one owner share with other blocks of their group.

    Equal windows have their anchor in one place, so those with as many bytes before it are compared, some places at a time.
    A block's neighbours in order tell how much from the anchor on it shares with any other.
    """
    whole, ranges = [], []
    for (right, left), ahead, behind in zip(blocks, near, [*near[1:], 0]):
        whole.append(left + right)
        ranges.append((len(left), WINDOW - max(ahead, behind)))
    step = max(1, _WINDOWS // len(whole))
    hits = None  # by block and start
    for top in range(max(x for x, _ in ranges), min(x for _, x in ranges) - 1, -step):
        found: dict[bytes, int] = {}
        for i, (text, (most, fewest)) in enumerate(zip(whole, ranges)):
            for s in range(most - min(most, top), most - max(fewest, top - step + 1) + 1):
                here = i * _PLACES + s
                if (first := found.setdefault(text[s:s + WINDOW], here)) != here:
                    if hits is None:
                        hits = bytearray(len(whole) * _PLACES)
                    hits[first] = hits[here] = 1
    if hits is None:
        return
    at = np.flatnonzero(np.frombuffer(hits, np.uint8))
    breaks = np.flatnonzero(np.diff(at) > 1)
    owners = list(blocks.values())
    for first, last in zip(at[np.concatenate(([0], breaks + 1))].tolist(), at[np.concatenate((breaks, [len(at) - 1]))].tolist()):
        i, s = divmod(first, _PLACES)
        if len(owners[i]) == 1 and owners[i][0][0] is not None:
            k1, k2, low = owners[i][0]
            yield k1, k2, low + s, low + s + last - first


def _entries(columns: list[pa.Array]) -> Iterator[tuple]:
    """Entries of a run, some at a time as Python values; the run itself stays an Arrow buffer."""
    for low in range(0, len(columns[0]), _AT_ONCE):
        yield from zip(*(c.slice(low, _AT_ONCE).to_pylist() for c in columns))


@lean
def _merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SPANS)], schema=_SPANS)

    def solved(part: int, runs: list) -> Iterator[tuple]:
        starts = defaultdict(lambda: array("i"))  # first and last, in turn
        for k1, k2, first, last in repeated(merge_runs([decode_run(_entries(r)) for r in runs]), WINDOW if part % 2 else CORE):
            starts[k1, k2].extend((first, last))
        for (k1, k2), found in starts.items():
            low, high = np.array(found).reshape(-1, 2).T
            order = np.argsort(low)
            low, high = low[order], np.maximum.accumulate(high[order])
            breaks = np.flatnonzero(low[1:] - high[:-1] > WINDOW)
            low, high = low[np.concatenate(([0], breaks + 1))], high[np.concatenate((breaks, [len(high) - 1]))] + WINDOW
            yield k1, k2, np.stack((low, high), 1).ravel().tolist()

    part, runs = None, []
    for batch in it:
        rows, columns = [], [batch.column(c) for c in _ARROW.names]
        for i, of in enumerate(columns[0].to_pylist()):
            if columns[3][i].is_valid:
                rows.append(tuple(c[i].as_py() for c in columns[1:4]))
                continue
            if of != part:
                if runs:
                    yield from map(out, batched(solved(part, runs), _ROWS))
                part, runs = of, []
            runs.append([c[i].values for c in columns[4:]])
        if rows:
            yield out(rows)
        del batch, columns  # what the part still needs is in its runs
    if runs:
        yield from map(out, batched(solved(part, runs), _ROWS))


def _remove(texts: bool):
    @lean
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, size=_TEXTS):
            yield _rest(batch, texts)

    return run


def _rest(batch: pa.RecordBatch, texts: bool) -> pa.RecordBatch:
    data, at = text_buffer(batch.column("text"))
    kept, removed, spans = [], [], []
    for i, found in enumerate(batch.column("spans").to_pylist()):
        raw = data[at[i]:at[i + 1]]
        if found:
            low, high = np.array(found[0::2]), np.array(found[1::2])
            order = np.argsort(low, kind="stable")
            low, high = low[order], np.maximum.accumulate(high[order])
            new = np.flatnonzero(np.concatenate(([True], low[1:] > high[:-1])))
            low, high = low[new], high[np.concatenate((new[1:] - 1, [len(high) - 1]))]
            rest = b"".join(raw[a:b].tobytes() for a, b in zip([0, *high], [*low, len(raw)]))
            removed.append(int((high - low).sum()))
            spans.append(np.stack((low, high), 1).ravel().tolist())
        else:
            rest = raw.tobytes()
            removed.append(0)
            spans.append([])
        kept.append(rest)
    sizes = pa.array(np.diff(at))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), sizes, pa.array(removed, pa.int64()), pa.array([len(s) // 2 for s in spans], pa.int64()),
         pa.array([hashlib.sha256(x).hexdigest() for x in kept]), pa.array(spans, pa.list_(pa.int32())), pa.array([x.decode("utf-8", "ignore") for x in kept]) if texts else pa.array(kept, pa.binary()),
         *(batch.column(c) for c in batch.schema.names if c not in ("doc_id", "k1", "k2", "text", "spans"))],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept",
         *(c for c in batch.schema.names if c not in ("doc_id", "k1", "k2", "text", "spans"))])


def remove_repeats(docs: DataFrame, carry: tuple[str, ...] = (), texts: bool = False, hot: int = HOT) -> DataFrame:
    """Every document without the bytes of 200-byte strings that also start elsewhere in ``docs``.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (starts and ends of the removed runs, in turn),
    kept (the bytes that stay) and the columns ``carry``.  With ``texts``, kept is a string, without the bytes of characters
    that a removed run has cut.
    """
    names = {f"carry_{i}": c for i, c in enumerate(carry)}
    rows = docs.select(*row_key(), F.col("doc_id").cast("long").alias("doc_id"), "text", *(F.col(c).alias(n) for n, c in names.items()))
    found = cut(rows.groupBy("k1", "k2").agg(F.count("*").alias("count"), F.max(F.octet_length("text")).alias("bytes")), "rows")
    # a part is what a task merges: by the bytes that there are, whatever the session's setting
    total = found.agg(F.sum("bytes")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    copied = found.filter("count > 1").select("k1", "k2", "count")
    again = not copied.isEmpty()
    keyed = rows.join(copied, ["k1", "k2"], "left_anti") if again else rows
    slim = keyed.select("k1", "k2", "text")
    if again:
        # a repeated row takes part once; all of it goes where it has a window
        copies = spread_join(rows, copied, ["k1", "k2"]).drop("count")
        once = copies.groupBy("k1", "k2").agg(F.first("text").alias("text"))
        slim = slim.unionByName(once)
    counts = slim.select("text").mapInArrow(_anchor_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1")
    anchored = slim.mapInArrow(_anchor_rows, "h long, k1 long, k2 long, packed long, more array<long>").join(counts, "h")
    anchored = anchored.groupBy("k1", "k2").agg(F.collect_list(F.struct("packed", "more", "n")).alias("found"))
    # both joins take all columns of ``keyed``, so that its texts are shuffled once
    source = slim if again else keyed
    runs = source.join(anchored, ["k1", "k2"]).mapInArrow(_runs(parts, hot), _FIELDS)
    spans = runs.repartition("part").sortWithinPartitions("part").mapInArrow(_merge, "k1 long, k2 long, spans array<int>")
    spans = spans.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<int>, kept " + ("string" if texts else "binary") \
        + "".join(f", {n} {kinds[c]}" for n, c in names.items())
    spanned = keyed.join(spans, ["k1", "k2"], "left")
    if again:
        size = F.octet_length("text").cast("int")
        spanned = spanned.unionByName(copies.withColumn("spans", F.when(size >= WINDOW, F.array(F.lit(0), size))))
    return spanned.mapInArrow(_remove(texts), schema).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept", *(F.col(n).alias(c) for n, c in names.items()))
