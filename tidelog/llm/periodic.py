"""Runs of periodic words, found online by sparse diagonals.

Diagonal q holds the comparisons of each word with the one q words before it; a stretch of matches on it, with the q words before,
is a stretch of period q.  Words are read from left to right; an earlier occurrence at distance q adds to the match length of
diagonal q, and a diagonal that ends with sufficient length emits its run at once.

Sparse: all earlier occurrences of a word would be a square number (a text may be one word a million times).  A run of
period q is at least 4 q long, so its diagonal matches over 3 q words or more, and what recurs at distance q is not only
a word but ``wide`` words, 2 q <= wide <= 3 q.  Where ``wide`` words recur at distance q inside a run of smallest period q,
their nearest earlier occurrence is at distance q exactly: a nearer one, at distance d < q, would give the run the period
gcd(d, q), by the periodicity lemma.  So for each class of periods (1, 2-3, 4-6, 7-10, ...: the largest is at most 1.5 times
the least) only the nearest earlier occurrence counts, one diagonal is active at a time, and all classes together take n log n
steps.  Names of stretches are exact (words by their bytes, longer stretches by pairs of names), no hash is involved.

A null text has no words; a null doc_id leaves its words as they are.  Rows are independent, so repeated rows and ids do not matter;
an empty table gives an empty result.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

LEAST, TIMES = 6, 4
_PIECE = 1 << 20
_BREAKS = tuple(bytes([b]) for b in b" \t\n\x0b\x0c\r")
_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
])


def _pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; bytes.split() breaks at the same six characters."""
    low = 0
    while low < len(raw):
        high = min(low + _PIECE, len(raw))
        if high < len(raw):
            ends = [e for b in _BREAKS if (e := raw.find(b, high, high + _PIECE)) >= 0]
            while not ends and high < len(raw):  # a word that is longer than a piece
                high = min(high + _PIECE, len(raw))
                ends = [e for b in _BREAKS if (e := raw.find(b, high, high + _PIECE)) >= 0]
            high = min(ends, default=len(raw))
        yield raw[low:high].split()
        low = high


def word_numbers(raw: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The number of each word, and the distinct words."""
    seen: dict[bytes, int] = {}
    parts = [np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)) for words in _pieces(raw)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64), list(seen)


def periodic_tail(numbers: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The words of every tenth document (by a hash of its id) with a periodic tail instead of their own."""
    n = len(numbers)
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return numbers
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate((numbers[:a], numbers[a + np.arange(n - a) % p]))


def _classes(n: int) -> Iterator[tuple[int, int, int]]:
    """(least period, largest period, words that recur) for all periods that fit."""
    low = 1
    while low * TIMES <= n:
        high = 3 * low // 2
        yield low, high, 2 * high
        low = high + 1


def runs(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    n, found = len(numbers), []
    names, span = numbers, 1  # names of the stretches of ``span`` words that begin at each word
    for low, high, wide in _classes(n) if n >= LEAST else ():
        while 2 * span <= wide:
            names = _pair(names[:-span], names[span:])
            span *= 2
            if int(names.max(initial=0)) + 1 == len(names):
                return sorted(found)  # no stretch recurs, so no longer one does
        last = len(numbers) - wide
        grams = names[:last + 1] if span == wide else _pair(names[:last + 1], names[wide - span:wide - span + last + 1])
        order = np.argsort(grams, kind="stable")
        lag = np.zeros(last + 1, np.int64)  # to the nearest earlier occurrence
        again = np.flatnonzero(np.diff(grams[order]) == 0)
        lag[order[again + 1]] = order[again + 1] - order[again]
        lag[(lag < low) | (lag > high)] = 0
        # the active diagonal changes or ends here
        edge = np.flatnonzero(np.diff(lag, prepend=0, append=0))
        for begin, end in zip(edge, edge[1:]):
            q = int(lag[begin])
            start, length = int(begin) - q, int(end - begin) + wide - 1 + q
            if q and length >= max(LEAST, TIMES * q):
                found.append((start, length, q))
    return sorted(found)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names of pairs of names."""
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def _digests(raw: bytes, doc_id: int | None) -> tuple:
    own, distinct = word_numbers(raw)
    numbers = periodic_tail(own, doc_id)
    found = runs(numbers)
    listed = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
    rest = np.zeros(len(numbers) + 1, np.int64)
    for s, m, q in found:
        rest[s + q] += 1
        rest[s + m] -= 1
    kept = np.cumsum(rest)[:-1] == 0
    collapsed, begun = hashlib.sha256(), False
    for low in range(0, len(numbers), _PIECE):
        words = [distinct[k] for k in numbers[low:low + _PIECE][kept[low:low + _PIECE]]]
        if words:
            collapsed.update(b" " * begun + b" ".join(words))
            begun = True
    best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
    start, length, period = best or (None, None, None)
    return doc_id, len(found), start, length, period, best and 1000 * length // period, listed, collapsed.hexdigest()


def _measure(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(it):
        rows = [_digests(text.as_buffer().to_pybytes() if text.is_valid else b"", doc_id.as_py())
                for text, doc_id in zip(batch.column("text"), batch.column("doc_id"))]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)] if rows else [pa.array([], f.type) for f in _OUT], schema=_OUT)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of each row."""
    kinds = {"int64": "long", "string": "string"}
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _measure, ", ".join(f"{f.name} {kinds[str(f.type)]}" for f in _OUT))
