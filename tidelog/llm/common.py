"""Helpers shared by the operators: cutting lineage, memory of Arrow tasks, Arrow text buffers, vectorised hashes of words and byte strings."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import work_dir

#: Words are runs of characters other than these; bytes.split() has the same rule.
SPACE = r"\x20\x09-\x0D"
WORD_PATTERN = f"[^{SPACE}]+"

_BASE = 0x9E3779B97F4A7C15 | 1
_SPAN = 1 << 20  # longest stretch of bytes hashed at once
_ENDS = 64  # bytes kept of each end of a word that is longer
_powers: dict[int, np.ndarray] = {}

Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def cut(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` written to the shared folder and read again: ends the lineage, survives lost executors."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@lru_cache(1)
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not the GNU library
        return None


def give_back() -> None:
    """Memory that is free, but kept by Arrow or the C library, goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def lean(step: Step) -> Step:
    """The step; at its end it gives back what it no longer uses.

    Python workers outlive their tasks, and what one keeps while it idles is missing to the executor in the stages to come.
    """

    @wraps(step)
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(it)
        finally:
            give_back()

    return run


def row_key() -> tuple[Column, Column]:
    """Two longs that rows share only if doc_id and text are equal; never null."""
    return F.coalesce("doc_id", F.lit(-1)).cast("long").alias("k1"), F.xxhash64("text", "doc_id").alias("k2")


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and where each begins (one entry more than texts); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def powers(n: int) -> np.ndarray:
    if 0 not in _powers or len(_powers[0]) < n:
        p = np.full(max(n, _SPAN + 1), _BASE, np.uint64)
        p[0] = 1
        _powers[0] = np.multiply.accumulate(p)
    return _powers[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * base ** position modulo 2 ** 64; a difference of two is the hash of the bytes between."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[:len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings [start, end) that do not depend on where a string stands (within _SPAN)."""
    return mix((sums[end] - sums[start]) * powers(_SPAN + 1)[_SPAN - start])


def words(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Words of all texts, in stretches that end between words: (hashes, text numbers, starts, ends, prefix sums).

    Starts and ends count from the beginning of the stretch.  A stretch ends behind white space or where a text does.  A word
    that is longer than a stretch comes alone: its hash is that of the whole word, and its sums, start and end are those of
    its first and last ``_ENDS`` bytes put together.
    """
    n, low = len(data), 0
    while low < n:
        high = min(n, low + _SPAN)
        piece = data[low:high]
        space = (piece == 32) | ((piece >= 9) & (piece <= 13))
        if high < n:
            breaks = np.flatnonzero(space)
            last = max(low + int(breaks[-1]) + 1 if len(breaks) else low, int(at[np.searchsorted(at, high, "right") - 1]))
            if last <= low:
                yield _long_word(data, at, low)
                low = _word_end(data, at, low)
                continue
            high = last
            piece, space = data[low:high], space[:high - low]
        edge = np.zeros(len(piece) + 1, bool)  # texts begin here, so words end here
        inner = at[np.searchsorted(at, low):np.searchsorted(at, high, "right")] - low
        edge[inner] = True
        letter = ~space
        before = np.concatenate(([False], letter[:-1]))
        after = np.concatenate((letter[1:], [False]))
        start = np.flatnonzero(letter & (~before | edge[:-1]))
        end = np.flatnonzero(letter & (~after | edge[1:])) + 1
        sums = prefix_sums(piece)
        text = np.searchsorted(at, start + low, "right") - 1
        yield span_hashes(sums, start, end), text, start, end, sums
        low = high


def _word_end(data: np.ndarray, at: np.ndarray, low: int) -> int:
    """Where the word that begins at ``low`` ends."""
    last = int(at[np.searchsorted(at, low, "right")])
    for begin in range(low, last, _SPAN):
        piece = data[begin:min(begin + _SPAN, last)]
        breaks = np.flatnonzero((piece == 32) | ((piece >= 9) & (piece <= 13)))
        if len(breaks):
            return begin + int(breaks[0])
    return last


def _long_word(data: np.ndarray, at: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The entry of a word of any length: parts counted from its own start add up to the hash that span_hashes would give."""
    high = _word_end(data, at, low)
    total, shift = np.zeros(1, np.uint64), np.ones(1, np.uint64)
    for begin in range(low, high, _SPAN):
        total += prefix_sums(data[begin:min(begin + _SPAN, high)])[-1:] * shift
        shift *= powers(_SPAN + 1)[_SPAN]
    ends = np.concatenate((data[low:high][:_ENDS], data[low:high][_ENDS:][-_ENDS:]))
    text = np.searchsorted(at, [low], "right") - 1
    return mix(total * powers(_SPAN + 1)[_SPAN]), text, np.array([0]), np.array([len(ends)]), prefix_sums(ends)


def batches(it: Iterator[pa.RecordBatch], rows: int = 2000, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that long texts do not add up: of so many rows at most, and halved while they have over ``size`` bytes."""
    for batch in it:
        for low in range(0, batch.num_rows, rows):
            parts = [batch.slice(low, rows)]
            while parts:
                part = parts.pop()
                half = part.num_rows // 2
                if size and half and part.nbytes > size:
                    parts += [part.slice(half), part.slice(0, half)]
                else:
                    yield part
