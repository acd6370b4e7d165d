"""Runs of periodic words against a search over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidelog.llm.periodic import _PIECE, periodic_runs, periodic_tail, runs, word_numbers


def brute(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(6, 4 * q) and not any(words[start + p:start + length] == words[start:start + length - p] for p in range(1, q)):
                found[start, length, q] = True
            i = j
    return sorted(found)


def made(r, kind):
    n = r.randrange(0, 90)
    if kind == 0:
        return [r.randrange(2) for _ in range(n)]
    if kind == 1:
        return [r.randrange(3) for _ in range(r.randrange(20))] + [r.randrange(3) for _ in range(1 + r.randrange(12))] * r.randrange(1, 9) + [r.randrange(4)]
    unit = [r.randrange(2) for _ in range(1 + r.randrange(4))] * r.randrange(1, 5) + [9]
    return unit * r.randrange(1, 8) + [r.randrange(2)] * r.randrange(9) + unit


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    r = random.Random(seed)
    for k in range(400):
        words = made(r, k % 3)
        assert runs(np.array(words, np.int64)) == brute(words), words


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
    out = {i for s, m, q in found for i in range(s + q, s + m)}
    return (doc_id, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in out)).hexdigest())


def test_documents(spark):
    r = random.Random(3)
    texts = [r.choice((" ", "\n", " \x0b")).join(f"w{x}" for x in made(r, k % 3)) for k in range(150)]
    texts += [None, "", " \n ", "a", "a a a a a", "a a a a a a", "é é  é é é é é", "x\x1cy " * 9, " ".join(["la"] * 300)]
    rows = [(None if k % 23 == 4 else k * 7, t, "x", 5) for k, t in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, n_runs int").repartition(3)
    got = sorted(map(tuple, periodic_runs(docs).collect()), key=repr)
    assert got == sorted((expected(d, t) for d, t, *_ in rows), key=repr)
    assert any(x[1] for x in got)


def test_long_texts(spark):
    # one word a million times, a square number of equal pairs; a word longer than a piece; words cut by no piece
    text = "la " * 1_000_000 + "b" * (3 * _PIECE) + " c" * 9
    numbers, distinct = word_numbers(text.encode())
    assert distinct[0] == b"la" and [len(w) for w in distinct[1:]] == [3 * _PIECE, 1] and len(numbers) == 1_000_010
    assert runs(numbers) == [(0, 1_000_000, 1), (1_000_001, 9, 1)]
    numbers, distinct = word_numbers(("ab\tcd\n" * _PIECE).encode())
    assert distinct == [b"ab", b"cd"] and (numbers == np.arange(2 * _PIECE) % 2).all()
    row = periodic_runs(spark.createDataFrame([(None, text)], "doc_id long, text string")).first()
    assert (row.n_runs, row.start, row.length, row.period) == (2, 0, 1_000_000, 1)


def test_tail():
    numbers = np.arange(50)
    changed = [d for d in range(200) if not np.array_equal(periodic_tail(numbers, d), numbers)]
    assert 0 < len(changed) <= sum(zlib.crc32(str(d).encode()) % 10 == 0 for d in range(200))
    assert periodic_tail(numbers, None) is numbers


def test_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
