"""Suffix removal where rows repeat."""

import hashlib
import random

from tidelog.llm.suffixes import remove_repeats

from .test_operators import low, without_repeats, words


def result(df):
    return sorted((low(x.doc_id), x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in remove_repeats(df).collect())


def test_many_equal_rows(spark):
    r = random.Random(7)
    text, other = words(r, 250), words(r, 300)
    rows = [(1, text), (1, text), (2, text[:500] + " " + other), (3, other[-400:]), (4, words(r, 200)), (None, "short"), (None, "short"), (5, None), (5, None)]
    small = result(spark.createDataFrame(rows, "doc_id long, text string"))
    assert small == without_repeats(rows)
    many = spark.range(100_000).selectExpr("1L AS doc_id", f"'{text}' AS text").unionByName(spark.createDataFrame(rows[2:], "doc_id long, text string"))
    n = len(text.encode())
    want = [(1, n, n, 1, hashlib.sha256(b"").hexdigest())] * 100_000 + [x for x in small if x[0] != 1]
    assert result(many) == sorted(want)


def test_carried_columns_with_names_of_results(spark):
    r = random.Random(9)
    text = words(r, 90)
    docs = spark.createDataFrame([(1, text, "a", 1), (2, text, "b", 2), (2, text, "b", 2), (3, "x", None, 3)], "doc_id long, text string, removed string, k1 int")
    got = remove_repeats(docs, ("k1", "removed"))
    assert got.columns[-2:] == ["k1", "removed"]
    assert sorted((tuple(x)[-2:], x.n_removed > 0) for x in got.collect() if x.doc_id != 3) == [((1, "a"), True), ((2, "b"), True), ((2, "b"), True)]
