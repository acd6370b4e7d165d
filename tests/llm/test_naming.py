"""Exact duplicates against a dictionary of normalised texts."""

import hashlib
import random
from collections import defaultdict

import pytest

from tidelog.llm.naming import exact_classes, spread_join


def expected(rows):
    groups = defaultdict(list)
    for k, (doc_id, text, *_) in enumerate(rows):
        groups["".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")].append((-len(text or ""), doc_id is None, doc_id or 0, k, doc_id))
    out = []
    for t, members in groups.items():
        keep = min(members)
        out += [(m[4], keep[4], len(members), m is keep, hashlib.sha256(t.encode()).hexdigest()) for m in members]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    texts = [" ".join(f"w{r.randrange(30)}" for _ in range(r.randrange(1, 60))) for _ in range(60)]
    texts += [t.replace(" ", r.choice((" ", "\n", "", "  ", " "))) for t in texts for _ in range(2)]
    long = "".join(chr(r.randrange(97, 123)) for _ in range(5000))
    texts += [long, long + " ", long[:-1], long[:-1] + "é", long + long, long + long[:-1] + "?", "\0", "\0 ", None, "", " \n", None, "é", "é", "\x1c", "a" * 900, "a" * 901]
    out = [(None if i % 19 == 7 else i % 200, t, "clash", 1, 2, 3) for i, t in enumerate(texts)]
    return out + [out[4]] * 300


@pytest.mark.parametrize("size, mask", [(1024, -1), (64, -1), (64, 7)])
def test_equals_dictionary(spark, rows, size, mask):
    # the further columns have names that the operator uses inside
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string, rid int, i int, key int").repartition(5)
    got = exact_classes(docs, size, mask)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_empty_table(spark):
    assert exact_classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_hot_rows_are_spread(spark):
    rows = spark.range(30_000).selectExpr("id AS rid", "IF(id % 3 = 0, 0, id) AS k")
    table = rows.groupBy("k").count().selectExpr("k", "count", "k * 2 AS twice")
    out = spread_join(rows, table, ["k"])
    assert out.count() == 30_000 and out.filter("twice != 2 * k").isEmpty()
