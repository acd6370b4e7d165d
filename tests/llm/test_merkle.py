"""The manifest against a recursive computation in one place."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidelog.llm import merkle
from tidelog.llm.merkle import fold, manifest

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int, node int"


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row, more=0):
    doc_id, source, lang, n_chars, text = row[:5]
    values = (doc_id, source, lang, None if n_chars is None else n_chars + more, text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """(root, siblings of each node by level, with the side)."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, place):
            if (i ^ 1) < len(nodes):
                path.append(("<" if i % 2 else ">") + nodes[i ^ 1])
            else:
                path.append("")
        nodes = [h("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        place = [i // 2 for i in place]
    return nodes[0], paths


def expected(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    members = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    parts = {x: tree([leaf(r) for r in m]) for x, m in members.items()}
    root, above = tree([parts[x][0] for x in langs])
    out = []
    for x, more in zip(langs, above):
        for r, path in zip(members[x], parts[x][1]):
            path = path + more
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = fold(leaf(r, changed), path)
            out.append((r[0], leaf(r), parts[x][0], root, tuple(path), h("".join(e[1:] for e in path)), folded, folded == root))
    return sorted(out, key=repr)


def rows(n, langs):
    r = random.Random(n)
    out = [(None if i % 29 == 11 else i * 3 - 20, r.choice(("s", None, "é")), r.choice(langs), r.choice((None, i)), r.choice((None, "", f"text {i} é")), "a", 1, 2)
           for i in range(n)]
    return out + out[:1] * (n // 4)


@pytest.mark.parametrize("n, langs, size", [
    (1, ["en"], 4096), (300, ["en", "de", None, "", "é", "z"], 16), (90, [f"l{i}" for i in range(40)], 8), (90, ["en", "de"], 4096)])
def test_equals_one_tree(spark, monkeypatch, n, langs, size):
    monkeypatch.setattr(merkle, "SIZE", size)
    made = rows(n, langs)
    docs = spark.createDataFrame(made, COLUMNS).repartition(3)
    got = manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    assert sorted(((*x[:4], tuple(x[4]), *x[5:]) for x in got.collect()), key=repr) == expected(made)


def test_untouched_rows_verify(spark):
    docs = spark.createDataFrame(rows(200, ["en", "de"]), COLUMNS)
    assert manifest(docs).filter("NOT verified").isEmpty()


def test_empty_table(spark):
    assert manifest(spark.createDataFrame([], COLUMNS)).collect() == []
