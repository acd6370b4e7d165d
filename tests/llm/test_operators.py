"""Each operator against a brute-force version, with nulls, empty texts, ties, repeated rows and clashing columns."""

import base64
import hashlib
import math
import random
import struct
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelog.llm import bpe, ordinal, sharding
from tidelog.llm.bpe import bpe_round_trip
from tidelog.llm.components import components
from tidelog.llm.jaccard import DEPTH, RECALL, keep_first, n_runs, shingle_sets, similarity_classes
from tidelog.llm.licenses import RESERVED, TEMPLATES, TEXTS, scan_licenses
from tidelog.llm.mixing import by_position, mix_sources
from tidelog.llm.nearest import nearest
from tidelog.llm.ordinal import classify, features, fit
from tidelog.llm.rules import quality_rules
from tidelog.llm.sharding import shard_documents
from tidelog.llm.suffixes import merge_runs, remove_repeats
from tidelog.llm.warc import archive_round_trip, record_chunks

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BPE = public_tokenizers.path("byte_bpe_50k.json")


def low(x):
    return -1 if x is None else x


def words(r, n, many=300):
    return " ".join(f"w{r.randrange(many)}" for _ in range(n))


def frame(spark, texts, parts=3):
    rows = [(None if i % 17 == 5 else i, t, "en", f"s{i % 4}" if i % 9 else None, 1) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (3, "another text of the same id", None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(parts), rows


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    passage, base = words(r, 60), words(r, 150)
    out = [words(r, r.randrange(1, 150)) for _ in range(40)] + [f"{words(r, 20)} {passage} {words(r, 20)}" for _ in range(40)]
    for _ in range(60):
        w = base.split()
        for _ in range(r.randrange(3)):
            w[r.randrange(150)] = f"E{r.randrange(99)}"
        out.append(" ".join(w))
    return out + [None, "", " \n", "a", "a", "a b", "a  b", "a" * 199, "a" * 200, "a" * 201, "a" * 700, "ab" * 400, words(r, 3) * 100, "é" * 150, "é" * 150,
                  words(r, 30_000, 9999)]


def without_repeats(rows):
    raw = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(x[i:i + 200] for x in raw for i in range(len(x) - 199))
    out = []
    for (i, *_), x in zip(rows, raw):
        gone = bytearray(len(x))
        for s in range(len(x) - 199):
            if seen[x[s:s + 200]] > 1:
                gone[s:s + 200] = b"\1" * 200
        spans = sum(1 for s in range(len(x)) if gone[s] and (s == 0 or not gone[s - 1]))
        kept = bytes(b for b, g in zip(x, gone) if not g)
        out.append((low(i), len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [20_000, 3])
def test_suffixes(spark, texts, hot):
    docs, rows = frame(spark, texts)
    got = remove_repeats(docs, ("lang",), hot=hot).collect()
    assert sorted((low(x.doc_id), x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got) == without_repeats(rows)
    assert Counter(x.lang for x in got) == Counter(x[2] for x in rows)


def test_suffixes_of_nothing(spark):
    assert remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_merge_of_runs():
    r = random.Random(2)
    runs = [sorted(bytes(r.choice(b"ab") for _ in range(r.randrange(9))) for _ in range(r.randrange(30))) for _ in range(7)]

    def coded(run):
        before = b""
        for x in run:
            yield x, next((i for i, (a, b) in enumerate(zip(before, x)) if a != b), min(len(before), len(x)))
            before = x

    got = list(merge_runs([coded(x) for x in runs]))
    assert [x for x, _ in got] == sorted(x for run in runs for x in run)
    for (a, _), (b, shared) in zip(got, got[1:]):
        assert a[:shared] == b[:shared] and a[shared:shared + 1] != b[shared:shared + 1] or a == b


def linked(rows):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up, links = list(range(len(rows))), [0] * len(rows)

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 9 * len(a & sets[j]) >= 4 * (len(a) + len(sets[j])):
                links[i] += 1
                links[j] += 1
                up[top(j)] = top(i)
    members = defaultdict(list)
    for i, (d, *_) in enumerate(rows):
        members[top(i)].append(d)
    return sorted((low(d), min((m for m in members[top(i)] if m is not None), default=-1), links[i]) for i, (d, *_) in enumerate(rows)), len(members)


def test_jaccard(spark, texts):
    docs, rows = frame(spark, texts)
    want, classes = linked(rows)
    assert sorted((low(x.doc_id), low(x.class_id), x.n_links) for x in similarity_classes(docs).collect()) == want
    kept = keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == classes


def test_jaccard_of_buckets_that_split(spark, monkeypatch):
    from tidelog.llm import jaccard
    monkeypatch.setattr(jaccard, "SPLIT", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    r = random.Random(8)
    base = words(r, 120)
    rows = []
    for i in range(50):
        w = base.split()
        w[r.randrange(120)] = f"E{i}"
        rows.append((i, " ".join(w), None, None, None))
    got = similarity_classes(spark.createDataFrame(rows, DOCS))
    assert sorted((x.doc_id, x.class_id, x.n_links) for x in got.collect()) == linked(rows)[0]


def test_jaccard_runs_and_nothing(spark):
    assert n_runs(0.9) < n_runs(0.99)
    assert similarity_classes(spark.createDataFrame([], DOCS)).count() == 0


def test_shingles_do_not_depend_on_the_place_in_a_batch():
    r = random.Random(6)
    long = ["".join(r.choices("abcdefgh", k=1_200_000)) for _ in range(2)]
    bare = ["日本語" * r.randrange(20, 200) + str(i) for i in range(3000)]
    for some in (long, ["x y", *long, f"{long[0]} b c d {long[1]} e f"], bare):
        got = [s.tobytes() for s in shingle_sets(pa.array([*some, "between", *some]))]
        assert got[:len(some)] == got[len(some) + 1:] == [next(shingle_sets(pa.array([x]))).tobytes() for x in some]
        assert len(set(got)) == len(some) + 1


def test_long_words_are_hashed_as_short_ones(monkeypatch):
    from tidelog.llm import common
    r = random.Random(7)
    some = pa.array([None, "", " ", *("".join(r.choices(["a", "é", " ", "\n", "b" * 70, "c" * 200], (30, 9, 2, 1, 2, 1), k=r.randrange(90))) for _ in range(200))])
    data, at = common.text_buffer(some)

    def found():
        return [(h, t) for hs, ts, *_ in common.words(data, at) for h, t in zip(hs.tolist(), ts.tolist())]

    want = [(t, w) for t, x in enumerate(some.to_pylist()) for w in (x or "").encode().split()]
    for span in (1 << 20, 128, 50):
        monkeypatch.setattr(common, "_SPAN", span)
        names = defaultdict(set)
        got = found()
        assert [t for _, t in got] == [t for t, _ in want]
        for (h, _), (_, w) in zip(got, want):
            names[w].add(h)
        assert all(len(x) == 1 for x in names.values()) and len(set.union(*names.values())) == len(names)


def test_jaccard_recall_in_the_deepest_bucket():
    meets = 1.0
    for _ in range(DEPTH):
        meets = 1 - math.exp(-meets)
    assert 1 - (1 - meets) ** n_runs() >= RECALL > 1 - (1 - meets) ** (n_runs() - 1)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (60, 61), (61, 60), (7, 3)]
    got = {x.id: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 60: 60, 61: 60}


def test_scoring_holds_few_texts(spark):
    r = random.Random(4)
    batch = pa.RecordBatch.from_pylist([{"c0": i, "c1": " ".join(str(r.randrange(10**6)) for _ in range(800))} for i in range(2000)])
    model = ordinal.Model(np.full(ordinal.WIDTH, -0.01, np.float32), np.array([-9.0, -8.0]))
    run = ordinal._scores(model, 2, 0.8, "c1")
    next(run(iter([batch.slice(0, 10)])))  # tables that a process makes once
    tracemalloc.start()
    parts = list(run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(x.num_rows for x in parts) == 2000 and max(x.num_rows for x in parts) < 500
    assert peak < 80 << 20
    # a text that is asked for goes to the tasks once, and whole
    rows = [(i, "good words " * 9 if i % 2 else "bad stuff " * 9, "en", "s", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    ratings = spark.createDataFrame([(i, 2 if i % 2 else 0) for i in range(200)], "doc_id long, grade int")
    got = classify(docs, ratings, ("doc_id", "text"))
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "_text" not in plan
    assert {(x.doc_id, x.text, x.kept) for x in got.collect()} == {(i, t, i % 2 == 1) for i, t, *_ in rows}
    alone = {x.doc_id: (x.expected_grade, x.tail) for x in classify(docs, ratings).collect()}
    assert alone == {x.doc_id: (x.expected_grade, x.tail) for x in got.collect()}


def test_encoding_holds_the_words_of_one_row():
    run = bpe._encode(public_tokenizers.path("byte_bpe_50k.json"))
    words = pa.array([f"w{i}" for i in range(5000)])
    lists = pa.ListArray.from_arrays(pa.array(range(0, 5000 * 151, 5000), pa.int32()), pa.concat_arrays([words] * 150))
    batch = pa.RecordBatch.from_arrays([pa.array(range(150), pa.int64()), pa.array([i // 50 for i in range(150)], pa.int32()), lists], schema=bpe._WORDS)
    list(run(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    seen = [(x["block"][0].as_py(), x["part"][0].as_py(), len(bpe._unpacked(pa.Codec("zstd").decompress(x["ids"][0].as_py(), x["size"][0].as_py(), asbytes=True))))
            for x in run(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == [(i, i // 50, 5000) for i in range(150)]
    assert peak < 10 << 20


def test_mixing(spark, texts):
    docs, rows = frame(spark, texts)
    got = mix_sources(docs.withColumn("size", F.lit("clash"))).collect()
    size, target, taken = Counter(), {}, Counter()
    for x in got:
        assert x.size == len((x.text or "").split()) and 0 <= x.taken <= 3 * x.size
        assert (x.position is None) == (x.taken == 0)
        size[x.source] += x.size
        target[x.source] = x.target
        taken[x.source] += x.taken
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s)))}
    rest, level, open_ = sum(size.values()), None, set(size)
    while level is None:
        level = rest / sum(weight[s] for s in open_)
        for s in [s for s in open_ if weight[s] * level > 3 * size[s]]:
            open_.remove(s)
            rest -= 3 * size[s]
            level = None
    for s in size:
        assert target[s] == pytest.approx(min(3 * size[s], weight[s] * level)) and abs(taken[s] - target[s]) <= 1
    copies = by_position(mix_sources(docs)).collect()
    assert [x.position for x in copies] == sorted(x.position for x in copies)
    assert mix_sources(spark.createDataFrame([], DOCS)).count() == 0


def test_mixing_places_every_copy(spark):
    # the first source is small and has the most weight, so it is read three times; the others in part
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "en", "a" if i % 9 == 0 else "b" if i % 2 else "c", 1) for i in range(400)], DOCS)
    schedules = ((1.5, 1.0, 0.5), (0.2, 2.0, 0.2, 1.0), (0.5, 1.5))
    got = mix_sources(docs, schedules=schedules).collect()
    for x in got:
        assert len(x.positions or []) == -(-x.taken // x.size) and x.position == (x.positions or [None])[0]
        rates = schedules[x.kind]
        grid = np.linspace(0, 1, 200_001)
        rate = np.interp(grid, np.linspace(0, 1, len(rates)), rates)
        used = np.concatenate(([0], np.cumsum((rate[1:] + rate[:-1]) / 2)))
        for k, at in enumerate(x.positions or []):
            assert at == pytest.approx(np.interp((x.before + k * x.source_size) / x.target, used / used[-1], grid), abs=1e-4)
    assert {len(x.positions or []) for x in got} >= {0, 1, 3}
    copies = by_position(mix_sources(docs, schedules=schedules)).collect()
    assert [x.position for x in copies] == sorted(x.position for x in copies)
    places = {x.doc_id: x.positions for x in got}
    assert all(x.position in places[x.doc_id] for x in copies) and len(copies) > 200


def test_rules(spark, texts):
    docs, rows = frame(spark, [*texts, "x y\n\nx y\n x y", "the # of $ <a|b> & % *", "\x0b\x0c\r\t"])
    for x in quality_rules(docs.withColumn("kept", F.lit(3))).collect():
        text = x.text or ""
        w = text.encode().split()
        grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        again = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [y for y in text.split("\n") if y.encode().split()]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == (
            len(w), sum(len(y.decode()) for y in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again))
        assert x.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and not (x.kept and x.base_failed)


def test_licenses(spark):
    texts = [None, "", "MIT", "released  under the mit LICENSE", "x\nLicensed under CC BY-NC 4.0!\ny", "Released under the\nMIT license", "Released under the MIT License.\nLicensed under CC BY-NC 4.0."]
    got = {x.doc_id: x for x in scan_licenses(spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, dice string")).collect()}
    assert [got[i].license for i in range(7)] == [None, None, None, "MIT", "CC-BY-NC-4.0", "MIT", "MIT"]
    assert [got[i].license_line for i in range(3, 7)] == [1, 2, 0, 1] and got[6].permissive is False and got[6].n_licenses == 2


def test_licenses_of_stretches(spark):
    filler = "some words that say nothing of the kind " * 12
    gpl = "This work is licensed under the GNU General\n# Public License, version 3."
    mit = """Copyright (c) 2020 A. Nyone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
    texts = [
        f"{filler}\n{gpl}\n{filler}", f"{filler} Released under the MIT License. {filler}", f"{filler}\n{mit}\n{filler}", filler,
        f"{filler} Released under the MIT License. {filler} Licensed under CC BY-NC 4.0. {filler}",
        f"{filler}\nReleased under the MIT License.\n{filler}", "All rights reserved.",
        f"{TEMPLATES[-1][2]} Licensed under CC BY-NC 4.0.", "of the mit " * 3000 + "the mit license of the mit",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.license, x.license_line, x.n_licenses, x.permissive) for x in scan_licenses(docs).collect()}
    assert got == {
        0: ("GPL-3.0", 2, 1, False), 1: ("MIT", 1, 1, True), 2: ("MIT", 4, 1, True), 3: (None, None, 0, None), 4: ("MIT", 1, 2, False),
        5: ("MIT", 2, 1, True), 6: ("proprietary", 1, 1, False), 7: ("CC-BY-NC-4.0", 1, 2, False), 8: (None, None, 0, None)}
    assert scan_licenses(docs, TEMPLATES).filter("doc_id = 6").first().license is None
    bsd = f"Copyright (c) 2020, A. Nyone\nAll rights reserved.\n{TEXTS[7][2]}"
    x = scan_licenses(spark.createDataFrame([(1, bsd), (2, f"{filler} All rights reserved. {filler}")], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license, r.n_licenses, r.permissive) for r in x} == {(1, "BSD-3-Clause", 2, True), (2, "proprietary", 1, False)}
    every = (*TEMPLATES, *TEXTS)
    assert RESERVED[1] is None
    docs = spark.createDataFrame([(i, f"{filler} {t[2]} {filler}") for i, t in enumerate(every)], "doc_id int, text string")
    for x in scan_licenses(docs).collect():
        assert (x.license, x.dice, x.n_licenses, x.permissive) == (every[x.doc_id][0], 1.0, 1, every[x.doc_id][1])


def test_bpe(spark, texts):
    r = random.Random(1)
    alphabet = [*"ab c  \n\t\r'!?#é5٣²", "<|endoftext|>", "'s", "'ll", "\x1c", "\x85", "\xa0", " ", "　", "​", "﻿", "日本", "🙂", "́", "\x00", "ǅ", "᠎"]
    docs, rows = frame(spark, [*texts, *("".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(500)), "<|endoftext|>", "<|endoftext|"])
    tokenizer = Tokenizer.from_file(BPE)

    def want(row):
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids
        plain = tokenizer.decode(ids, skip_special_tokens=False)
        return low(row[0]), len(ids), hashlib.sha256(b"".join(struct.pack("<I", i) for i in ids)).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()

    got = bpe_round_trip(docs, BPE, ("doc_id", "lang"), texts=True).collect()
    assert sorted((low(x.doc_id), x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in got) == sorted(map(want, rows))
    assert all(len(x.ids) == x.n_tokens for x in got)


def test_nearest(spark):
    r = np.random.default_rng(3)
    vectors = [r.normal(size=12).round(1).tolist() for _ in range(400)]
    vectors[7] = vectors[8] = vectors[100]
    vectors[9] = [2 * x for x in vectors[100]]
    rows = list(enumerate(vectors)) + [(400, None), (401, [0.0] * 12), (402, [float("nan")] * 12), (403, [None] * 12), (None, vectors[1]), (404, [1.0, 2.0]), (450, [2.0, 1.0]), (5, vectors[5])]
    good = {i: np.array(v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    want = []
    for q in (i for i in good if i % 50 == 0):
        score = [(-sum(good[q] * good[i]) / np.sqrt(sum(good[q] ** 2)) / np.sqrt(sum(good[i] ** 2)), i) for i in good if i != q and len(good[i]) == len(good[q])]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(sorted((round(s, 12), i) for s, i in score)[:5], 1)]
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    exact = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for queries, candidates in ((512, 8192), (3, 37)):
        got = nearest(exact, F.col("vec_id") % 50 == 0, 5, queries, candidates).collect()
        assert sorted((x.query_id, x["rank"], x.vec_id, round(x.score, 9)) for x in got) == sorted((*x[:3], round(x[3], 9)) for x in want)
    assert nearest(frame_.filter("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_nearest_of_ids_with_several_vectors(spark):
    r = np.random.default_rng(9)
    rows = [(i % 60, r.normal(size=6).tolist()) for i in range(150)]
    cosine = lambda a, b: np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)
    want = []
    for q in (0, 50):
        score = sorted((-cosine(a, b), j) for i, a in rows for j, b in rows if i == q != j)
        want += [(q, n, j, round(-s, 9)) for n, (s, j) in enumerate(score[:5], 1)]
    frame_ = spark.createDataFrame([*rows, rows[7]], "vec_id long, embedding array<double>")
    for queries, candidates in ((512, 8192), (1, 37)):
        got = nearest(frame_, F.col("vec_id") % 50 == 0, 5, queries, candidates).collect()
        assert sorted((x.query_id, x["rank"], x.vec_id, round(x.score, 9)) for x in got) == want


def fits(edges, capacity, shards):
    at = 0
    for _ in range(shards):
        at = max(e for e in edges if e <= at + capacity)
    return at == edges[-1]


def nearest_to_mean(edges, capacity, shards):
    """The cuts with all edges at hand: nearest to the mean of what is left, where the rest still fits and no shard is empty."""
    at, out = 0, []
    for n in range(shards - 1, 0, -1):
        ok = [e for e in edges if at < e <= at + capacity and sum(x > e for x in edges) >= n and fits([x - e for x in edges if x >= e], capacity, n)]
        ok = ok or [min((e for e in edges if e > at), default=at)]
        mean = at + -(-(edges[-1] - at) // (n + 1))
        at = min(ok, key=lambda e: (abs(e - mean), e))
        out.append(at)
    return out


@pytest.mark.parametrize("n, shards", [(300, 24), (900, 5), (10, 24), (1, 3)])
def test_sharding(spark, monkeypatch, n, shards):
    monkeypatch.setattr(sharding, "CELLS", 3)
    monkeypatch.setattr(sharding, "SPLIT", 2)
    r = random.Random(n)
    rows = [(i if i % 40 else None, None if i % 29 == 0 else "é" * r.randrange(200) + str(i % (n * 2 // 3 or 1))) for i in range(n)] + [(10 ** 6 + i, "hot") for i in range(n // 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    text = F.coalesce("text", F.lit(""))
    key = {x.t: x.k for x in docs.select(text.alias("t"), F.shiftrightunsigned(F.xxhash64(text), 4).alias("k")).collect()}
    total = Counter()
    for _, t in rows:
        total[key[t or ""]] += len((t or "").encode()) + 8

    edges = [0]
    for k in sorted(total):
        edges.append(edges[-1] + total[k])
    capacity = next(c for c in range(max(total.values()), edges[-1] + 1) if fits(edges, c, shards))
    cuts = nearest_to_mean(edges, capacity, shards)
    got = shard_documents(docs, shards).collect()
    place = dict(zip(sorted(total), edges))
    want = sorted((low(i), len((t or "").encode()) + 8, sum(place[key[t or ""]] >= c for c in cuts)) for i, t in rows)
    assert sorted((low(x.doc_id), x.size, x.shard) for x in got) == want
    sizes = Counter()
    for x in got:
        sizes[x.shard] += x.size
    assert max(sizes.values()) == capacity and len(sizes) == min(shards, len(total))
    slots = defaultdict(list)
    for x in got:
        slots[x.shard].append(x.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("chunk, least", [(1 << 20, 0), (7, 0), (1, 0), (100, 20)])
def test_warc(spark, chunk, least):
    r = random.Random(chunk)
    bodies = [None, "", "a\r\n\r\nb", "\r\n\r\n", "\r\n\r\n\r\n\r\n", "\r\n", "x" * 5000, "é" * 333, "WARC/1.1\r\n\r\n", "\r\n\r\r\n\n" * 50]
    rows = [(i if i % 9 else None, None if i % 7 == 0 else f"http://x/é \r\n{i}", r.choice([*bodies, f"u{i}"])) for i in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    best = defaultdict(lambda: -1)
    for i, _, h in rows:
        best[h or ""] = max(best[h or ""], low(i))
    want = []
    for i, u, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= least and best[h or ""] not in (low(i), -1)
        want.append((low(i), u or "", len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", best[h or ""] if again else -1))
    got = archive_round_trip(pages, least, chunk).collect()
    assert sorted((low(x.page_id), x.url or "", x.payload_bytes, x.payload_digest, x.record_type, low(x.refers_to)) for x in got) == sorted(want)
    chunks = record_chunks(pages, least, chunk).groupBy("record_id").agg(F.max("chunk")).count()
    assert chunks == len({low(i) for i, *_ in rows})
    assert archive_round_trip(pages.filter("false")).count() == 0


def test_ordinal_fit():
    r = np.random.default_rng(5)
    grades = r.integers(0, 3, 900)
    lists = [np.unique(np.concatenate((r.integers(100, 200, 20), [0] * int(g == 0), [1] * int(g == 1)))).astype(np.int64) for g in grades]
    model = fit(grades, lists)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(np.array([model.weights[x].sum() for x in lists]))
    assert (np.diff(tails, axis=1) <= 0).all()
    assert ((tails.sum(1).round() == grades).mean()) > 0.97
    assert fit(np.zeros(5, np.int64), lists[:5]) is None


def test_ordinal_features_do_not_depend_on_the_place_in_a_batch():
    r = random.Random(3)
    text = words(r, 400)
    first, *others = [tuple(feature[number == i]) for number, feature in [features(pa.array([text] * 1200))] for i in range(1200)]
    assert all(x == first for x in others)


def test_ordinal_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select(
        "doc_id", F.expr("CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END").alias("grade"))
    shown = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) > 0
    got = classify(docs, labels.filter(shown)).join(labels.filter(~shown), "doc_id").groupBy("grade").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {x.grade: x.kept for x in got}
    assert kept[2] > 0.97 and kept[1] < 0.25 and kept[0] < 0.05, kept


def test_ordinal_odd_rows(spark, texts):
    docs, rows = frame(spark, texts)
    ratings = spark.createDataFrame([(1, None), (None, 2), (2, 0), (3, 2), (3, 0)], "doc_id long, grade int")
    got = classify(docs.withColumn("tail", F.lit("clash")), ratings, ("doc_id", "lang", "tail")).collect()
    assert len(got) == len(rows) and all(x.kept for x in got)
    assert classify(docs.filter("false"), ratings).count() == 0
