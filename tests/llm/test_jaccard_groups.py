"""Large groups of near copies: whole results, edges in proportion to members, bounded memory."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidelog.llm import jaccard
from tidelog.llm.jaccard import SIMILARITY, similarity_classes

from .test_operators import DOCS, linked, words


def changed(r, base, edits):
    w = list(base)
    for _ in range(edits):
        w[r.randrange(len(w))] = f"E{r.randrange(10_000)}"
    return " ".join(w)


def test_buckets_of_several_groups_equal_all_pairs(spark, monkeypatch):
    # every bucket above four sets gets pivots, one group more than there are rounds for
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "WIDE", 4)
    monkeypatch.setattr(jaccard, "DEPTH", 1)
    r = random.Random(11)
    bases = [words(r, 120).split() for _ in range(4)]
    # neighbouring groups share half of their words, so that they meet in buckets
    bases += [bases[0][:60] + bases[1][60:], bases[1][:30] + bases[0][30:]]
    texts = [changed(r, b, r.randrange(4)) for b in bases for _ in range(12)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    got = similarity_classes(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert sorted((x.doc_id, x.class_id, x.n_links) for x in got) == linked(rows)[0]


def test_members_of_large_buckets_are_joined_with_them_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    plain, seen = jaccard._by_path, []
    monkeypatch.setattr(jaccard, "_by_path", lambda rows, table: seen.append(plain(rows, table)) or seen[-1])
    r = random.Random(3)
    bases = [words(r, 120).split() for _ in range(3)]
    rows = [(i, changed(r, bases[i % 3], r.randrange(4)), "en", "s", 1) for i in range(60)]
    got = similarity_classes(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert sorted((x.doc_id, x.class_id, x.n_links) for x in got) == linked(rows)[0]
    assert len(seen) == 1  # for the tiles; the pivot came with the bucket's count


def test_edges_are_in_proportion_to_members(spark):
    r = random.Random(5)
    base = words(r, 150).split()
    texts = [changed(r, base, r.randrange(3)) for _ in range(3000)]
    sets = spark.createDataFrame([(i, bytearray(jaccard.signature(s))) for i, s in enumerate(
        jaccard.shingle_sets(pa.array(texts)))], "rid long, signature binary").repartition(8)
    large = sets.select(F.lit(7).cast("long").alias("path"), "rid", F.lit(3000).cast("long").alias("count"))
    large = large.unionByName(sets.select(F.lit(8).cast("long").alias("path"), "rid", F.lit(1500).cast("long").alias("count")).filter("rid % 2 = 0"))
    labelled, edges = jaccard._pivoted(large, sets, SIMILARITY)
    assert edges.count() <= 4500 and labelled.count() == 4500
    # whoever agrees with the pivot is not compared again with others that do
    assert labelled.filter("label = 0").count() <= 30
    tiles = jaccard._labelled_tiles(jaccard.cut(labelled, "labelled"), sets)
    assert tiles.mapInArrow(jaccard._agree(SIMILARITY), "a long, b long").count() <= 60
    assert (tiles.groupBy("path", "i", "j").count().agg({"count": "max"}).first()[0] or 0) <= 2 * jaccard.WIDE


def test_members_are_compared_once_for_all_paths_of_a_pivot(spark):
    r = random.Random(9)
    base = words(r, 150).split()
    # more than half of them do not agree with the first, but with each other in part
    texts = [" ".join(base)] + [changed(r, base, 3 + i % 30) for i in range(599)]
    sets = spark.createDataFrame([(i, bytearray(jaccard.signature(s))) for i, s in enumerate(
        jaccard.shingle_sets(pa.array(texts)))], "rid long, signature binary").repartition(4)
    large = sets.select(F.explode(F.sequence(F.lit(1000).cast("long"), F.lit(1029).cast("long"))).alias("path"), "rid", F.lit(600).cast("long").alias("count"))
    # a path without the first, whose pivot is another
    large = large.unionByName(sets.filter("rid > 0").select(F.lit(2000).cast("long").alias("path"), "rid", F.lit(599).cast("long").alias("count")))
    labelled, edges = jaccard._pivoted(large, sets, SIMILARITY)
    tiles = jaccard._labelled_tiles(jaccard.cut(labelled, "labelled"), sets).cache()
    # before, two rows or more for each of 31 paths and each member
    assert tiles.count() <= 2 * 2 * 1200
    found = {(min(x), max(x)) for x in edges.collect()} | {(min(x), max(x)) for x in tiles.mapInArrow(jaccard._agree(SIMILARITY), "a long, b long").collect()}
    tokens = jaccard._tokens(pa.array([bytes(x.signature) for x in sets.orderBy("rid").collect()]))
    agree = (tokens[:, None] == tokens[None, :]).sum(2) >= jaccard._least(SIMILARITY)
    linked_now = np.eye(600, dtype=bool)
    for a, b in found:
        linked_now[a, b] = linked_now[b, a] = True
    assert (jaccard._stars(linked_now) == jaccard._stars(agree)).all()


def test_others_of_paths_that_share_few_are_compared_path_by_path(spark):
    rows = [(p, 0, 200, 0, 1) for p in range(1000, 1004)] + [(p, 1 + 199 * (p - 1000) + i, 200, 0, 0) for p in range(1000, 1004) for i in range(199)]
    members = spark.createDataFrame(rows, "path long, rid long, count long, pivot long, label int")
    got = jaccard._compared(members).groupBy("path").agg(F.count("*").alias("n"), F.max("count").alias("count"), F.min("meets").alias("meets"))
    assert sorted(map(tuple, got.collect())) == [(p, 199, 200, True) for p in range(1000, 1004)]


def test_group_of_near_copies(spark):
    r = random.Random(6)
    base = words(r, 120).split()
    rows = [(i, changed(r, base, i % 2), "en", "s", 1) for i in range(2500)] + [(9000 + i, " ".join(base), "en", "s", 1) for i in range(500)]
    got = similarity_classes(spark.createDataFrame(rows, DOCS).repartition(8)).collect()
    assert len(got) == 3000 and {x.class_id for x in got} == {0}
    assert all(x.n_links == 2999 for x in got if x.doc_id >= 9000)


def test_signature_of_a_long_text_in_pieces():
    shingles = np.arange(3_000_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    tracemalloc.start()
    whole = jaccard.signature(shingles)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    parts = [np.frombuffer(jaccard.signature(p), "<u4") for p in np.array_split(shingles, 7)]
    assert (np.frombuffer(whole, "<u4") == np.min(parts, axis=0)).all()


def test_shingles_of_few_texts_are_in_memory_at_once():
    r = random.Random(9)
    texts = pa.array([words(r, 700) for _ in range(2000)])
    ids = pa.array(range(2000), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, ids, texts], ["doc_id", "k1", "k2", "text"])
    list(jaccard._sets(iter([batch.slice(0, 10)])))
    tracemalloc.start()
    parts = list(jaccard._sets(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(parts) > 4 and sum(x.num_rows for x in parts) == 2000
    # eight bytes a word and array; all words at once are 11 MB an array
    assert peak < 60 << 20
    whole = list(jaccard.shingle_sets(texts))
    assert [x for p in parts for x in p.column("n").to_pylist()] == [len(s) for s in whole]
    assert [x for p in parts for x in p.column("signature").to_pylist()] == [jaccard.signature(s) for s in whole]
