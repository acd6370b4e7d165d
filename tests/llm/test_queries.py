"""Registered queries against SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from tests.check import compare, duck
from tidelog.llm.oracle import ORACLE
from tidelog.llm.queries import QUERIES

from .test_operators import linked, without_repeats


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir).cache()
        seen[name] = before.collect(), docs.collect()
        if name != "tokens":
            assert docs.columns == columns
    before, after = seen["near_duplicates"]
    assert len(after) == linked(before)[1]
    before, after = seen["repeated_strings"]
    assert sum(len((x.text or "").encode()) for x in after) == sum(x[1] - x[2] for x in without_repeats(before))
    assert len(after) == len(before) and all(x.n_chars == len(x.text) for x in after)
    before, after = seen["mixture"]
    words = [sum(len((x.text or "").split()) for x in rows) for rows in (before, after)]
    assert {x.doc_id for x in after} <= {x.doc_id for x in before} and abs(words[1] - words[0]) < 0.2 * words[0]
    assert len(seen["tokens"][1]) == len(after)
    assert corpus_pipeline.run(spark, sf_dir).count() == len(after)
