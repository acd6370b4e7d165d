"""The pipeline's stages against the work of one row at a time, and with columns that clash."""

import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidelog.llm.common import cut
from tidelog.llm.mixing import by_position, mix_sources
from tidelog.llm.ordinal import SELECT, TAIL, features, grade, train

import public_tokenizers

NAMES = ("kept", "position", "kind", "tail", "text2", "expected_grade", "removed", "spans", "size", "further_0")


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """(before, after) of each stage, over documents with further columns named like those of the stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in NAMES))
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = cut(stage(spark, docs, sf_dir), name)
        out[name] = docs, after
        docs = after
    return out


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES][:-1])
def test_further_columns_stay(stages, name):
    before, after = stages[name]
    assert after.columns == before.columns
    rows = after.collect()
    assert rows and all(x[n] == f"{n}{x.doc_id}" for x in rows for n in NAMES)


def test_quality_is_that_of_each_text(spark, stages, sf_dir):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(before, labels.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("grade")))

    def good(text):
        _, feature = features(pa.array([text], pa.string()))
        return model.tails(model.weights[feature].astype(float).sum(keepdims=True))[0, SELECT - 1] >= TAIL

    assert sorted(x.doc_id for x in after.collect()) == sorted(x.doc_id for x in before.collect() if good(x.text))


def test_order_of_training_and_token_ids(stages):
    docs, mixed = stages["mixture"]
    _, encoded = stages["tokens"]
    rows = sorted(encoded.collect(), key=lambda x: (x.part, x.row))
    assert [x.doc_id for x in rows] == [x.doc_id for x in by_position(mix_sources(docs)).collect()]
    assert len({(x.part, x.row) for x in rows}) == len(rows)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {x.doc_id: x.text for x in mixed.collect()}
    for x in rows[::7]:
        ids = tokenizer.encode(texts[x.doc_id], add_special_tokens=False).ids
        assert list(x.ids) == ids and x.n_tokens == len(ids)
        assert x.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()


def test_documents_without_files(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = corpus_pipeline.tokens(spark, docs, "").collect()
    assert {x.doc_id: x.n_tokens for x in got} == {1: 2, 2: 0} and all(x.part is None for x in got)
