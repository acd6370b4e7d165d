"""From raw documents to token ids: the stages of a training corpus, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.bpe import bpe_round_trip
from tidelog.llm.common import cut
from tidelog.llm.jaccard import keep_first
from tidelog.llm.mixing import by_position, mix_sources
from tidelog.llm.ordinal import classify, grade
from tidelog.llm.suffixes import remove_repeats


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def apart(stage: Stage) -> Stage:
    """Further columns of the documents go through the stage under names of no meaning, so that none can clash with its own."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: c if c in COLUMNS else f"further_{i}" for i, c in enumerate(docs.columns)}
        out = stage(spark, docs.select(*(docs[f"`{c}`"].alias(n) for c, n in names.items())), sf_dir)
        return out.select(*(out[n].alias(c) for c, n in names.items()))

    return run


@apart
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for well written and not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ratings = labels.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("grade"))
    return classify(docs, ratings, tuple(docs.columns)).filter("kept").select(docs.columns)


@apart
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return keep_first(docs)


@apart
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that occur elsewhere; n_chars is counted anew."""
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    rows = remove_repeats(docs, carry, texts=True).withColumnRenamed("kept", "text")
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


@apart
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents in the order of training: by the number of their file, then by their row in it."""
    return by_position(mix_sources(docs)).select(docs.columns)


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, part, row) of documents read from files that were written in an order; part is null where they were not.

    The files of a sorted table are numbered in its order, and a file keeps the order of its rows.
    """
    try:
        name, row = docs.select("_metadata.file_name", "_metadata.row_index").schema.names
    except AnalysisException:
        return docs.select("doc_id", "text", F.lit(None).cast("long").alias("part"), F.monotonically_increasing_id().alias("row"))
    number = F.regexp_extract(f"_metadata.{name}", r"part-(\d+)", 1).try_cast("long")
    return docs.select("doc_id", "text", number.alias("part"), F.col(f"_metadata.{row}").alias("row"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, digests of them and of the round trip, and its place (part, row) in the order of training."""
    carry = ("doc_id", "part", "row")
    return bpe_round_trip(in_order(docs), public_tokenizers.path("byte_bpe_50k.json"), carry, texts=True).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings), ("mixture", mixture), ("tokens", tokens),
]
#: The classifier, the hashes that prune and the tokenizer cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
