"""The operators on their whole tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_round_trip
from .jaccard import similarity_classes
from .licenses import scan_licenses
from .merkle import manifest
from .mixing import mix_sources
from .naming import exact_classes
from .nearest import nearest
from .ordinal import classify, grade
from .periodic import periodic_runs
from .rules import quality_rules
from .sharding import shard_documents
from .suffixes import remove_repeats
from .warc import archive_round_trip


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels")
    ratings = labels.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("grade"))
    return classify(_table(spark, sf_dir, "documents"), ratings)


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license", F.round("dice", 9).alias("dice"), "license_line", "n_licenses", "permissive")


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 6).alias("position"))


def rule_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(_table(spark, sf_dir, "pages")).drop("url")


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(_table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 0).drop("proof")


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_classes(_table(spark, sf_dir, "documents"))


def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ordinal_quality": ordinal_quality,
    "op2_license_scan": license_scan,
    "op3_suffix_dedup": suffix_dedup,
    "op4_source_mix": source_mix,
    "op5_rule_verdicts": rule_verdicts,
    "op6_bpe": bpe,
    "op7_neighbours": neighbours,
    "op8_shards": shards,
    "op9_jaccard_join": jaccard_join,
    "op10_warc": warc,
    "op11_merkle_manifest": merkle_manifest,
    "op12_exact_dedup": exact_dedup,
    "op13_periodic_runs": word_runs,
}
