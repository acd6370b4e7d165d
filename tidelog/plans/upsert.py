"""New table contents for keyed inserts, and versioned table folders.

Plain Parquet has no MERGE.  An operator returns the rows to append or the new
contents; contents go to a new version folder, so nothing is overwritten while
it is read and a re-run of the same version replaces only its own output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by ``order``.

    ``row_number() = 1`` is limited per task before the shuffle, so copies of a
    hot key do not travel.
    """
    keys = [key] if isinstance(key, str) else list(key)
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")


def new_rows(target: DataFrame, source: DataFrame, key: str, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target``, one per key.

    Which keys exist already is found by a semi join from the target's key
    column to the source's keys.  The small side is on the right, so a source
    that is small (planned or measured at run time) is broadcast and the large
    target is never shuffled.
    """
    fresh = keep_first(source, key, order or ["ts"])
    wanted = source.select(F.col(key).alias("_k")).distinct()  # copies end map side
    known = target.select(F.col(key).alias("_k")).join(wanted, "_k", "left_semi").distinct()
    return fresh.join(known, F.col(key) == F.col("_k"), "left_anti")


def insert_if_absent(
    target: DataFrame, source: DataFrame, key: str = "activity_id", order: Sequence[str | Column] | None = None
) -> DataFrame:
    """``target`` plus the rows of ``source`` with a new key; existing rows stay as they are."""
    return target.unionByName(new_rows(target, source, key, order), allowMissingColumns=True)


def write_version(df: DataFrame, base: str, version: int, kind: str = "version", buckets: str | None = None) -> str:
    """Write ``df`` as one version of the table at ``base``; ``kind`` "base" is for what all versions up to it amount to.

    ``buckets`` names a column whose values become folders.
    """
    path = f"{base}/{kind}={version:012d}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(buckets) if buckets else writer).parquet(path)
    return path


def complete_versions(spark: SparkSession, base: str, kind: str = "version") -> list[str]:
    """Folders of the completely written versions, oldest first."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{kind}=*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(status.getPath().getParent().toString() for status in found or [])


def _number(path: str) -> int:
    return int(path.rsplit("=", 1)[1])


def latest_version(spark: SparkSession, base: str, below: int | None = None) -> str | None:
    """Folder of the newest completely written version (before ``below``), if any."""
    names = [n for n in complete_versions(spark, base) if below is None or _number(n) < below]
    return names[-1] if names else None


def merged_versions(spark: SparkSession, base: str) -> DataFrame | None:
    """The rows of the newest base and of the versions after it, with their ``version``; None where there is nothing."""
    bases = complete_versions(spark, base, "base")
    since = _number(bases[-1]) if bases else -1
    paths = bases[-1:] + [n for n in complete_versions(spark, base) if _number(n) > since]
    parts = [spark.read.parquet(n).withColumn("version", F.lit(_number(n))) for n in paths]
    rows = parts[0] if parts else None
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def retire_versions(spark: SparkSession, base: str) -> list[str]:
    """Remove the versions that the newest base stands for, and older bases; nobody may be reading them any more."""
    bases = complete_versions(spark, base, "base")
    if not bases:
        return []
    gone = bases[:-1] + [n for n in complete_versions(spark, base) if _number(n) <= _number(bases[-1])]
    for name in gone:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone
