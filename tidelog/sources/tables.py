"""Stream tables on Parquet, partitioned by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.membership import SCHEMA, candidates, filter_rows
from ..plans.upsert import keep_first, new_rows


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream table; ``dt`` is its partition column where it was written by us."""
    return spark.read.parquet(path)


def write_stream(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append rows, one folder per day, clustered by customer and time inside it.

    Rows are rebalanced by day: at run time a busy day is split over several tasks
    and small days share one.  Each file is sorted so that its statistics prune.
    """
    rows = df.withColumn("dt", F.to_date("ts"))
    (
        rows.hint("rebalance", "dt")
        .sortWithinPartitions("dt", "customer", "ts")
        .write.mode(mode).partitionBy("dt").parquet(path)
    )


def table_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def days_of(df: DataFrame) -> list:
    """The days of the rows: as few as the calendar has."""
    return [row[0] for row in df.select(F.to_date("ts")).distinct().collect()]


def on_days(table: DataFrame, days: list) -> DataFrame:
    """The partitions of these days; None is the folder of rows without a time."""
    known = F.col("dt").isin([d for d in days if d is not None])
    return table.where(known | F.col("dt").isNull() if None in days else known)


def id_filters(spark: SparkSession, path: str) -> DataFrame:
    """The stored filters of a table's ids; they lie beside the table."""
    return spark.read.schema(SCHEMA).parquet(f"{path}_ids")


def build_id_filters(table: DataFrame, path: str, key: str = "activity_id") -> None:
    """Filters of all ids of a table, in place of those that were there: one for each day."""
    filter_rows(table, key).write.mode("overwrite").parquet(f"{path}_ids")


def days_with(ids: DataFrame, path: str, key: str = "activity_id") -> list:
    """The days of the table that may hold one of these ids, by its filters: as few as the calendar has."""
    return [row[0] for row in candidates(ids, id_filters(ids.sparkSession, path), key).select("dt").distinct().collect()]


def append_new(df: DataFrame, path: str, key: str = "activity_id", same_day: bool = False) -> None:
    """Append one row per key for the keys the table does not have yet.

    A copy of an event may lie on any day.  Beside the table is a Bloom filter of the ids of each day and write; only days whose
    filter has an id of the batch are read.  A table without filters gets them first; from then on rows must come through this
    function, or ``build_id_filters`` must follow.  A filter is written before its rows, so that a job that fails between leaves
    a filter that names too much, not too little.

    ``same_day=True`` looks for a key on the days of the batch instead and keeps no filters; it is right where copies of an
    event carry its time.
    """
    spark = df.sparkSession
    there = table_exists(spark, path)
    if same_day:
        table = on_days(read_stream(spark, path), days_of(df)) if there else None
    else:
        if there and not table_exists(spark, f"{path}_ids"):
            build_id_filters(read_stream(spark, path), path, key)
        days = days_with(df, path, key) if table_exists(spark, f"{path}_ids") else []
        table = on_days(read_stream(spark, path), days) if there and days else None
    rows = new_rows(table, df, key) if table is not None else keep_first(df, key, ["ts"])
    if same_day:
        write_stream(rows, path)
        return
    rows = rows.persist()  # read for the filter and for the table
    try:
        filter_rows(rows, key).write.mode("append").parquet(f"{path}_ids")
        write_stream(rows, path)
    finally:
        rows.unpersist()


def write_result(df: DataFrame, path: str, kind: str) -> None:
    """Small results as JSON lines, CSV with header, or Parquet."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.json(path)
    elif kind == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown result format {kind!r}")
