"""Intermediate tables in the shared work folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import work_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once and read again.

    For a reduced table that a plan needs in several places: what it comes from is read once, and a lost executor
    costs no more than what it was doing.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
