"""Partial rows: sums by all columns that are to be counted distinct, and how sums of sums give the measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def partial(rows: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """One row for each combination of ``keys`` (groups and what is counted distinct), with ``sums`` of its rows.

    Several exact distinct counts make Spark copy its input once for each; here that is the partial rows.  Sums are
    combined map side.
    """
    return rows.groupBy(*keys).agg(*(value.alias(name) for name, value in sums.items()))


def total(count: str) -> Column:
    """Sum of counts; 0 where there are no rows at all."""
    return F.coalesce(F.sum(count), F.lit(0))


def mean(part: str, count: str) -> Column:
    return F.sum(part) / F.nullif(F.sum(count), F.lit(0))


def deviation(part: str, squares: str, count: str) -> Column:
    """Sample deviation of whole numbers from their exact sums; NULL for fewer than two."""
    n, s = F.sum(count).cast("decimal(18,0)"), F.sum(part).cast("decimal(19,0)")
    spread = (F.sum(squares) - s * s / F.nullif(n, F.lit(0))).cast("double")
    return F.sqrt(F.greatest(spread, F.lit(0.0)) / F.nullif(n - 1, F.lit(0)).cast("double"))
