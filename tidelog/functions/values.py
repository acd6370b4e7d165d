"""Small expression helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def whole(text: Column) -> Column:
    """Text to long with scale-0 rounding ('1.6' is 2), NULL for non-numbers.

    Integers, nearly all values, take the primitive path; only the rest pays for
    decimal arithmetic.
    """
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,0)").try_cast("bigint"))


def like_prefix(column: str, prefix: str) -> Column:
    """``LIKE 'prefix_%'`` where ``_`` is any one character.

    Written as starts-with plus a length test, so that the prefix reaches the
    Parquet filter and no regular expression runs per row.
    """
    return F.col(column).startswith(prefix) & (F.length(column) > len(prefix))


def n_distinct(column: Column | str, approx: bool = False) -> Column:
    return F.approx_count_distinct(column) if approx else F.countDistinct(column)


def opt(df: DataFrame, column: str, kind: str = "string") -> Column:
    """The column if the table has it, else a typed NULL."""
    return F.col(column) if column in df.columns else F.lit(None).cast(kind)


def pct(part: Column, total: Column, digits: int) -> Column:
    """100 * part / total, NULL when total is 0."""
    return F.round(part.cast("double") * 100.0 / F.nullif(total, F.lit(0)).cast("double"), digits)


def steady_round(column: Column, digits: int) -> Column:
    """Rounding for sums of doubles.

    Sums differ in the last bits with the order of the tasks; rounding those away
    first keeps a value on the edge from flipping between runs.
    """
    return F.round(F.round(column, digits + 6), digits)


def trunc_ts(unit: str, column: Column | str) -> Column:
    return F.date_trunc(unit, column).cast("timestamp_ntz")


def day_of(column: str = "ts") -> Column:
    return F.to_date(column)


def stable_id(*parts: Column) -> Column:
    """An id made from the row's own values: a repeated or retried job gives a row the same id again."""
    return F.md5(F.to_json(F.struct(*(p.alias(f"p{i}") for i, p in enumerate(parts)))))
