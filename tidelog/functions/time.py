"""Clock and time-range helpers.

Event times are TIMESTAMP_NTZ in UTC.  A time range is always written as plain
comparisons on ``ts`` (never a function of it), so that it reaches the Parquet
scan, plus the same range on the partition column ``dt`` where the table has it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def bound(as_of: Column | str | dt.datetime | None) -> Column:
    """``as_of`` as a foldable TIMESTAMP_NTZ column."""
    if as_of is None:
        return F.expr("localtimestamp()")
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def span(**units: int) -> Column:
    """Day-time interval, e.g. ``span(hours=24)``."""
    total = dt.timedelta(**units)
    return F.lit(total)


def since(df: DataFrame, low: Column, *, strict: bool = False, ts: str = "ts", to: Column | None = None) -> DataFrame:
    """Rows with ``ts`` at or (strict) after ``low`` and not after ``to``, with partition pruning.

    What depends on the clock gives its ``as_of`` as ``to``: a later run then counts, and reads, nothing that came after.
    """
    keep = F.col(ts) > low if strict else F.col(ts) >= low
    if to is not None:
        keep = keep & (F.col(ts) <= to)
    if ts == "ts" and "dt" in df.columns:
        keep = keep & (F.col("dt") >= F.to_date(low))
        if to is not None:
            keep = keep & (F.col("dt") <= F.to_date(to))
    return df.where(keep)


def between(df: DataFrame, low: Column, high: Column, *, ts: str = "ts") -> DataFrame:
    """Half-open range [low, high) with partition pruning."""
    keep = (F.col(ts) >= low) & (F.col(ts) < high)
    if ts == "ts" and "dt" in df.columns:
        keep = keep & (F.col("dt") >= F.to_date(low)) & (F.col("dt") <= F.to_date(high))
    return df.where(keep)


def is_day(df: DataFrame, as_of, *, ts: str = "ts") -> DataFrame:
    """Rows on the calendar day of ``as_of``."""
    midnight = F.to_date(bound(as_of)).cast("timestamp_ntz")
    return between(df, midnight, midnight + span(days=1), ts=ts)


def ts_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of ``unit`` boundaries crossed between two instants.

    10:59 to 11:01 is one hour.  (Spark's own TIMESTAMPDIFF counts whole units,
    which would be zero.)
    """
    if unit == "day":
        return F.datediff(F.to_date(end), F.to_date(start)).cast("long")
    return F.timestamp_diff(unit.upper(), F.date_trunc(unit, start), F.date_trunc(unit, end))
