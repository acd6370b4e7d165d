"""Left interval join on an equality key and a symmetric time window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F


def left_interval_join(
    left: DataFrame, right: DataFrame, *, left_key: str, left_ts: str, right_key: str, right_ts: str,
    margin: dt.timedelta,
) -> DataFrame:
    """All left rows with every right row of equal key whose time lies within
    ``margin`` (both ends included).

    Time is cut into cells as wide as the whole window.  A left row lies in one
    cell; a right row is copied to the one or two cells its window touches, so
    each matching pair meets exactly once and left rows are never duplicated by
    the cells.  The cell is part of the join key: a key that holds a large share
    of the rows spreads over its cells.
    """
    width = int(margin.total_seconds()) * 2

    def cell(ts):
        return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(width))

    reach = F.lit(margin)
    cells = F.array_distinct(F.array(cell(F.col(right_ts) - reach), cell(F.col(right_ts) + reach)))
    probe = left.withColumn("_cell", cell(F.col(left_ts)))
    build = right.where(F.col(right_key).isNotNull()).withColumn("_rcell", F.explode(cells))
    match = (
        (F.col(left_key) == F.col(right_key))
        & (F.col("_cell") == F.col("_rcell"))
        & (F.col(right_ts) >= F.col(left_ts) - reach)
        & (F.col(right_ts) <= F.col(left_ts) + reach)
    )
    return probe.join(build, match, "left").drop("_cell", "_rcell")
