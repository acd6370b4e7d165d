"""Dashboard tiles, trends, leaderboard and health check."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import bound, day_of, n_distinct, since, span, steady_round, trunc_ts

PERIODS = ("Today", "This Week", "This Month")


def _cost():
    return F.coalesce(steady_round(F.sum("revenue_impact") * 1000, 2), F.lit(0.0))


def _midnight(as_of):
    return F.to_date(bound(as_of)).cast("timestamp_ntz")


def period_metrics(stream: DataFrame, as_of=None, approx: bool = False) -> DataFrame:
    """Today, this week, this month: always three rows, one scan.

    Rows are first reduced, map side, to one per session and user with a count for
    each period; only these few are then copied to the periods they belong to.
    """
    start = _midnight(as_of)
    month = F.add_months(F.to_date(bound(as_of)), -1).cast("timestamp_ntz")
    ts = F.col("ts")
    inside = dict(zip(PERIODS, (
        (ts >= start) & (ts < start + span(days=1)), (ts >= start - span(days=7)) & (ts <= bound(as_of)), (ts >= month) & (ts <= bound(as_of)),
    )))
    pairs = (
        since(stream, F.least(start - span(days=7), month), to=start + span(days=1))
        .groupBy("customer", "anonymous_customer_id")
        .agg(*[
            F.struct(F.lit(name).alias("period"), F.count_if(rows).alias("n"),
                     F.sum(F.when(rows, F.col("revenue_impact"))).alias("cost")).alias(name)
            for name, rows in inside.items()
        ])
    )
    counted = (
        pairs.select("customer", "anonymous_customer_id", F.explode(F.array(*[F.col(f"`{n}`") for n in PERIODS])).alias("p"))
        .where("p.n > 0")
        .groupBy("p.period")
        .agg(
            n_distinct("customer", approx).alias("sessions"),
            n_distinct("anonymous_customer_id", approx).alias("users"),
            F.sum("p.n").alias("activities"),
            F.coalesce(steady_round(F.sum("p.cost") * 1000, 2), F.lit(0.0)).alias("cost_dollars"),
        )
    )
    periods = stream.sparkSession.createDataFrame([(p, i) for i, p in enumerate(PERIODS)], "period string, place int")
    zero = {"sessions": 0, "users": 0, "activities": 0, "cost_dollars": 0.0}
    return periods.join(counted, "period", "left").fillna(zero).orderBy("place").drop("place")


def daily_trend(stream: DataFrame, as_of=None, approx: bool = False) -> DataFrame:
    return (
        since(stream, _midnight(as_of) - span(days=30), to=bound(as_of))
        .groupBy(day_of().alias("day"))
        .agg(
            n_distinct("customer", approx).alias("sessions"),
            n_distinct("anonymous_customer_id", approx).alias("users"),
            F.count("*").alias("activities"),
        )
    )


def top_users(stream: DataFrame, as_of=None, n: int = 10, approx: bool = False) -> DataFrame:
    return (
        since(stream, _midnight(as_of) - span(days=7), to=bound(as_of))
        .groupBy(F.col("anonymous_customer_id").alias("user_name"))
        .agg(
            n_distinct("customer", approx).alias("sessions_this_week"),
            F.count("*").alias("activities_this_week"),
            _cost().alias("cost_this_week"),
        )
        .orderBy(F.desc("sessions_this_week"), F.asc("user_name"))
        .limit(n)
    )


def health_check(stream: DataFrame, as_of=None, approx: bool = False) -> DataFrame:
    """Sessions since the full hour against the same hour of the last 7 days."""
    now = bound(as_of)
    hour = F.date_trunc("hour", now).cast("timestamp_ntz")
    current = since(stream, hour, to=now).agg(n_distinct("customer", approx).alias("current_sessions")).select(
        "*", F.hour(now).alias("hour_of_day")
    )
    history = since(stream, _midnight(as_of) - span(days=7), to=bound(as_of)).where(
        (F.col("ts") < hour) & (F.hour("ts") == F.hour(now))
    )
    baseline = (
        history.groupBy(trunc_ts("hour", "ts").alias("hour"))
        .agg(n_distinct("customer", approx).alias("n"))
        .groupBy(F.hour("hour").alias("hour_of_day"))
        .agg(F.avg("n").alias("mean"), F.stddev("n").alias("spread"))
    )
    sessions, mean = F.col("current_sessions"), F.col("mean")
    margin = 2 * F.coalesce("spread", F.lit(0.0))
    return current.join(baseline, "hour_of_day", "left").select(
        F.when(sessions < mean - margin, "low").when(sessions > mean + margin, "high").otherwise("normal")
        .alias("status"),
        "current_sessions",
        F.round("mean", 1).alias("typical_sessions"),
        F.round((sessions - mean) / F.nullif(mean, F.lit(0.0)) * 100, 1).alias("percent_difference"),
    )
