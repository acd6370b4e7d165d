"""The skew-proof plans against brute force on small random data."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import windows
from tidelog.plans.intervals import left_interval_join
from tidelog.plans.prefix import running_number

T0 = dt.datetime(2024, 1, 1)


def stream(spark, rows):
    return spark.createDataFrame(rows, "activity_id string, ts timestamp_ntz, activity string, customer string, feature_json string")


def random_rows(seed, n=300, minutes=600, customers=5):
    """Few instants, so many ties; one customer has a third of the rows; some NULL."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        who = "hot" if rng.random() < 0.34 else rng.choice([f"c{k}" for k in range(customers)] + [None])
        project = rng.choice(["/p/me", "/p/other"])
        rows.append((f"a{i}", T0 + dt.timedelta(minutes=rng.randrange(minutes)), rng.choice(["claude_session_start", "x"]),
                     who, f'{{"project_path":"{project}"}}'))
    return rows


@pytest.mark.parametrize("unit", ["hour", "day", "minute"])
def test_occurrences(spark, unit):
    rows = random_rows(1)
    got = {r.activity_id: (r.activity_occurrence, r.activity_repeated_at)
           for r in windows.activity_occurrences(stream(spark, rows), unit=unit).collect()}
    assert len(got) == len(rows)
    for i, ts, activity, who, _ in rows:
        same = [r[1] for r in rows if who is not None and r[3] == who and r[2] == activity]
        later = [t for t in same if t > ts]
        assert got[i] == (sum(t <= ts for t in same), min(later) if later else None)


def test_occurrences_fill_only_missing(spark):
    df = stream(spark, random_rows(2, n=40)).withColumn(
        "activity_occurrence", F.when(F.col("activity_id") == "a1", F.lit(99).cast("bigint")))
    rows = {r.activity_id: r for r in windows.activity_occurrences(df, "x").collect()}
    assert rows["a1"].activity_occurrence == 99
    assert all(r.activity_occurrence is None for r in rows.values() if r.activity != "x" and r.activity_id != "a1")


@pytest.mark.parametrize("seed,minutes,levels", [
    (1, 600, ("hour",)), (2, 40, ("minute", "hour")), (3, 3000, ("minute", "hour", "day")), (4, 90, ("minute", "day")), (5, 9000, ("hour", "day"))])
def test_self_study(spark, seed, minutes, levels):
    rows = random_rows(seed, n=200, minutes=minutes)
    starts = [(r[3], r[1], "me" in r[4]) for r in rows if r[2] == "claude_session_start" and r[3] is not None]
    want = {}
    for who, ts, study in starts:
        earlier = [(c, t) for c, t, _ in starts if c != who and t < ts]
        if study and earlier:
            want[(who, ts)] = (len({c for c, _ in earlier}), int((ts - max(t for _, t in earlier)).total_seconds() // 60))
    got = {(r.analyzing_session, r.analysis_time): (r.sessions_studied, r.minutes_after_latest)
           for r in windows.self_study_sessions(stream(spark, rows), "%me%", levels).collect()}
    assert got == want


def test_self_study_reads_the_stream_once(spark, tmp_path):
    path = str(tmp_path / "stream")
    stream(spark, random_rows(6)).write.parquet(path)
    table = spark.read.parquet(path)
    out = windows.self_study_sessions(table, "%me%")
    plan = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    # the stream was read for the table of starts; windows are those of minutes, hours in a day, and days
    assert path not in plan and "session-starts" in plan
    assert "Window" in plan and all(f"trunc({level}" in plan for level in ("minute", "hour", "day"))


def test_running_number(spark):
    rows = random_rows(5)
    df = stream(spark, [r for r in rows if r[3]])
    got = running_number(df, ["customer"], ["ts", "activity_id"], F.date_trunc("hour", "ts"), "no").collect()
    for who in {r.customer for r in got}:
        mine = sorted((r for r in got if r.customer == who), key=lambda r: (r.ts, r.activity_id))
        assert [r.no for r in mine] == list(range(1, len(mine) + 1))


def test_interval_join_keeps_every_pair_once(spark):
    rng = random.Random(7)
    margin = dt.timedelta(minutes=5)

    def side(n):
        return [(i, rng.choice(["hot", "hot", "a", "b", None]), T0 + dt.timedelta(seconds=rng.choice([0, 1, 300, 600, 299, 601, 900]) + 300 * rng.randrange(6)))
                for i in range(n)]

    left, right = side(60), side(60)
    joined = left_interval_join(
        spark.createDataFrame(left, "l int, lk string, lt timestamp_ntz"),
        spark.createDataFrame(right, "r int, rk string, rt timestamp_ntz"),
        left_key="lk", left_ts="lt", right_key="rk", right_ts="rt", margin=margin)
    want = []
    for i, key, ts in left:
        hits = [(i, j) for j, other, at in right if key is not None and key == other and abs(at - ts) <= margin]
        want += hits or [(i, None)]
    assert sorted(((r.l, r.r) for r in joined.collect()), key=repr) == sorted(want, key=repr)
