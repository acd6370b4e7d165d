import datetime as dt

from pyspark.sql import functions as F

from tidelog.functions import payload_of, ts_diff, whole
from tidelog.operators.product import health_score


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_ts_diff_counts_boundaries(spark):
    row = one(
        spark,
        ts_diff("hour", at("2024-01-01 10:59:00"), at("2024-01-01 11:01:00")).alias("h"),
        ts_diff("day", at("2024-01-01 23:59:59"), at("2024-01-02 00:00:00")).alias("d"),
        ts_diff("minute", at("2024-01-01 10:00:59.9"), at("2024-01-01 10:01:00")).alias("m"),
        ts_diff("second", at("2024-01-01 10:00:00.9"), at("2024-01-01 10:00:00.95")).alias("s"),
        ts_diff("hour", at("2024-01-01 11:01:00"), at("2024-01-01 10:59:00")).alias("back"),
        ts_diff("millisecond", at("2024-01-01 00:00:00"), at("2024-01-01 00:00:01.5")).alias("ms"),
    )
    assert tuple(row) == (1, 1, 1, 0, -1, 1500)


def test_whole_rounds_and_survives_text(spark):
    texts = ["12", "1.6", "-2.5", "n/a", "", "1e3", None]
    row = one(spark, *[whole(F.lit(t).cast("string")).alias(f"c{i}") for i, t in enumerate(texts)])
    assert tuple(row) == (12, 2, -3, None, None, 1000, None)


PAYLOADS = [
    '{"a":"x","n":5,"f":true,"o":{"k":[1,2]}}',
    '{"a":null,"n":"7","f":"yes"}',
    '{"n":"n/a"}',
    '{"a":"broken',
    "[1,2]",
    None,
]


def rows(df, p):
    return [tuple(r) for r in p.df.orderBy("i").select(p.text("a"), p.whole("n"), p.flag("f"), p.text("o")).collect()]


def test_payload_from_text_and_variant(spark):
    df = spark.createDataFrame(list(enumerate(PAYLOADS)), "i int, feature_json string")
    want = [("x", 5, True, '{"k":[1,2]}'), (None, 7, True, None)] + [(None,) * 4] * 4
    assert rows(df, payload_of(df, "a", "n", "f", "o")) == want
    variant = df.withColumn("feature_json", F.try_parse_json("feature_json"))
    assert rows(variant, payload_of(variant, "a", "n", "f", "o")) == want


def test_health_score_unknown_and_bounds(spark):
    def score(p95, success, provenance):
        values = [F.lit(v).cast("double") for v in (p95, success, provenance)]
        return health_score(*values).alias("s")

    row = one(spark, score(20, 99, 99).alias("a"), score(None, 80, 0).alias("b"), score(20, None, 99).alias("c"))
    assert tuple(row) == (100.0, 45.0, None)


def test_as_of_default_is_now(spark):
    from tidelog.functions import bound

    now = one(spark, bound(None).alias("t"))["t"]
    assert abs(now - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(minutes=5)
