import datetime as dt
import json
import random

import numpy as np
from pyspark.sql import functions as F

from tidelog.operators.state import context_blobs
from tidelog.sources.fixtures import load
from tidelog.sources.ndjson import stream_ndjson
from tidelog.plans.membership import candidates, filter_rows
from tidelog.plans.upsert import retire_versions, write_version
from tidelog.sources.tables import append_new, build_id_filters, days_of, days_with, on_days, read_stream, write_stream
from tidelog.streaming import abandoned, context, ingest, metrics, sketches

T0 = dt.datetime(2024, 1, 1)


def put(folder, name, ids, day=1, activity="x"):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"activity_id": i, "ts": f"2024-01-{day:02d}T00:00:00Z", "activity": activity, "customer": "c"}) for i in ids]
    (folder / name).write_text("\n".join(lines) + "\nbroken\n")


def ids(spark, path):
    return sorted(r.activity_id for r in read_stream(spark, path).collect())


def test_ingest_resumes_and_never_loses_late_rows(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    put(source, "1.ndjson", ["a", "b", "a"], day=20)
    ingest.ingest_stream(stream_ndjson(spark, str(source)), out, mark).awaitTermination()
    assert ids(spark, out) == ["a", "b"]
    put(source, "2.ndjson", ["b", "late"], day=1)
    ingest.ingest_stream(stream_ndjson(spark, str(source)), out, mark).awaitTermination()
    assert ids(spark, out) == ["a", "b", "late"]


def test_lost_checkpoint_adds_nothing(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(source, "1.ndjson", ["a", "b"])
    for run in ("m1", "m2"):
        ingest.ingest_stream(stream_ndjson(spark, str(source)), out, str(tmp_path / run)).awaitTermination()
    assert ids(spark, out) == ["a", "b"]


def test_dual_write(spark, tmp_path):
    source, old, new = tmp_path / "in", str(tmp_path / "old"), str(tmp_path / "new")
    put(source, "1.ndjson", ["a", "b", "b"])
    ingest.ingest_dual(stream_ndjson(spark, str(source)), old, new, str(tmp_path / "m")).awaitTermination()
    assert ids(spark, new) == ["a", "b"] and ids(spark, old + "/batch=*") == ["a", "b", "b"]


def test_context_stream_equals_batch(spark, sf_dir, tmp_path):
    stream, insights = load(spark, sf_dir, "stream_v2"), load(spark, sf_dir, "insight_atoms")
    table, cache, as_of = str(tmp_path / "t"), str(tmp_path / "cache"), "2024-01-30 12:00:00"
    stream.write.parquet(table)
    rows = spark.readStream.schema(stream.schema).parquet(table)
    context.context_stream(rows, cache, str(tmp_path / "m"), lambda: insights, lambda: stream, as_of).awaitTermination()
    want = {(r.customer, r.context_blob) for r in context_blobs(stream, insights, stream, as_of).collect()}
    got = {(r.customer, r.context_blob) for r in context.read_cache(spark, cache).collect()}
    assert {c for c, _ in got} == {c for c, _ in want}
    assert len(got & want) >= len(want) - 1  # doubles may differ in the last digit


def test_repeated_context_batch_gives_the_same_version(spark, sf_dir, tmp_path):
    stream, insights = load(spark, sf_dir, "stream_v2"), load(spark, sf_dir, "insight_atoms")
    run = context.refresh_batch(str(tmp_path / "cache"), lambda: insights, lambda: stream, "2024-01-30 12:00:00")
    for _ in range(2):
        run(stream, 0)
    run(stream, 1)
    counts = [r.access_count for r in context.read_cache(spark, str(tmp_path / "cache")).collect()]
    assert set(counts) == {1}
    one = context.read_cache(spark, str(tmp_path / "cache")).first()
    context.compact_cache(spark, str(tmp_path / "cache"), retire=True)
    assert [p.name for p in (tmp_path / "cache").iterdir()] == ["base=000000000002"]
    run(stream.where(F.col("customer") == one.customer), 2)
    counts = {r.customer: r.access_count for r in context.read_cache(spark, str(tmp_path / "cache")).collect()}
    # the batch of one customer's rows refreshes who has entries at all, since insights, queries and tools are those of the tables
    assert set(counts.values()) <= {1, 2} and counts[one.customer] == 2


def test_hourly_metrics_over_several_batches(spark, tmp_path):
    schema = "ts timestamp_ntz, customer string, activity string, revenue_impact double, feature_json string"
    table = str(tmp_path / "t")
    for part in range(3):
        spark.createDataFrame([(T0 + dt.timedelta(minutes=m), "c", "x", 1.0, '{"latency_ms":10}') for m in (part, 70 + part)], schema
                              ).write.mode("append").parquet(table)
        rows = spark.readStream.schema(schema).parquet(table)
        metrics.hourly_metrics_stream(rows, str(tmp_path / "out"), str(tmp_path / "m")).awaitTermination()
    got = {r.hour: r.total_activities for r in metrics.read_hourly_metrics(spark, str(tmp_path / "out")).collect()}
    assert got == {T0: 3, T0 + dt.timedelta(hours=1): 3}
    metrics.compact_hourly_metrics(spark, str(tmp_path / "out"), str(tmp_path / "compact"))
    assert read_stream(spark, str(tmp_path / "compact")).count() == 2


def test_abandoned_sessions_stream(spark, tmp_path):
    schema = "ts timestamp_ntz, customer string, activity string"
    hours = dt.timedelta(hours=1)
    rows = [(T0, "gone", "claude_session_start"), (T0, "done", "claude_session_start"), (T0 + hours, "done", "claude_session_end"),
            (T0 + 30 * hours, "other", "x")]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "t"))
    stream = metrics.abandoned_sessions(spark.readStream.schema(schema).parquet(str(tmp_path / "t")), "2 hours", "1 hour")
    query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "o"))
             .option("checkpointLocation", str(tmp_path / "m")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert [r.customer for r in spark.read.parquet(str(tmp_path / "o")).collect()] == ["gone"]


def test_late_rows_count_in_recomputed_hours(spark, tmp_path):
    schema = "ts timestamp_ntz, customer string, activity string, revenue_impact double, feature_json string"
    table, out, mark = str(tmp_path / "t"), str(tmp_path / "out"), str(tmp_path / "m")
    for day in (20, 21, 18, 20):
        spark.createDataFrame([(T0 + dt.timedelta(days=day), c, "x", 1.0, '{"latency_ms":10}') for c in ("c", None)], schema).createOrReplaceTempView("rows")
        write_stream(spark.table("rows"), table)
        rows = spark.readStream.schema(read_stream(spark, table).schema).parquet(table)
        metrics.hourly_metrics_stream(rows, out, mark, lambda: read_stream(spark, table)).awaitTermination()
    want = {(T0 + dt.timedelta(days=d), c): n for d, n in ((18, 1), (20, 2), (21, 1)) for c in ("c", None)}

    def counts(df):
        return {(r.hour, r.customer): r.total_activities for r in df.collect()}

    assert counts(metrics.read_hourly_metrics(spark, out)) == want
    (tmp_path / "out" / "version=000000000099").mkdir()
    (tmp_path / "out" / "version=000000000099" / "part.parquet").write_text("cut off")
    metrics.compact_hourly_metrics(spark, out, str(tmp_path / "c1"))
    assert counts(metrics.read_hourly_metrics(spark, out, str(tmp_path / "c1"))) == want
    metrics.compact_hourly_metrics(spark, out, str(tmp_path / "c2"), str(tmp_path / "c1"))
    assert counts(metrics.read_hourly_metrics(spark, str(tmp_path / "none"), str(tmp_path / "c2"))) == want


def test_same_day_insert_reads_only_the_days_of_the_batch(spark, tmp_path):
    schema = "activity_id string, ts timestamp_ntz, customer string"
    table = str(tmp_path / "t")
    write_stream(spark.createDataFrame([(f"a{d}", T0 + dt.timedelta(days=d), "c") for d in range(5)], schema), table)
    batch = spark.createDataFrame([("a2", T0 + dt.timedelta(days=2), "c"), ("new", T0 + dt.timedelta(days=3), "c"), ("none", None, "c")], schema)
    known = on_days(read_stream(spark, table), days_of(batch))
    plan = known._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "2024-01-03" in line.split("PartitionFilters", 1)[1]
    assert {r.activity_id for r in known.collect()} == {"a2", "a3"}
    append_new(batch, table, same_day=True)
    append_new(batch, table, same_day=True)
    assert ids(spark, table) == ["a0", "a1", "a2", "a3", "a4", "new", "none"]


def _sessions(spark, tmp_path, batches, timeout_s=7200, watermark="1 hour"):
    """Abandoned sessions after each batch, each in a query of its own that goes on where the last one ended."""
    schema, seen = "ts timestamp_ntz, customer string, activity string", []
    for rows in batches:
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(str(tmp_path / "t"))
        abandoned.abandoned_sessions_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "t")), str(tmp_path / "o"), str(tmp_path / "m"),
                                            timeout_s=timeout_s, watermark=watermark).awaitTermination()
        seen.append(sorted((r.customer or "", r.first_event, r.last_event, r.activities) for r in spark.read.parquet(str(tmp_path / "o")).collect()))
    return seen


def test_abandoned_sessions_over_restarts(spark, tmp_path):
    h, start, end = dt.timedelta(hours=1), "claude_session_start", "claude_session_end"
    seen = _sessions(spark, tmp_path, [
        # out of order in the batch; a session that another batch goes on with; one that ends in another batch; no customer
        [(T0 + h, "gone", "x"), (T0, "gone", start), (T0 + 9 * h, "open", start), (T0 + 9 * h, "ends", start), (T0, None, start), (T0, "no start", "x"), (None, "gone", start),
         (T0 + 10 * h, "clock", "x")],
        [(T0 + 9.5 * h, "ends", end), (T0 + 10.9 * h, "open", "x"), (T0 + 10.2 * h, "open", None)],
        # a row behind the watermark belongs to nobody's session any more
        [(T0 + 40 * h, "clock", "x"), (T0 + h, "gone", start)],
        [(T0 + 80 * h, "clock", "x")],
    ])
    first = [("", T0, T0, 1), ("gone", T0, T0 + h, 2)]
    assert seen[:2] == [first, first]
    assert seen[2] == seen[3] == [*first, ("open", T0 + 9 * h, T0 + 10.9 * h, 3)]


def test_abandoned_sessions_need_little_state(spark, tmp_path):
    # a third of all rows is one customer's, in any order; its state is its one open session
    rows = [(T0 + dt.timedelta(seconds=(i * 7919) % 30_000), "busy" if i % 3 == 0 else f"c{i}", "claude_session_start") for i in range(3000)]
    seen = _sessions(spark, tmp_path, [rows, [(T0 + dt.timedelta(days=9), "clock", "x")]], watermark="0 seconds")
    busy = sorted(t for t, c, _ in rows if c == "busy")
    assert ("busy", busy[0], busy[-1], 1000) in seen[1] and len(seen[1]) == 2001


def test_abandoned_sessions_without_python_for_each_customer(spark, tmp_path):
    # a fifth of all rows is one customer's; steps of half a timeout, so that events come just a timeout after others
    schema, r = "ts timestamp_ntz, customer string, activity string", random.Random(8)
    rows = [(T0 + dt.timedelta(hours=r.randrange(200)), "busy" if i % 5 == 0 else f"c{r.randrange(400)}",
             r.choice(("claude_session_start", "claude_session_end", "x", None))) for i in range(3000)]
    spark.createDataFrame([*rows, (T0 + dt.timedelta(days=90), "clock", "x")], schema).repartition(4).write.parquet(str(tmp_path / "t"))
    query = abandoned.abandoned_sessions_stream(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(str(tmp_path / "t")), str(tmp_path / "o"), str(tmp_path / "m"))
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "SessionWindowStateStoreSave" in plan and "Pandas" not in plan and "Python" not in plan
    # sessions are merged before the rows of a customer meet
    assert "MergingSessions" in plan.split("Exchange", 1)[1]
    got = sorted((x.customer, x.first_event, x.last_event, x.activities) for x in spark.read.parquet(str(tmp_path / "o")).collect())
    us, want = dt.timedelta(microseconds=1), []
    for customer in {c for _, c, _ in rows}:
        parts = np.array([((t - T0) // us, (t - T0) // us, a == "claude_session_start", a == "claude_session_end", 1) for t, c, a in rows if c == customer], np.int64)
        want += [(customer, T0 + int(a) * us, T0 + int(b) * us, int(n)) for a, b, started, ended, n in abandoned.merge_sessions(parts, 7200 * 10**6) if started and not ended]
    assert got == sorted(want) and len(got) > 100


def test_merged_sessions_equal_brute_force():
    r = random.Random(5)
    for _ in range(300):
        times = [r.randrange(60) for _ in range(r.randrange(1, 25))]
        parts = np.array([[t, t, r.randrange(2), 0, 1] for t in times], np.int64)
        cuts = sorted(r.randrange(len(parts) + 1) for _ in range(3))
        got = np.empty((0, 5), np.int64)
        for low, high in zip([0, *cuts], [*cuts, len(parts)]):
            got = abandoned.merge_sessions(np.concatenate((got, parts[low:high])), 5)
        want = []
        for t in sorted(times):
            if want and t < want[-1][1] + 5:
                want[-1][1], want[-1][2] = t, want[-1][2] + 1
            else:
                want.append([t, t, 1])
        assert got[:, [0, 1, 4]].tolist() == want


IDS = "activity_id string, ts timestamp_ntz, customer string"


def _files_read(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numFiles").value()


def test_filters_open_only_the_days_that_hold_an_id(spark, tmp_path):
    table = str(tmp_path / "t")
    days = [spark.createDataFrame([(f"a{d}-{i}", T0 + dt.timedelta(days=d, seconds=i), "c") for i in range(50)], IDS) for d in range(8)]
    for rows in days:
        append_new(rows, table)
    # copies on other days than their events, a new id, ids that are NULL
    batch = spark.createDataFrame([("a2-7", T0 + dt.timedelta(days=6), "c"), ("a5-0", None, "c"), ("new", T0, "c"), ("new", T0, "d"), (None, T0, "c")], IDS)
    found = days_with(batch, table)
    assert {"2024-01-03", "2024-01-06"} <= {str(d) for d in found} and len(found) <= 3
    opened, every = on_days(read_stream(spark, table), found), read_stream(spark, table)
    assert 0 < _files_read(opened) <= 3 * _files_read(every) // 8
    append_new(batch, table)
    assert sorted(i or "" for i in (r.activity_id for r in every.sparkSession.read.parquet(table).collect())) == sorted(
        ["", "new", *(f"a{d}-{i}" for d in range(8) for i in range(50))])
    append_new(batch.where("activity_id IS NOT NULL"), table)
    assert spark.read.parquet(table).count() == 402


def test_filters_of_an_older_table_and_of_rows_without_a_day(spark, tmp_path):
    table = str(tmp_path / "t")
    write_stream(spark.createDataFrame([("a", T0, "c"), ("b", None, "c")], IDS), table)
    batch = spark.createDataFrame([("a", T0 + dt.timedelta(days=3), "c"), ("b", T0, "c"), ("c", T0, "c")], IDS)
    for _ in range(2):
        append_new(batch, table)
        assert ids(spark, table) == ["a", "b", "c"]
    # a job that failed between the two writes has left a filter without rows
    lost = spark.createDataFrame([("lost", T0, "c")], IDS)
    filter_rows(lost).write.mode("append").parquet(f"{table}_ids")
    append_new(lost, table)
    assert ids(spark, table) == ["a", "b", "c", "lost"]
    build_id_filters(read_stream(spark, table), table)
    append_new(batch, table)
    assert ids(spark, table) == ["a", "b", "c", "lost"]


def test_filters_have_every_id_and_little_else(spark):
    rows = spark.range(20_000).selectExpr("concat('x', id) AS activity_id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, id % 4) AS ts")
    filters = filter_rows(rows)
    assert candidates(rows, filters).join(rows.selectExpr("activity_id", "to_date(ts) AS dt"), ["activity_id", "dt"]).count() == 20_000
    assert candidates(spark.range(50_000).selectExpr("concat('y', id) AS activity_id"), filters).count() <= 20
    assert filters.agg({"bits": "count"}).first()[0] * 64 <= 64 * 20_000


def _batch(spark, customers):
    schema = "ts timestamp_ntz, customer string, activity string, activity_id string, feature_json string, link string"
    return spark.createDataFrame([(T0, c, "x", f"a{c}", None, None) for c in customers], schema)


def test_context_batch_writes_the_buckets_of_its_contexts_only(spark, tmp_path):
    insights = spark.createDataFrame([], "id string, ts timestamp_ntz, customer string, subject string, metric string, value double, confidence double, "
                                     "artifact_id string, valid_until timestamp_ntz, is_stale boolean, is_quarantined boolean")
    base, as_of = str(tmp_path / "cache"), T0 + dt.timedelta(minutes=1)
    old = spark.createDataFrame([("old", "default", "{}", T0 - dt.timedelta(days=1), 5, False), ("c1", "brief", "{}", T0, 7, False)], context.CACHE_COLUMNS)
    write_version(context.cache_rows(old), base, 0, kind="base", buckets="bucket")
    run = context.refresh_batch(base, lambda: insights, lambda: _batch(spark, []), as_of)
    run(_batch(spark, [f"c{i}" for i in range(200)]), 0)
    run(_batch(spark, ["c1", "c2"]), 1)
    assert 1 <= len(list((tmp_path / "cache" / "version=000000000002").glob("bucket=*"))) <= 2

    def rows():
        return {(r.customer, r.context_type): (r.access_count, r.is_stale) for r in context.read_cache(spark, base, as_of).collect()}

    before = rows()
    assert before["old", "default"] == (5, True) and before["c1", "brief"] == (7, True) and before["c1", "default"] == (1, False)
    assert before["c3", "default"] == (0, False) and len(before) == 202
    context.compact_cache(spark, base)
    assert rows() == before
    assert len(retire_versions(spark, base)) == 3 and rows() == before
    run(_batch(spark, ["c9"]), 2)
    assert rows()["c9", "default"] == (1, False) and len(rows()) == 202
    files = context.read_cache(spark, base, as_of, customer="c9").inputFiles()
    assert files and len({f.split("bucket=")[1].split("/")[0] for f in files}) > 0
    assert [r.access_count for r in context.read_cache(spark, base, as_of, customer="c9").collect()] == [1]


def test_late_rows_merge_into_sketches_without_the_table(spark, tmp_path):
    schema = "ts timestamp_ntz, customer string, activity string, revenue_impact double, feature_json string"
    table, out, mark = str(tmp_path / "t"), str(tmp_path / "out"), str(tmp_path / "m")
    r, every = random.Random(2), []
    for day in (20, 21, 18, 20):
        rows = [(T0 + dt.timedelta(days=day, minutes=r.randrange(90)), r.choice(["c", None]), f"x{r.randrange(30)}", 0.5,
                 r.choice([None, f'{{"latency_ms":{r.randrange(500)},"success":true,"total_tokens":{r.randrange(9)}}}'])) for _ in range(150)]
        every += rows
        spark.createDataFrame(rows, schema).write.mode("append").parquet(table)
        sketches.hourly_sketch_stream(spark.readStream.schema(schema).parquet(table), out, mark).awaitTermination()

    def values(df):
        return {(r.hour, r.customer): (r.total_activities, r.activity_types, r.p95_latency_ms, r.successful_operations, r.total_tokens) for r in df.collect()}

    # fewer rows than a sketch keeps exactly
    want = values(metrics.hourly_metrics(spark.createDataFrame(every, schema)))
    assert all(v[1] == len({x[2] for x in every if x[0].replace(minute=0) == hour and x[1] == c}) for (hour, c), v in want.items())
    assert values(sketches.read_hourly_sketches(spark, out)) == want
    (tmp_path / "out" / "version=000000000099").mkdir()
    sketches.compact_hourly_sketches(spark, out, retire=True)
    assert values(sketches.read_hourly_sketches(spark, out)) == want
    spark.createDataFrame(every[:9], schema).write.mode("append").parquet(table)
    sketches.hourly_sketch_stream(spark.readStream.schema(schema).parquet(table), out, mark).awaitTermination()
    assert sum(v[0] for v in values(sketches.read_hourly_sketches(spark, out)).values()) == 609
    assert read_stream(spark, out + "/version=000000000005").count() <= 9


def test_sketches_of_many_rows(spark):
    rows = spark.range(200_000).selectExpr(
        "timestamp_ntz'2024-01-01 00:30:00' AS ts", "'c' AS customer", "concat('x', id % 500) AS activity", "1.0D AS revenue_impact",
        "concat('{\"latency_ms\":', (id * 7919) % 200000, '}') AS feature_json")
    parts = [sketches.hourly_sketches(rows.where(F.col("activity").endswith(str(d)))) for d in range(10)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    row = sketches.measures(sketches.merge_sketches(merged)).first()
    assert row.total_activities == 200_000 and abs(row.activity_types - 500) <= 15 and abs(row.p95_latency_ms - 190_000) <= 1_000
    assert sketches.merge_sketches(merged).selectExpr("octet_length(latencies) + octet_length(activities)").first()[0] < 100_000
