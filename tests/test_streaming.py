"""Streaming forms give what the batch forms give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from holdfast.session import fresh_path
from holdfast.sources import messages, schemas
from holdfast.streaming import alerts, breaches, jobs, windows


@pytest.fixture(scope="module")
def points(spark):
    df = spark.range(400).selectExpr(
        "timestamp_seconds(1704067200 + id * 37) as ts",
        "if(id % 3 = 0, 'a', 'b') as series",
        "cast(id % 17 as double) as value",
    )
    path = fresh_path(spark, "points")
    df.repartition(5).write.parquet(path)
    return path, df


def stream(spark, points):
    path, df = points
    return jobs.file_stream(spark, path, df.schema, 2)


@pytest.mark.parametrize("metric", ["mean", "sum", "rate"])
def test_windows(spark, points, metric):
    make = {
        "mean": lambda f, d: windows.window_mean(f, "ts", ["series"], "value", delay=d),
        "sum": lambda f, d: windows.window_sum(f, "ts", ["series"], "value", delay=d),
        "rate": lambda f, d: windows.window_rate(f, "ts", ["series"], F.col("value") > 12, delay=d),
    }[metric]
    got = jobs.drain_updates(make(stream(spark, points), "2 days"), ["window_start", "window_end", "series"], "w")
    want = make(points[1], None)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_streamed_percentile_is_near_the_exact_one(spark, points):
    rough = windows.window_percentiles(points[1], "ts", ["series"], "value", 86400).orderBy("window_start", "series").collect()
    exact = windows.window_percentiles_exact(points[1], "ts", ["series"], "value", 86400).orderBy("window_start", "series").collect()
    assert len(rough) == len(exact)
    assert all(abs(a["p50"] - b["p50"]) <= 1 and abs(a["p99"] - b["p99"]) <= 1 for a, b in zip(rough, exact))


def test_sustained_alert_needs_an_unbroken_run(spark):
    rows = [("s", 0, 0.2), ("s", 300, 0.3), ("s", 600, 0.05), ("s", 900, 0.2), ("s", 1500, 0.2), ("s", 1800, 0.2)]
    frame = spark.createDataFrame(rows, "series string, at bigint, mean double").select(
        F.timestamp_seconds("at").alias("window_start"), "series", "mean", "at"
    )
    got = windows.sustained_alerts(frame, ["series"], "mean", 0.1, 300, 600)
    assert sorted(r["at"] for r in got.collect()) == [300, 1800]
    assert windows.threshold_alerts(frame, "mean", 0.2).count() == 1


def test_alert_messages(spark):
    rows = [("1", '{"drifted_features": 4}'), ("2", '{"drifted_features": 3, "prediction_drift": {"drifted": false}}'), ("3", '{"prediction_drift": {"drifted": true}}'), ("4", "{}"), ("5", None)]
    sent = spark.createDataFrame(rows, "message_id string, body string").select("message_id", F.base64(F.encode("body", "utf-8")).alias("data"))
    got = {r["message_id"]: r["action"] for r in alerts.retrain_decisions(alerts.decode_alerts(sent)).collect()}
    assert got == {"1": "retrain", "2": "monitor", "3": "retrain", "4": "monitor"}
    asked = {r["message_id"]: (r["reason"], r["pipeline_name"]) for r in alerts.decode_retrain_requests(sent).collect()}
    assert asked["5"] == ("manual", "retention-pipeline") and len(asked) == 5


def test_sustained_alerts_of_a_stream_equal_those_of_a_batch(spark):
    # minutes of two series in files out of order by less than the delay, with a gap and a silent end
    def minute(series, m, value):
        return (series, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m, seconds=7), float(value))

    values = {m: 9 if 3 <= m <= 8 or 12 <= m <= 13 or 20 <= m <= 26 else 1 for m in range(40) if m not in (23, 14, 15)}
    rows = [minute("a", m, v) for m, v in values.items()] + [minute("b", m, 9) for m in range(0, 6)] + [minute("a", 59, 1)]
    rows.sort(key=lambda r: r[1])
    parts = [[r for i, r in enumerate(rows) if (i // 4 + (i % 3 == 0)) == n] for n in range(13)]
    path = fresh_path(spark, "points")
    schema = "series string, ts timestamp, value double"
    for part in parts:
        if part:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    points = spark.read.schema(schema).parquet(path)
    want = windows.sustained_alerts(windows.window_mean(points, "ts", ["series"], "value", 60), ["series"], "mean", 5, 60, 180)
    last = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=29)
    want = sorted((r["series"], r["window_start"], r["breaching_windows"]) for r in want.where(F.col("window_end") <= F.lit(last)).collect())
    stream = jobs.file_stream(spark, path, points.schema, 2)
    told = breaches.sustained_alert_stream(windows.window_mean(stream, "ts", ["series"], "value", 60, delay="30 minutes"), ["series"], "mean", 5, 60, 180)
    got = jobs.with_state_store(spark, lambda: jobs.drain_rows(told, "alerts"))
    assert sorted((r["series"], r["window_start"], r["breaching_windows"]) for r in got.collect()) == want
    assert len(want) >= 8


def test_redelivered_messages(spark):
    path = fresh_path(spark, "messages")
    rows = [("m1", "e30="), ("m2", "e30="), ("m1", "e30=")]
    spark.createDataFrame(rows, "message_id string, data string").withColumn(
        "publish_time", F.lit("2024-01-01 00:00:00").cast("timestamp")
    ).write.json(path)
    once = alerts.decode_alerts(alerts.deduplicate(messages.message_stream(spark, path)))
    assert sorted(r["message_id"] for r in jobs.drain_rows(once, "once").collect()) == ["m1", "m2"]


def test_batches_checked_against_a_profile(spark):
    profile = spark.range(300).selectExpr("cast(id % 10 as double) as x", "cast(id % 4 > 0 as int) as y")
    calm = spark.range(200).selectExpr("cast(id % 10 as double) as x", "cast(id % 4 > 0 as int) as predicted_class")
    path, out = fresh_path(spark, "calm"), fresh_path(spark, "alerts")
    calm.coalesce(1).write.parquet(path)
    calm.withColumn("x", F.col("x") + 8).coalesce(1).write.mode("append").parquet(path)
    jobs.check_batches(jobs.file_stream(spark, path, calm.schema, 1), profile, "y", out, fresh_path(spark, "cp"))
    rows = spark.read.parquet(out).orderBy("drifted_features").collect()
    assert [(r["drifted_features"], r["alert_triggered"]) for r in rows] == [(0, False), (1, True)]
    again = spark.read.parquet(out).select(F.monotonically_increasing_id().alias("message_id"), "data")
    assert sorted(r["drifted_features"] for r in alerts.decode_alerts(again).collect()) == [0, 1]


def test_scoring_into_the_log(spark):
    path, log = fresh_path(spark, "requests"), fresh_path(spark, "log")
    requests = spark.range(20).selectExpr("concat('s', id) as student_id", "cast(id as double) as hs_gpa", "timestamp_seconds(1704067200 + id * 9000) as ts")
    requests.write.parquet(path)

    def score(batch):
        scored = batch.withColumn("predicted_class", (F.col("hs_gpa") > 5).cast("int")).withColumn("predicted_probability", F.col("hs_gpa") / 20)
        return jobs.prediction_log(scored, "student_id", ["hs_gpa"], "v1", "ts")

    jobs.score_stream(jobs.file_stream(spark, path, requests.schema), score, log, fresh_path(spark, "cp"))
    rows = spark.read.parquet(log)
    assert rows.count() == 20 and rows.select("prediction_id").distinct().count() == 20 and rows.select("day").distinct().count() == 2
    declared = {f.name: f.dataType for f in schemas.schema_of(schemas.PREDICTION_LOG).fields}
    assert all(rows.schema[n].dataType == t for n, t in declared.items())


def test_cache_answers_expire(spark):
    rows = [
        (1, 0, 1, 0.9), (1, 10, None, None), (1, 3599, None, None), (1, 3600, None, None),
        (2, 5, None, None), (1, 4000, 0, 0.2), (1, 4001, None, None),
    ]
    df = spark.createDataFrame(rows, "entity bigint, at bigint, predicted_class int, probability double").select(
        "entity", F.timestamp_seconds(F.col("at") + 1704067200).alias("ts"), "predicted_class", "probability"
    )
    path = fresh_path(spark, "cache")
    df.coalesce(1).write.parquet(path)
    looked = jobs.drain_rows(jobs.cache_stream(jobs.file_stream(spark, path, df.schema), 3600), "lookups")
    got = sorted((r["entity"], r["at"], r["hit"], r["predicted_class"]) for r in looked.selectExpr("*", "unix_timestamp(ts) - 1704067200 as at").collect())
    assert got == [(1, 10, True, 1), (1, 3599, True, 1), (1, 3600, False, None), (1, 4001, True, 0), (2, 5, False, None)]


def test_cache_with_many_shuffled_rows_of_one_entity(spark):
    import random

    rnd = random.Random(3)
    rows = [(7, rnd.randrange(200_000), i, rnd.randrange(2) if i % 5 == 0 else None) for i in range(50_000)]
    df = spark.createDataFrame(rows, "entity bigint, at bigint, seq bigint, predicted_class int").select(
        "entity", F.timestamp_seconds(F.col("at") + 1704067200).alias("ts"), "seq", "predicted_class",
        F.when(F.col("predicted_class").isNotNull(), F.col("seq") / 1e6).alias("probability"),
    )
    path = fresh_path(spark, "cache-many")
    df.coalesce(1).write.parquet(path)
    looked = jobs.drain_rows(jobs.cache_stream(jobs.file_stream(spark, path, df.schema), 60), "lookups")
    found = looked.selectExpr("*", "unix_timestamp(ts) - 1704067200 as at").collect()
    got = sorted(((r["at"], r["hit"], r["predicted_class"], r["probability"]) for r in found), key=str)
    want, held = [], None
    for _, at, seq, label in sorted(rows, key=lambda r: (r[1], r[2])):
        if label is not None:
            held = (at, label, seq / 1e6)
        else:
            hit = held is not None and at - held[0] < 60
            want.append((at, hit, held[1] if hit else None, held[2] if hit else None))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_lookups_without_an_entity_in_one_task(spark, files_per_batch):
    import random

    rnd = random.Random(5)
    rows = sorted((at, i) for i, at in enumerate(rnd.choices(range(100_000), k=6_000)))
    rows = [(7 if k % 3 else k % 40, at, i, rnd.randrange(2) if rnd.random() < 0.1 else None) for k, (at, i) in enumerate(rows)]
    df = spark.createDataFrame(rows, "entity bigint, at bigint, seq bigint, predicted_class int").select(
        "entity", F.timestamp_seconds(F.col("at") + 1704067200).alias("ts"), "seq", "predicted_class",
        F.when(F.col("predicted_class").isNotNull(), F.col("seq") / 1e6).alias("probability"),
    )
    path = fresh_path(spark, "lookups-in")
    # batches by time, one file each
    for k in range(4):
        df.where(f"floor((unix_seconds(ts) - 1704067200) / 25000) = {k}").coalesce(1).write.mode("append").parquet(path)
    found = jobs.looked_up(jobs.file_stream(spark, path, df.schema, files_per_batch), 600).selectExpr("*", "unix_timestamp(ts) - 1704067200 as at").collect()
    got = [(r["entity"], r["at"], r["hit"], r["predicted_class"], r["probability"]) for r in found]
    want, held = [], {}
    for entity, at, seq, label in sorted(rows, key=lambda r: (r[1], r[2])):
        if label is not None:
            held[entity] = (at, label, seq / 1e6)
        else:
            hit = entity in held and at - held[entity][0] < 600
            want.append((entity, at, hit, held[entity][1] if hit else None, held[entity][2] if hit else None))
    assert sorted(got, key=str) == sorted(want, key=str)
