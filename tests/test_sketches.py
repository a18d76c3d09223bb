"""Stored sketches against exact quantiles and counts."""

import math

import numpy as np
from pyspark.sql import functions as F

from holdfast.operators import sketches
from holdfast.session import fresh_path

QUANTILES = {"p50": 0.5, "p99": 0.99}


def events(spark, rows):
    frame = spark.createDataFrame(rows, "second bigint, kind string, value double, who bigint")
    return frame.withColumn("ts", F.timestamp_seconds("second"))


def at_rank(values, q):
    return sorted(values)[max(0, math.ceil(q * len(values)) - 1)]


def test_small_windows_are_exact_and_odd_values_defined(spark):
    rng = np.random.default_rng(3)
    rows = [(int(s), "ab"[int(s) % 2], float(v), int(w)) for s, v, w in zip(rng.integers(0, 1200, 900), rng.normal(size=900), rng.integers(0, 40, 900))]
    rows += [(10, "c", None, 1), (11, "c", float("nan"), None), (None, "c", 1.0, 1)]
    made = sketches.sketched(events(spark, rows), "ts", ["kind"], "value", "who")
    got = {(r["start"], r["kind"]): r for r in sketches.merged(made, ["kind"], 300, QUANTILES).withColumn("start", F.unix_seconds("window_start")).collect()}
    groups = {}
    for s, kind, v, w in rows[:900]:
        groups.setdefault((s // 300 * 300, kind), []).append((v, w))
    odd = got.pop((0, "c"))
    assert (odd["points"], odd["value_count"], odd["p50"], odd["entities"]) == (2, 0, None, 1)
    assert set(got) == set(groups)
    for key, members in groups.items():
        values = [v for v, _ in members]
        assert got[key]["points"] == len(values)
        assert got[key]["p50"] == at_rank(values, 0.5) and got[key]["p99"] == at_rank(values, 0.99)
        assert got[key]["entities"] == len({w for _, w in members})


def test_merged_error_is_bounded(spark):
    points = spark.range(200_000).select(
        (F.col("id") % 7200).alias("second"), F.lit("a").alias("kind"), (F.hash("id") / 1e6).alias("value"), (F.col("id") % 30_000).alias("who")
    ).withColumn("ts", F.timestamp_seconds("second"))
    row = sketches.merged(sketches.sketched(points, "ts", ["kind"], "value", "who"), ["kind"], None, QUANTILES).first()
    values = np.sort([r[0] for r in points.select("value").collect()])
    for name, q in QUANTILES.items():
        assert abs(np.searchsorted(values, row[name]) / len(values) - q) < 0.01
    assert row["points"] == 200_000 and abs(row["entities"] - 30_000) < 30_000 * 0.07


def test_a_day_is_stored_alone(spark):
    folder = fresh_path(spark, "sketches")
    day = lambda n, value, count=5: events(spark, [(n * 86400 + i, "a", value + i, i) for i in range(count)])
    write = lambda points: sketches.store(sketches.sketched(points, "ts", ["kind"], "value", "who"), folder)
    write(day(0, 0.0))
    write(day(1, 100.0))
    write(day(1, 200.0, 3))  # the same day again replaces it
    total = sketches.merged(sketches.read(spark, folder), ["kind"], None, {"low": 0.0, "high": 1.0}).first()
    assert (total["points"], total["low"], total["high"]) == (8, 0.0, 202.0)
    days = sketches.merged(sketches.read(spark, folder), [], 86400, {"p50": 0.5}).orderBy("window_start").collect()
    assert [(r["points"], r["p50"]) for r in days] == [(5, 2.0), (3, 201.0)]


def test_no_points(spark):
    none = sketches.sketched(events(spark, []), "ts", ["kind"], "value", "who")
    assert sketches.merged(none, ["kind"], 300, QUANTILES).count() == 0
