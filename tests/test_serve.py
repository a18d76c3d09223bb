import pytest

from holdfast.operators import serve


def tables(spark):
    requests = spark.createDataFrame(
        [("s1", 1, 0.8, "v1"), ("s2", None, None, None), ("s3", None, None, None), ("s4", None, None, None), ("s5", None, None, None)],
        "student_id string, live_class int, live_probability double, live_version string",
    ).selectExpr("*", "timestamp'2024-01-01 12:00:00' as now")
    cache = spark.createDataFrame(
        [("s1", "2024-01-01 11:59:00", 0, 0.1, "v1"), ("s2", "2024-01-01 11:00:01", 1, 0.9, "v1"), ("s3", "2024-01-01 11:00:00", 1, 0.7, "v1")],
        "student_id string, stored string, cache_class int, cache_probability double, cache_version string",
    ).withColumn("stored", __import__("pyspark").sql.functions.to_timestamp("stored"))
    batch = spark.createDataFrame(
        [("s2", 0, 0.32, "batch_v1"), ("s3", 0, 0.31, "batch_v1"), ("s4", 1, 0.91, "batch_v1")],
        "student_id string, batch_class int, batch_probability double, batch_version string",
    )
    return requests, cache, batch


def test_four_tiers_and_strict_expiry(spark):
    answers = serve.fallback_chain(*tables(spark), "student_id", "now", "stored", 3600)
    got = {r["student_id"]: (r["served_from"], r["predicted_class"], r["probability"], r["model_version"], r["degraded"]) for r in answers.collect()}
    assert got == {
        "s1": ("live", 1, 0.8, "v1", False),
        "s2": ("cache", 1, 0.9, "v1", True),
        "s3": ("batch", 0, 0.31, "batch_v1", True),  # exactly 3600 s old
        "s4": ("batch", 1, 0.91, "batch_v1", True),
        "s5": ("default", -1, 0.5, "none", True),
    }
    stats = serve.tier_statistics(answers).first()
    assert (stats["live"], stats["cache"], stats["batch"], stats["default"], stats["degraded_pct"]) == (1, 1, 2, 1, 0.8)
    assert serve.tier_statistics(answers.where("student_id = 'zz'")).first()["degraded_pct"] == 0.0


def test_cache_statistics_and_latest(spark):
    requests, cache, _ = tables(spark)
    log = cache.unionAll(cache.selectExpr("student_id", "stored - interval 5 minutes", "9", "cache_probability", "cache_version"))
    latest = serve.latest_answers(log, "student_id", "stored", ["cache_class"])
    assert latest.where("cache_class = 9").count() == 0
    stats = serve.cache_statistics(serve.ttl_lookup(requests, latest, "student_id", "now", "stored"), "cache_class").first()
    assert (stats["hits"], stats["misses"], stats["hit_rate"]) == (2, 3, 0.4)


def test_request_bounds(spark):
    df = spark.createDataFrame(
        [("a", 4.0, 400.0, 0.0), ("b", 4.1, 399.0, -1.0), ("c", None, None, None)],
        "student_id string, hs_gpa double, sat_score double, efc double",
    )
    got = {r["student_id"]: (r["valid"], r["violations"]) for r in serve.validate_requests(df).collect()}
    assert got == {"a": (True, []), "b": (False, ["hs_gpa<=4.0", "sat_score>=400", "efc>=0"]), "c": (True, [])}


def test_defaults_keep_zero_and_features_align(spark):
    df = spark.createDataFrame([("a", 0.0, True, None)], "student_id string, efc double, pell_eligible boolean, hs_gpa double")
    row = serve.with_defaults(df).first()
    assert (row["efc"], row["pell_eligible"], row["hs_gpa"], row["first_generation_flag"]) == (0.0, 1, -1.0, 0)
    aligned = serve.align_features(df, ["other", "efc"], ["student_id"])
    assert aligned.collect() == [("a", 0.0, 0.0)] and aligned.columns == ["student_id", "other", "efc"]
