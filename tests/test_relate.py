import pytest
from pyspark.sql import functions as F

from holdfast.operators import relate


@pytest.fixture(scope="module")
def events(spark):
    rows = [("s1", "enrollment", 1), ("s1", "application", 0), ("s2", "enrollment", 0), (None, "enrollment", 1), ("s3", "enrollment", 1)]
    return spark.createDataFrame(rows, "student_id string, event_type string, flag int")


def test_latest_values_may_mix_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, 10, "x"), ("a", 2, None, "y"), ("a", 3, None, None), ("b", 1, None, None)],
        "k string, t int, v int, w string",
    )
    got = {r["k"]: (r["v"], r["w"], r["t"]) for r in relate.latest_values(df, "k", ["t"]).collect()}
    assert got == {"a": (10, "y", 3), "b": (None, None, 1)}
    whole = {r["k"]: (r["t"], r["v"], r["w"]) for r in relate.latest_row(df, "k", ["t"]).collect()}
    assert whole["a"] == (3, None, None)


def test_latest_values_with_ties_by_order_and_by_aggregate(spark):
    rows = [(i % 7 if i % 11 else None, i % 3, i % 5 if i % 4 else None, float(i % 6) if i % 3 else None, f"w{i % 2}" if i % 5 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, t int, u int, v double, w string")
    order = ["t", "u", "v", "w"]
    ordered, folded = (relate.latest_values(df, "k", order, hot_rows=n) for n in (1_000_000, 1))
    assert sorted(ordered.collect(), key=str) == sorted(folded.collect(), key=str)
    known = {}
    for row in sorted(rows, key=lambda r: [(x is not None, x) if x is not None else (False, 0) for x in r[1:]]):
        known.setdefault(row[0], {}).update({c: x for c, x in zip(order, row[1:]) if x is not None})
    assert {r["k"]: {c: r[c] for c in order if r[c] is not None} for r in ordered.collect()} == known
    # values keep no order of their own through the shuffle
    assert "max_by" not in ordered._jdf.queryExecution().executedPlan().toString()


def test_joins_without_hot_keys_keep_rows_in_place(spark, events):
    sides = [(spark.createDataFrame([(f"s{i}", i)], f"student_id string, x{i} int").distinct(), "") for i in range(2)]
    merged = relate.merge_tables(events.hint("shuffle_merge"), "student_id", [(side.hint("shuffle_merge"), s) for side, s in sides])
    plan = merged.distinct()._jdf.queryExecution().executedPlan().toString()
    assert "_salt" not in plan and "x0" in plan
    assert "hashpartitioning(student_id" in plan and plan.count("Exchange") <= 1 + 2 * len(sides)


def test_right_duplicates_multiply_rows(spark, events):
    right = spark.createDataFrame([("s1", "a"), ("s1", "b"), ("s2", "c")], "student_id string, name string")
    merged = relate.merge_tables(events, "student_id", [(right, "_r")], F.col("event_type") == "enrollment")
    got = sorted((r["student_id"] or "", r["name"] or "") for r in merged.collect())
    assert got == [("", ""), ("s1", "a"), ("s1", "b"), ("s2", "c"), ("s3", "")]
    assert [r["student_id"] for r in relate.duplicate_keys(right, "student_id").collect()] == ["s1"]


def test_suffixes_and_absent_tables(spark, events):
    demo = spark.createDataFrame([("s1", 7)], "student_id string, flag int")
    acad = spark.createDataFrame([("s1", 8)], "student_id string, flag int")
    merged = relate.merge_tables(events, "student_id", [(demo, "_demo"), (None, "_fin"), (acad, "_acad")])
    assert merged.columns == ["student_id", "event_type", "flag", "flag_demo", "flag_acad"]
    assert {(r["flag_demo"], r["flag_acad"]) for r in merged.where("student_id = 's1'").collect()} == {(7, 8)}


def test_hot_keys_are_salted_without_changing_the_result(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("x")
    )
    right = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    salted = relate.merge_tables(left, "k", [(right, "_r")], hot_rows=10, rows_per_salt=3)
    plain = left.join(right, "k", "left").select("k", "x", "y")
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_orphans_and_first_row(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "c int")
    parent = spark.createDataFrame([(1,)], "p int")
    assert [r["key"] for r in relate.orphans(child, "c", parent, "p").collect()] == [2]
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x")], "k string, t int, v string")
    assert relate.first_row(df, "k", ["t"]).collect() == [("a", 1, "x")]


def test_traffic_shares(spark):
    ids = spark.range(20000)
    got = relate.share_assignment(ids, "id", {"primary": 90, "canary": 10})
    counts = {r["assigned_version"]: r["count"] for r in got.groupBy("assigned_version").count().collect()}
    assert counts["canary"] == pytest.approx(2000, rel=0.1)
    again = relate.share_assignment(ids, "id", {"primary": 90, "canary": 10})
    assert got.exceptAll(again).count() == 0
    with pytest.raises(ValueError):
        relate.share_assignment(ids, "id", {"primary": 90})
