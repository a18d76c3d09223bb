import math

import pytest
from pyspark.sql import functions as F

from holdfast.functions import scalars as S
from holdfast.operators import prep


def test_bins_on_the_edges(spark):
    values = [-1.0, 0.0, 25.0, 25.0001, 50.0, 100.0, 250.0, 500.0, 501.0, float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(S.interval_bin(F.col("x"), prep.DISTANCE_EDGES)).collect()]
    assert got == [-1, 0, 0, 1, 1, 2, 3, 4, 5, 5, -1]


def test_harmonise(spark):
    df = spark.createDataFrame(
        [("s1", "nan", "1e3", "7.0", "true", None), ("s1", "nan", "1e3", "7.0", "true", None), ("s2", None, "x", None, None, 2.0), ("s3", "M", "NaN", "8", "no", 1.0)],
        "student_id string, gender string, hs_gpa string, cohort_year string, pell_eligible string, other double",
    )
    rows = {r["student_id"]: r for r in prep.harmonise(df).collect()}
    assert len(rows) == 3
    assert (rows["s1"]["gender"], rows["s1"]["hs_gpa"], rows["s1"]["pell_eligible"], rows["s1"]["other"]) == ("unknown", 1000.0, True, -1.0)
    assert (rows["s2"]["hs_gpa"], rows["s2"]["cohort_year"], rows["s2"]["pell_eligible"]) == (-1.0, -1, False)
    assert (rows["s3"]["hs_gpa"], rows["s3"]["cohort_year"], rows["s3"]["pell_eligible"]) == (-1.0, 8, False)
    report = prep.harmonise_report(df).first()
    assert (report["initial_rows"], report["duplicates_removed"], report["output_rows"], report["columns_coerced"]) == (4, 1, 3, 5)


def test_report_counts_rows_in_one_pass(spark):
    df = spark.createDataFrame([("s", 1.0, 1), ("s", 1.0, 2), (None, None, 3), (None, None, 3)], "student_id string, hs_gpa double, _copies int")
    report = prep.harmonise_report(df)
    assert "ubquery" not in report._jdf.queryExecution().executedPlan().toString()
    assert tuple(report.first()) == (4, 1, 2, 2, 3, 3)
    assert tuple(prep.harmonise_report(df.limit(0)).first()) == (0, 0, 2, 0, 0, 3)


def test_dates_stay_null(spark):
    df = spark.sql("select 's' as student_id, cast(null as date) as event_date")
    assert prep.harmonise(df).first()["event_date"] is None


def test_duplicate_column_names(spark):
    df = spark.sql("select 1 as a, 2 as b, 3 as a")
    assert prep.unique_columns(df).collect() == [(1, 2)]


def test_clean(spark):
    rows = [("s1", "enrollment", "a b", 1.0, True, 5.0, "t1", 1), ("s2", "enrollment", "a.b", 2.0, False, 5.0, "t2", 0), ("s3", "enrollment", None, 3.0, True, 5.0, "t3", 1)]
    df = spark.createDataFrame(rows, "student_id string, event_type string, kind string, x double, flag boolean, campus_latitude double, free string, y int")
    cleaned, report = prep.clean(df, "y", max_categories=2)
    assert cleaned.columns == ["student_id", "x", "flag", "campus_latitude", "y", "kind_a_b", "kind_a_b_2"]
    assert {r["column"]: r["outcome"] for r in report.collect()} == {
        "student_id": "kept", "event_type": "skipped", "kind": "encoded:2", "x": "kept", "flag": "kept", "campus_latitude": "kept", "free": "string", "y": "kept"
    }
    assert [tuple(r) for r in cleaned.orderBy("student_id").select("kind_a_b", "kind_a_b_2", "flag").collect()] == [(1, 0, 1), (0, 1, 0), (0, 0, 1)]
    assert cleaned.schema["kind_a_b_2"].metadata == {"column": "kind", "level": "a.b"}


def test_all_null_column_is_constant(spark):
    df = spark.sql("select cast(null as double) as a, cast(id as double) as b, 1 as c from range(3)")
    assert prep.constant_columns(df, df.columns) == ["a", "c"]


def test_features(spark):
    df = spark.createDataFrame(
        [(2.0, 3.0, 1.0, 0.0, 5.0, 0.0, 10.0, 20.0, 2019), (-1.0, -1.0, 2.0, 10.0, 5.0, 1.0, 1000.0, 0.0, 2021), (3.0, 2.0, float("inf"), 4.0, 4.0, 2.0, None, 5.0, 2020)],
        "cumulative_gpa double, hs_gpa double, term_gpa double, credits_attempted double, credits_earned double, efc double, total_aid_amount double, loan_amount double, cohort_year bigint",
    )
    a, b, c = prep.engineer_features(df).collect()
    assert (a["gpa_change"], a["gpa_improved"], a["gpa_momentum"], a["credit_ratio"], a["credit_deficit"]) == (-1.0, 0, 0.5, 0.0, -5.0)
    assert (a["aid_coverage_ratio"], a["loan_dependency"], a["cohort_recency"]) == (0.0, 2.0, 0)
    # sentinels take part in the arithmetic
    assert (b["gpa_change"], b["gpa_momentum"], b["credit_ratio"], b["aid_coverage_ratio"], b["cohort_recency"]) == (0.0, 1.0, 0.5, 50.0, 2)
    # infinities become null in inputs and -1 in new features
    assert c["term_gpa"] is None and c["gpa_momentum"] == -1.0 and c["aid_coverage_ratio"] == -1.0 and c["gpa_improved"] == 1
    guarded = prep.engineer_features(df, guarded=True).collect()
    assert guarded[1]["gpa_change"] == -1.0 and guarded[0]["gpa_change"] == -1.0 and guarded[2]["gpa_change"] == 1.0


def test_only_possible_features(spark):
    out = prep.engineer_features(spark.sql("select 900.0D as sat_score, 18.0D as act_score"))
    assert out.columns == ["sat_score", "act_score", "test_score_composite"]
    assert out.first()["test_score_composite"] == pytest.approx((500 / 1200 + 17 / 35) / 2)


def test_export_one_row_per_entity(spark):
    df = spark.createDataFrame([("a", 2.0, 1), ("a", 1.0, 5), ("b", 3.0, 2)], "student_id string, hs_gpa double, z int")
    got = prep.export_features(df)
    assert got.columns == ["student_id", "hs_gpa"]
    assert sorted(map(tuple, got.collect())) == [("a", 1.0), ("b", 3.0)]
    assert prep.missing_features(df)[:2] == ["sat_score", "act_score"]


def test_scalars(spark):
    df = spark.sql("select 0.00025D as x, 'abc' as t, cast('nan' as double) as n")
    row = df.select(
        F.bround("x", 4), S.as_number(F.col("t")), S.as_number(F.col("n")), S.clipped(F.lit(None).cast("double"), 0, 1), S.cache_key(F.lit(7)), S.short_sha256(F.lit(None).cast("string"))
    ).first()
    assert row[0] == 0.0002 and row[1:4] == (None, None, None) and row[4] == "pred:7" and row[5] is None
    draws = [r[0] for r in spark.range(2000).select(S.hash_unit(F.col("id"), F.lit(1))).collect()]
    assert 0 <= min(draws) and max(draws) < 1 and math.isclose(sum(draws) / 2000, 0.5, abs_tol=0.03)


def test_standing_and_change(spark):
    rows = [("a", 1, 1.0, "x"), ("a", 2, 2.5, "x"), ("a", 3, 4.0, "y"), ("b", 1, 1.0, "z")]
    df = spark.createDataFrame(rows, "k string, t int, g double, m string")
    got = prep.running_standing(df, "k", ["t"], "g", {"suspension": 1.5, "probation": 2.0}, "good").orderBy("k", "t")
    assert [(r["average"], r["standing"]) for r in got.collect()] == [(1.0, "suspension"), (1.75, "probation"), (2.5, "good"), (1.0, "suspension")]
    changed = prep.changed_from_previous(df, "k", ["t"], "m").orderBy("k", "t")
    assert [r["changed"] for r in changed.collect()] == [False, False, True, False]


def test_stage_and_export_reports(spark):
    before = spark.createDataFrame([("a", 2.0), ("a", 1.0)], "student_id string, hs_gpa double")
    after = before.withColumn("sat_score", F.lit(1.0)).drop("hs_gpa").where("student_id = 'a'").limit(1)
    row = prep.stage_report(before, after).first()
    assert (row["input_rows"], row["output_rows"], row["added"], row["dropped"]) == (2, 1, ["sat_score"], ["hs_gpa"])
    got = prep.export_report(before, prep.export_features(before), ["hs_gpa", "efc"]).first()
    assert (got["entities_synced"], got["features_synced"], got["features_missing"]) == (1, 1, ["efc"])
