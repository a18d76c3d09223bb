import re

import pytest
from pyspark.sql import functions as F

from holdfast.operators import quality

def as_of():
    return F.lit("2026-01-01")


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(1, 3.5, 400, "2020-01-01", 1), (2, None, 1600, "bad", 0), (3, 4.0, 1601, "2026-01-01", 1), (4, 4.1, 399, "2026-01-02", 1)]
    return spark.createDataFrame(rows, "id int, hs_gpa double, sat_score int, event_date string, y int")


def test_ranges_are_inclusive(frame):
    got = {r["column"]: r["violations"] for r in quality.range_violations(frame, quality.STUDENT_RANGES).collect()}
    assert got == {"hs_gpa": 1, "sat_score": 2}
    examples = quality.range_examples(frame, quality.STUDENT_RANGES, ["id"], 1).collect()
    assert sorted((r["column"], r["example"]) for r in examples) == [("hs_gpa", 4.1), ("sat_score", 1601.0)]


def test_future_dates_skip_bad_text_and_the_day_itself(frame):
    assert quality.future_dates(frame, as_of()).collect() == [("event_date", 1)]
    assert quality.future_dates(frame.select("id"), as_of()).count() == 0


def test_null_rates(spark, frame):
    assert quality.null_report(frame).collect() == [("hs_gpa", 1, 0.25)]
    assert quality.null_report(frame.where("id > 9")).count() == 0


def test_profile_of_flags_text_and_empty(spark):
    df = spark.createDataFrame([(True, "a", 1.0), (False, None, 1.0), (True, "a", 4.0)], "f boolean, s string, x double")
    got = {r["column"]: r for r in quality.column_profile(df).collect()}
    assert (got["f"]["min"], got["f"]["max"], got["f"]["distinct_count"]) == (0.0, 1.0, 2)
    assert got["s"]["min"] is None and got["s"]["null_count"] == 1 and got["s"]["distinct_count"] == 1
    assert got["x"]["mean"] == 2.0 and got["x"]["std"] == pytest.approx(1.7321)
    rough = {r["column"]: r["distinct_count"] for r in quality.column_profile(df, exact=False).collect()}
    assert rough == {"f": 2, "s": 1, "x": 2}


def test_single_class_counts_as_zero(spark):
    one = spark.createDataFrame([(1,), (1,)], "y int")
    assert quality.class_balance(one, "y").collect() == [(1, 0.0, True)]
    even = spark.createDataFrame([(1,), (0,), (None,)], "y int")
    assert quality.class_balance(even, "y").collect() == [(2, 0.5, False)]


def test_gate_counts_findings_not_rows(spark, frame):
    findings = quality.anomalies(frame, quality.STUDENT_RANGES, as_of(), "y")
    summary = quality.anomaly_summary(findings).first()
    assert (summary["error_count"], summary["warning_count"]) == (4, 0)
    quality.gate(findings, 0)
    quality.gate(findings, 4)
    with pytest.raises(ValueError):
        quality.gate(findings, 3)


def test_clean_frame_has_no_findings(spark):
    df = spark.range(100).selectExpr("2.0 + id % 3 / 2 as hs_gpa", "1000 + id as sat_score", "id % 2 as y")
    assert quality.anomalies(df, quality.STUDENT_RANGES, as_of(), "y").count() == 0


def test_leakage_and_constants(spark):
    df = spark.range(50).selectExpr("id % 2 as y", "cast(id % 2 as double) as twin", "1.0 as steady", "-(id % 2) * 3.0 as mirror", "cast(id as double) as free")
    got = {r["feature"]: (r["identical"], r["leaks"]) for r in quality.leakage(df, "y").collect()}
    assert got == {"twin": (True, True), "steady": (False, False), "mirror": (False, True), "free": (False, False)}


def test_schema_differences_and_names(spark, frame):
    got = {r["column"]: r["status"] for r in quality.schema_differences(["id", "nope"], frame).collect()}
    assert got == {"id": "common", "nope": "missing", "hs_gpa": "extra", "sat_score": "extra", "event_date": "extra", "y": "extra"}
    assert quality.date_like_columns(["Birth_DATE", "x_dt", "dtx"]) == ["Birth_DATE", "x_dt"]


def test_distinct_counts_of_many_types(spark):
    df = spark.sql(
        """select if(id % 10 = 0, null, cast(id % 7 as int)) as i, if(id % 2 = 0, -0.0d, if(id % 3 = 0, double('NaN'), 0.0d)) as d,
                  id % 2 = 0 as b, date '2020-01-01' + cast(id % 5 as int) as day, concat('w', id % 11) as w, cast(null as string) as none,
                  cast(id % 4 as decimal(25, 2)) as big, array(if(id % 2 = 0, null, 1), 1) as a from range(200)"""
    )
    got = {r["column"]: r["distinct_count"] for r in quality.distinct_counts(df, df.columns).collect()}
    assert got == {"i": 7, "d": 2, "b": 2, "day": 5, "w": 11, "big": 4, "a": 2}


def test_distinct_counts_compile_for_forty_columns(spark):
    df = spark.range(100).repartition(2).select(*[(F.col("id") % (i + 1)).cast("double").alias(f"c{i}") for i in range(40)]).localCheckpoint()
    counts = quality.distinct_counts(df, df.columns)
    assert {r["column"]: r["distinct_count"] for r in counts.collect()} == {f"c{i}": i + 1 for i in range(40)}
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    text = counts._jdf.queryExecution().explainString(mode)
    # longer methods are interpreted
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8000
