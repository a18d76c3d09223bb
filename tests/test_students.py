"""The preparation run from source tables to the reduced frame."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.operators import learn, relate
from holdfast.plans import students


@pytest.fixture(scope="module")
def tables(spark, sf):
    return students.derived_tables(spark, sf)


@pytest.fixture(scope="module")
def run(tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stages"))
    return students.prepare(tables, as_of=F.lit("2026-01-01"), folder=folder), folder


def test_keys_of_derived_tables(tables):
    demo = tables["demographics"]
    assert relate.duplicate_keys(demo, "student_id").count() == 0
    for name in ("academic_records", "financial_aid", "enrollment_events"):
        assert relate.orphans(tables[name], "student_id", demo, "student_id").count() == 0


def test_one_row_per_enrolment(run, tables):
    merged = run[0].frames["ingest"]
    assert len(merged.columns) == 48
    assert {"term_acad", "campus_acad"} <= set(merged.columns)
    assert merged.count() == tables["enrollment_events"].where("event_type = 'enrollment'").count()
    assert merged.select("student_id").distinct().count() == merged.count()


def test_reports(run):
    reports = run[0].reports
    kinds = {(r["type"], r["column"]) for r in reports["anomalies"].collect()}
    assert ("out_of_range", "sat_score") in kinds and ("future_date", "event_date") in kinds and ("null_values", "hs_gpa") in kinds
    found = {r["info_type"] for r in reports["personal_data"].collect()}
    assert {"PERSON_NAME", "US_SOCIAL_SECURITY_NUMBER_in_notes", "PHONE_NUMBER_in_address_line2"} <= found
    assert reports["profile"].count() == 48


def test_harmonised_has_no_nulls(run):
    frame = run[0].frames["harmonise"]
    dates = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.DateType)]
    rest = [c for c in frame.columns if c not in dates]
    assert frame.where(" or ".join(f"`{c}` is null" for c in rest)).count() == 0
    assert frame.where("notes like '%SSN%[US_SOCIAL_SECURITY_NUMBER]%' or notes = 'unknown'").count() == frame.count()


def test_features_and_export(run):
    features, export = run[0].frames["features"], run[0].frames["export"]
    assert {"gpa_change", "distance_bin", "cohort_recency", "test_score_composite"} <= set(features.columns)
    assert export.count() == features.count() and len(export.columns) == 22
    ok = {"string": 1}
    assert [f.name for f in features.schema.fields if f.dataType.typeName() in ok] == ["student_id"]


def test_reduced_keeps_id_target_and_fewer_columns(run):
    reduced, features = run[0].frames["reduced"], run[0].frames["features"]
    assert reduced.columns[:2] == ["student_id", "second_year_ret_flag"]
    assert 4 < len(reduced.columns) < len(features.columns)
    outcomes = {r["outcome"] for r in run[0].reports["reduce"].collect()}
    assert outcomes <= {"kept", "target_correlation", "pair_correlation", "vif"}


def test_stage_files_can_be_read(spark, run):
    _, folder = run
    assert spark.read.parquet(f"{folder}/06_features.parquet").count() == run[0].frames["features"].count()


def test_gates_stop_the_run(tables):
    with pytest.raises(ValueError, match="validation errors"):
        students.prepare(tables, as_of=F.lit("2026-01-01"), anomaly_threshold=1)
    with pytest.raises(ValueError, match="density"):
        students.prepare(tables, as_of=F.lit("2026-01-01"), pii_threshold=0.05)


def test_a_missing_table_is_skipped(tables):
    merged = relate.merge_students({k: v for k, v in tables.items() if k != "financial_aid"})
    assert "efc" not in merged.columns and "term_acad" in merged.columns


def test_training_on_the_reduced_frame(run):
    frame = learn.examples(run[0].frames["reduced"], "second_year_ret_flag", "student_id")
    results, _, _ = learn.train(frame, ["logistic_regression"], ["none"], metric="auc")
    assert results.first()["accuracy"] > 0.4
