"""Fitted preparation in saved models, and requests scored into two sinks."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast.operators import fitted, models
from holdfast.session import fresh_path
from holdfast.streaming import jobs

SCHEMA = "student_id long, cohort_year int, hs_gpa double, cumulative_gpa double, state string, pell boolean, same string, second_year_ret_flag int"


def training(spark):
    rows = [(i, 2018 + i % 4, 2.0 + i % 3 / 2 if i % 9 else None, 1.0 + i % 5 / 2, "NY" if i % 2 else "CA", bool(i % 3), "x", int(i % 5 > 1)) for i in range(120)]
    return spark.createDataFrame(rows, SCHEMA)


def vectors(model, rows):
    return {r["student_id"]: r["v"] for r in model.transform(rows).select("student_id", vector_to_array("features").alias("v")).collect()}


def test_fitted_preparation_does_not_follow_the_batch(spark, tmp_path):
    rows = training(spark)
    model = fitted.Preparation().fit(rows)
    names = model.getOrDefault("expected")
    assert "same" not in names and {"state_CA", "state_NY", "cohort_recency", "gpa_change", "pell"} <= set(names)
    whole = vectors(model, rows)
    # one row at a time: levels, the first cohort and constants are those of training
    assert vectors(model, rows.where("student_id = 7")) == {7: whole[7]}
    assert dict(zip(names, whole[7]))["cohort_recency"] == 3
    # an unseen level, a missing column, a value of another type, an extra column, another order
    odd = spark.createDataFrame([("ZZ", "no number", 5, 2020)], "state string, hs_gpa string, student_id long, cohort_year int").withColumn("extra", F.lit(1))
    got = dict(zip(names, vectors(model, odd)[5]))
    assert (got["state_CA"], got["state_NY"], got["hs_gpa"], got["cumulative_gpa"], got["pell"], got["cohort_recency"]) == (0, 0, -1, -1, 0, 2)
    models.save_model(model, str(tmp_path / "p"))
    assert vectors(models.load_model(fitted.PreparedFeatures, str(tmp_path / "p")), rows) == whole


def test_one_pipeline_takes_raw_rows(spark, tmp_path):
    rows = training(spark)
    preparation = fitted.Preparation().fit(rows)
    classifier = LogisticRegression(labelCol="second_year_ret_flag", maxIter=5).fit(preparation.transform(rows))
    whole = PipelineModel([preparation, classifier])
    models.save_model(whole, str(tmp_path / "m"))
    loaded = models.load_model(PipelineModel, str(tmp_path / "m"))
    one, two = ([(r["student_id"], r["probability"]) for r in m.transform(rows.drop("second_year_ret_flag")).orderBy("student_id").collect()] for m in (whole, loaded))
    assert one == two and len(one) == 120


def test_a_repeated_batch_changes_neither_sink(spark):
    path, log, aside, checkpoint = (fresh_path(spark, n) for n in ("in", "log", "aside", "cp"))
    spark.range(40).selectExpr("cast(id as string) as student_id", "cast(id as double) / 8 as hs_gpa").repartition(2).write.parquet(path)
    schema = spark.read.parquet(path).schema
    stops = [True]

    def score(valid):
        if stops:
            stops.pop()
            raise RuntimeError("lost between the two sinks")
        return valid.select("student_id", (F.col("hs_gpa") > 2).cast("int").alias("predicted_class"))

    def run():
        jobs.score_requests(jobs.file_stream(spark, path, schema, 1), score, log, aside, checkpoint)

    with pytest.raises(Exception, match="lost between"):
        run()
    assert spark.read.parquet(aside).count() > 0
    run()
    right, wrong = spark.read.parquet(log), spark.read.parquet(aside)
    assert sorted(int(r[0]) for r in right.select("student_id").collect()) == list(range(33))
    assert sorted(int(r[0]) for r in wrong.select("student_id").collect()) == list(range(33, 40))
    assert {tuple(r["violations"]) for r in wrong.collect()} == {("hs_gpa<=4.0",)}
    run()
    assert right.count() + wrong.count() == 40
