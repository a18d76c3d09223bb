"""Queries: fitted preparation in the saved model, and requests scored as a stream into two sinks."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast.operators import boosting, fitted, learn, models, serve
from holdfast.plans.registry import query, table
from holdfast.session import fresh_path
from holdfast.streaming import jobs

UNSEEN = "5-LOW"


def raw_orders(spark, sf):
    """Orders as raw rows: text, flags, nulls, a constant and a cohort; the target is a high price."""
    orders = table(spark, sf, "orders")
    return orders.select(
        "o_orderkey",
        "o_orderpriority",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey") % 3 == 0).alias("member"),
        F.year("o_orderdate").alias("cohort_year"),
        (F.col("o_custkey") % 20).cast("double").alias("credits_attempted"),
        (F.col("o_custkey") % 13).cast("double").alias("credits_earned"),
        F.lit("main").alias("site"),
        (F.col("o_totalprice") > 150000).cast("int").alias("high"),
    )


def _seen(rows):
    # one level of the text column is left for later
    return rows.where(F.col("o_orderpriority") != UNSEEN)


def _preparation(rows):
    return fitted.Preparation(target="high", entity="o_orderkey").fit(rows)


_LEVELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")


@query(
    "prepared_features",
    f"""
    with first as (select min(year(o_orderdate)) as y from orders where o_orderpriority <> '{UNSEEN}')
    select o_orderkey, coalesce(case when o_orderkey % 7 <> 0 then o_totalprice end, -1) as price,
           coalesce(case when o_custkey % 11 <> 0 then (o_custkey % 3 = 0)::int end, 0)::double as member,
           year(o_orderdate)::double as cohort_year, (o_custkey % 20)::double as credits_attempted,
           (o_custkey % 13)::double as credits_earned,
           {', '.join(f"(o_orderpriority = '{v}')::int::double as o_orderpriority_{v.replace('-', '_').replace(' ', '_')}" for v in _LEVELS)},
           case when o_custkey % 20 > 0 then (o_custkey % 13)::double / (o_custkey % 20) else 0.0 end as credit_ratio,
           (o_custkey % 20 - o_custkey % 13)::double as credit_deficit,
           (year(o_orderdate) - y)::double as cohort_recency
    from orders, first
    """,
)
def prepared_features(spark, sf):
    """A preparation fitted on rows without one level, saved, loaded and applied to all rows."""
    rows, path = raw_orders(spark, sf), fresh_path(spark, "preparation")
    models.save_model(_preparation(_seen(rows)), path)
    model = models.load_model(fitted.PreparedFeatures, path)
    # what a batch holds beside the training columns, or in another order, does not matter
    told = model.transform(rows.drop("site", "high").select(F.lit(1).alias("extra"), "*"))
    values = vector_to_array("features")
    return told.select("o_orderkey", *[values[i].alias(c) for i, c in enumerate(model.getOrDefault("expected"))])


@query("prepared_model_round_trip", "select count(*) as rows, count(*) as equal_scores from orders")
def prepared_model_round_trip(spark, sf):
    """Preparation and classifier as one saved pipeline: raw rows score as before after loading."""
    rows, path = raw_orders(spark, sf), fresh_path(spark, "pipeline")
    training = _seen(rows)
    preparation = _preparation(training)
    classifier = LogisticRegression(labelCol="high", maxIter=20).fit(preparation.transform(training))
    pipeline = PipelineModel([preparation, classifier])
    models.save_model(pipeline, path)
    loaded = models.load_model(PipelineModel, path)
    one, two = (m.transform(rows).select("o_orderkey", vector_to_array("probability")[1].alias(n)) for m, n in ((pipeline, "p"), (loaded, "again")))
    both = one.join(two, "o_orderkey")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("p") == F.col("again")).alias("equal_scores"))


EXPECTED = ["sat_score", "hs_gpa", "credits_earned", "absent"]
#: feature, threshold, class at or below it, class above it, weight
STUMPS = [(0, 900.0, 0.0, 1.0, 1.5), (1, 2.0, 1.0, 0.0, 1.0), (2, 0.0, 0.0, 1.0, 0.5)]


def _requests(orders):
    return orders.select(
        F.col("o_custkey").cast("string").alias("student_id"),
        F.col("o_orderkey").alias("request"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.round(F.col("o_totalprice") / 70000, 2).alias("hs_gpa"),
        F.when(F.col("o_orderkey") % 9 != 0, 350 + F.col("o_orderkey") % 1290).cast("double").alias("sat_score"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") % 30 - 1).cast("double").alias("credits_earned"),
    )


def stump_model():
    """A fixed ensemble, whose scores SQL can tell."""
    columns = list(zip(*STUMPS))
    names = ("splitFeatures", "thresholds", "lefts", "rights", "alphas")
    return boosting.StumpEnsembleModel()._set(featuresCol="features", numFeatures=len(EXPECTED), **{n: list(c) for n, c in zip(names, columns)})


_REQUEST_SQL = """
    with r as (
        select o_custkey::varchar as student_id, o_orderkey as request, round(o_totalprice / 70000, 2) as gpa,
               case when o_orderkey % 9 <> 0 then (350 + o_orderkey % 1290)::double end as sat,
               case when o_orderkey % 5 <> 0 then (o_orderkey % 30 - 1)::double end as earned
        from orders),
    v as (select *, concat_ws(',', case when gpa < 0 then 'hs_gpa>=0.0' end, case when gpa > 4 then 'hs_gpa<=4.0' end,
                 case when sat < 400 then 'sat_score>=400' end, case when sat > 1600 then 'sat_score<=1600' end,
                 case when earned < 0 then 'credits_earned>=0' end) as broken from r),
    s as (select *, (1.5 * (case when coalesce(sat, -1) <= 900 then -1 else 1 end) + 1.0 * (case when coalesce(gpa, -1) <= 2 then 1 else -1 end)
                 + 0.5 * (case when coalesce(earned, -1) <= 0 then -1 else 1 end)) / 3.0 as vote from v)
    select student_id, request, case when broken = '' then 'log' else 'quarantine' end as sink, broken,
           case when broken = '' then (vote > 0)::bigint end as predicted_class,
           case when broken = '' then round_even(1 / (1 + exp(-vote)), 4) end as predicted_probability
    from s"""


@query("stream_scored_requests", _REQUEST_SQL)
def stream_scored_requests(spark, sf):
    """Raw requests as a stream: checked, completed, put in the model's order and scored, or set aside."""
    orders = table(spark, sf, "orders")
    log, aside = fresh_path(spark, "request-log"), fresh_path(spark, "request-quarantine")
    model = stump_model()

    def score(valid):
        ready = serve.request_features(valid, EXPECTED, keep=("student_id", "request", "ts"), first_cohort=2000)
        vectors = ready.select("student_id", "request", "ts", F.array(*EXPECTED).alias("vec"), *EXPECTED, F.lit(0).alias("label"))
        scored = learn.scored(model, learn.with_vectors(vectors))
        return jobs.prediction_log(scored, "student_id", ["request", *EXPECTED], "v1", "ts")

    stream = _requests(jobs.file_stream(spark, f"{sf}/orders*.parquet", orders.schema))
    jobs.score_requests(stream, score, log, aside, fresh_path(spark, "request-checkpoint"))
    logged = spark.read.parquet(log).select(
        "student_id",
        F.get_json_object("features_json", "$.request").cast("bigint").alias("request"),
        F.lit("log").alias("sink"),
        F.lit("").alias("broken"),
        "predicted_class",
        "predicted_probability",
    )
    wrong = spark.read.parquet(aside).select(
        "student_id",
        "request",
        F.lit("quarantine").alias("sink"),
        F.array_join("violations", ",").alias("broken"),
        F.lit(None).cast("bigint").alias("predicted_class"),
        F.lit(None).cast("double").alias("predicted_probability"),
    )
    return logged.unionByName(wrong)
