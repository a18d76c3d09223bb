"""Queries: splits, resampling, training, search, scoring, importances, registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import explain, learn, metrics, models, projections, resample
from holdfast.plans.registry import query, table

FEATURES = ["lines", "quantity", "price", "discount", "tax", "balance"]


def order_examples(spark, sf):
    """Orders as entities: features from their lines and customer; the label says whether any line
    was returned, so about a quarter of the rows are class 0."""
    lines = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.avg("l_quantity").alias("quantity"),
            (F.sum("l_extendedprice") / 10000).alias("price"),
            (F.avg("l_discount") * 100).alias("discount"),
            (F.avg("l_tax") * 100).alias("tax"),
            F.max((F.col("l_returnflag") == "R").cast("int")).alias("returned"),
        )
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") / 1000).alias("balance"))
    frame = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customer, F.col("o_custkey") == F.col("c_custkey")
    )
    # sums of doubles depend on the order of rows; rounding keeps reruns alike
    rounded = frame.select(
        F.col("l_orderkey").alias("orderkey"), "returned", *[F.round(c, 4).alias(c) for c in FEATURES]
    )
    return learn.examples(rounded, "returned", "orderkey", FEATURES)


LABELS_SQL = """
    labels_ as (
        select l_orderkey as id, max((l_returnflag = 'R')::int) as label
        from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
        group by 1
    )
"""


@query(
    "stratified_split",
    f"with {LABELS_SQL} select label, count(*) as n, round(count(*) * 0.2)::bigint as n_test from labels_ group by 1",
)
def stratified_split(spark, sf):
    split = learn.stratified_split(order_examples(spark, sf).select("id", "label"), "label", "id")
    return split.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test"))


def _draw(key: str, seed: int) -> str:
    """SQL for the draw that ``hash_number`` makes of a key and a seed."""
    return f"('0x' || substr(md5({key}::varchar || '|{seed}'), 1, 13))::bigint"


@query(
    "stratified_rows",
    f"""
    with {LABELS_SQL}
    select id, label, row_number() over (partition by label order by {_draw("id", 42)})
                      <= round(count(*) over (partition by label) * 0.2) as is_test
    from labels_
    """,
)
def stratified_rows(spark, sf):
    """Which rows are kept for testing."""
    return learn.stratified_split(order_examples(spark, sf).select("id", "label"), "label", "id").select("id", "label", "is_test")


@query(
    "fold_assignment",
    f"""
    with {LABELS_SQL}, f as (select label, ({_draw("id", 43)} % 5)::int as fold from labels_)
    select fold, count(*) as n, round(avg(label), 4) as class_share from f group by 1
    """,
)
def fold_assignment(spark, sf):
    folds = learn.fold_assignment(order_examples(spark, sf).select("id", "label"), "id")
    return folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("label"), 4).alias("class_share"))


@query(
    "smote_counts",
    f"""
    with {LABELS_SQL}, c as (select label, count(*) as n from labels_ group by 1)
    select label, (select max(n) from c) as n, (select max(n) from c) - n as synthetic from c
    """,
)
def smote_counts(spark, sf):
    """Class sizes after oversampling to parity."""
    return resample.smote(order_examples(spark, sf)).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") < 0).alias("synthetic")
    )


@query(
    "wide_neighbours",
    """
    with v as (select vec_id, embedding::double[] as vec from embeddings where embedding is not null),
    d as (
        select a.vec_id as id, b.vec_id as neighbour, list_distance(a.vec, b.vec) as distance
        from v a join v b on a.vec_id <> b.vec_id
    ),
    r as (select *, row_number() over (partition by id order by distance, neighbour) as rank from d)
    select id, rank, neighbour, round(distance, 6) as distance from r where rank <= 5
    """,
)
def wide_neighbours(spark, sf):
    """The five nearest vectors of every embedding, by projection trees."""
    vectors = table(spark, sf, "embeddings").where("embedding is not null").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), F.coalesce("label", F.lit(-1)).alias("label")
    )
    near, _ = projections.projected_neighbours(vectors, vectors, 5, vectors=False)
    return near.select("id", "rank", "neighbour", F.round("distance", 6).alias("distance"))


def _class_summary(frame):
    return frame.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("id") < 0).alias("synthetic"),
        F.round(F.avg(F.col("vec")[0]), 4).alias("mean_lines"),
    )


@query("smote")
def smote(spark, sf):
    return _class_summary(resample.smote(order_examples(spark, sf)))


@query("adasyn")
def adasyn(spark, sf):
    return _class_summary(resample.adasyn(order_examples(spark, sf)))


@query("tomek")
def tomek(spark, sf):
    return _class_summary(resample.remove_tomek_links(order_examples(spark, sf)))


@query("enn")
def enn(spark, sf):
    return _class_summary(resample.edited(order_examples(spark, sf)))


@query("smotetomek")
def smotetomek(spark, sf):
    return _class_summary(resample.smote_tomek(order_examples(spark, sf)))


@query("smoteenn")
def smoteenn(spark, sf):
    return _class_summary(resample.smote_enn(order_examples(spark, sf)))


_COMPARED = ["model", "rank", "train_rows", "resample_status", "accuracy", "auc", "f1", "tn_rate", "tp_rate"]


@query("train_compete")
def train_compete(spark, sf):
    """All algorithms on the plain and on the balanced training split."""
    results, _, _ = learn.train(order_examples(spark, sf), list(learn.ALGORITHMS), ["none", "smote"])
    return results.select(*_COMPARED)


@query("adaboost")
def adaboost(spark, sf):
    results, _, _ = learn.train(order_examples(spark, sf), ["adaboost"], ["none"])
    return results.select(*_COMPARED)


@query("boosted_trees")
def boosted_trees(spark, sf):
    results, _, _ = learn.train(order_examples(spark, sf), ["gradient_boosting"], ["none"])
    return results.select(*_COMPARED)


@query("deep_boosted_trees")
def deep_boosted_trees(spark, sf):
    """The boosted trees of depth six."""
    results, _, _ = learn.train(order_examples(spark, sf), ["xgboost"], ["none"])
    return results.select(*_COMPARED)


@query("search")
def search(spark, sf):
    split = learn.stratified_split(order_examples(spark, sf), "label", "id")
    _, tried = learn.search(split.where(~F.col("is_test")), "decision_tree")
    return tried


def _linear(spark, sf):
    results, fitted, split = learn.train(order_examples(spark, sf), ["logistic_regression"], ["none"])
    return results, fitted["logistic_regression_none"], split


@query("evaluate_rank")
def evaluate_rank(spark, sf):
    """All models scored again on all rows, and ranked."""
    _, fitted, split = learn.train(order_examples(spark, sf), ["logistic_regression", "decision_tree"], ["none"])
    return metrics.rank_models(learn.evaluate(fitted, split), "tn_rate", "model").select(
        "model", "rank", "tn", "fp", "fn", "tp", "accuracy", "auc", "tn_rate"
    )


@query("batch_score")
def batch_score(spark, sf):
    _, model, split = _linear(spark, sf)
    return learn.batch_predictions(model, split)


@query("native_importance")
def native_importance(spark, sf):
    _, model, split = _linear(spark, sf)
    return explain.native_importance(model, FEATURES, split)


@query("permutation_importance")
def permutation_importance(spark, sf):
    _, model, split = _linear(spark, sf)
    return explain.ranked_importance(
        explain.native_importance(model, FEATURES, split), explain.permutation_importance(model, split, FEATURES)
    )


@query("shapley")
def shapley(spark, sf):
    _, model, split = _linear(spark, sf)
    return explain.sampled_shapley(model, split, FEATURES)


@query("registry_manifest")
def registry_manifest(spark, sf):
    results, model, split = _linear(spark, sf)
    importance = explain.ranked_importance(
        explain.native_importance(model, FEATURES, split), explain.permutation_importance(model, split, FEATURES)
    )
    return models.manifest(
        metrics.winner(results, "tn_rate"), importance, "models/logistic_regression", registered_at="2024-01-31 00:00:00"
    ).select("model_display_name", "version", "algorithm", "smote_strategy", "metrics", "top_features", "model_card")


@query("experiment_log")
def experiment_log(spark, sf):
    results, _, _ = learn.train(order_examples(spark, sf), ["logistic_regression", "decision_tree"], ["none"])
    return models.experiment_log(results)
