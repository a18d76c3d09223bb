"""Binary classification metrics, ranking and prediction summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.ordered import exact_quantiles, running_totals
from holdfast.operators.quality import col

METRICS = ("accuracy", "auc", "precision", "recall", "f1", "tp_rate", "tn_rate")


def _counts(df: DataFrame, label: str, predicted: str, by: Sequence[str]) -> DataFrame:
    y, z = col(label).cast("int"), col(predicted).cast("int")
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (z == 0)).alias("_tn"),
        F.count_if((y == 0) & (z == 1)).alias("_fp"),
        F.count_if((y == 1) & (z == 0)).alias("_fn"),
        F.count_if((y == 1) & (z == 1)).alias("_tp"),
    )


def _cells() -> list[Column]:
    """The matrix, reading zero where labels and predictions together show only one class."""
    both_classes = F.col("_fp") + F.col("_fn") + F.least("_tn", "_tp") > 0
    return [F.when(both_classes, F.col(f"_{c}")).otherwise(0).alias(c) for c in ("tn", "fp", "fn", "tp")]


def confusion(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp; all zero when labels and predictions together show only one class."""
    return _counts(df, label, predicted, by).select(*by, *_cells())


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def class_metrics(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts with accuracy, precision, recall, F1, true positive and negative rate."""
    table = _counts(df, label, predicted, by).select("*", *_cells())
    tn, fp, fn, tp = (F.col(f"_{c}") for c in ("tn", "fp", "fn", "tp"))
    return table.select(
        *by,
        "tn",
        "fp",
        "fn",
        "tp",
        _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("tp_rate"),
        _ratio(F.col("tn"), F.col("tn") + F.col("fp")).alias("tn_rate"),
    )


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the curve, ties counted half; NULL when only one class is present."""
    counted = df.select(
        *by,
        col(score).cast("double").alias("_score"),
        (col(label) == 1).cast("bigint").alias("_pos"),
        (col(label) == 0).cast("bigint").alias("_neg"),
    )
    running = running_totals(counted, list(by), "_score", ["_pos", "_neg"])
    below = F.col("cum__neg") - F.col("_neg")
    area = F.sum(F.col("_pos") * (below + F.col("_neg") / 2.0))
    return (
        running.groupBy(*by)
        .agg(area.alias("_area"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
        .select(*by, F.try_divide(F.col("_area"), F.col("_p").cast("double") * F.col("_n")).alias("auc"))
    )


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; one of {', '.join(METRICS)}")
    return metric


def rank_models(results: DataFrame, metric: str, order: str = "seq") -> DataFrame:
    """1-based rank by descending metric, ties in order of ``order``; one row per model."""
    check_metric(metric)
    place = Window.orderBy(F.col(metric).desc_nulls_last(), F.col(order))
    return results.withColumn("rank", F.row_number().over(place))


def winner(results: DataFrame, metric: str, order: str = "seq") -> DataFrame:
    check_metric(metric)
    return results.orderBy(F.col(metric).desc_nulls_last(), F.col(order)).limit(1)


def prediction_summary(
    df: DataFrame, predicted: str = "predicted_class", probability: str = "predicted_probability", actual: str | None = None
) -> DataFrame:
    """Counts per class, mean and exact median probability, and accuracy and AUC where the class is known."""
    z = col(predicted)
    aggs = [
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(z == 1).alias("predicted_retained"),
        F.count_if(z == 0).alias("predicted_not_retained"),
        F.avg(col(probability)).alias("mean_probability"),
    ]
    if actual is not None:
        aggs.append(F.avg((z.cast("int") == col(actual).cast("int")).cast("double")).alias("batch_accuracy"))
    out = df.agg(*aggs).withColumn(
        "median_probability", exact_quantiles(df, [], probability, {"median": 0.5}).scalar()
    )
    return out if actual is None else out.withColumn("batch_auc", roc_auc(df, actual, probability).scalar())


def group_rates(df: DataFrame, group: str, predicted: str, reference) -> DataFrame:
    """Share predicted positive per group and its ratio to the reference group's share."""
    rates = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(col(predicted).cast("double")).alias("positive_rate")
    )
    base = rates.where(F.col(group) == reference).select("positive_rate").scalar()
    return rates.withColumn("impact_ratio", F.try_divide(F.col("positive_rate"), base))
