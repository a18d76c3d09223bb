"""Model artifacts, registry manifest, model card and experiment log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.util import MLReadable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.scalars import version_label

SCORES = ("accuracy", "auc", "tp_rate", "tn_rate", "f1")


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(kind: type[MLReadable], path: str) -> Model:
    return kind.load(path)


def manifest(
    winner: DataFrame,
    importance: DataFrame,
    artifact: str,
    name: str = "retention-classifier",
    description: str = "Second-year retention classifier",
    registered_at: str | None = None,
) -> DataFrame:
    """One row per registered version: metrics, top features, lineage and card.

    ``winner`` is the one ranked row that won; ``importance`` the ranked importances.
    """
    stamp = F.lit(registered_at).cast("timestamp") if registered_at else F.current_timestamp()

    def top(n: int):
        first = importance.orderBy(F.col("importance").desc(), "feature").limit(n)
        gathered = F.array_sort(
            F.collect_list(F.struct((-F.col("importance")).alias("order"), "feature"))
        )  # n rows
        return first.agg(F.transform(gathered, lambda s: s["feature"])).scalar()

    total = importance.agg(F.count(F.lit(1))).scalar()
    row = (
        winner.withColumn("registered_at", stamp)
        .withColumn("version", version_label(F.col("registered_at")))
        .withColumn("metrics", F.struct(*SCORES))
        .withColumn("top_features", top(5))
        .withColumn("card_features", top(10))
        .withColumn("total_features", total)
    )
    card = F.struct(
        F.concat_ws(" ", F.lit(name), "version").alias("title"),
        F.lit(description).alias("purpose"),
        F.concat_ws(" after ", F.col("algorithm"), F.concat("smote_strategy", F.lit(" resampling"))).alias("fitted_by"),
        F.struct("train_rows", "total_features").alias("learned_from"),
        F.struct("metrics", F.lit("rows kept out of training").alias("measured_on")).alias("scores"),
        F.col("card_features").alias("leading_features"),
    )
    return row.select(
        F.lit(name).alias("model_display_name"),
        F.lit(description).alias("model_description"),
        "version",
        "algorithm",
        "smote_strategy",
        "registered_at",
        F.lit(artifact).alias("artifact_path"),
        "metrics",
        "top_features",
        F.to_json(card).alias("model_card"),
    )


def register(row: DataFrame, path: str) -> None:
    """Append one version to the registry table."""
    row.write.mode("append").parquet(path)


def experiment_log(results: DataFrame) -> DataFrame:
    """One row per run with its parameters and metrics."""
    return results.select(
        F.concat_ws("_", "algorithm", "smote_strategy").alias("run_name"),
        F.struct("algorithm", "smote_strategy").alias("params"),
        F.struct(*SCORES).alias("metrics"),
    )


def with_tuned(results: DataFrame, tuned: DataFrame) -> DataFrame:
    """Results with the tuned model's row appended; absent columns stay NULL."""
    return results.unionByName(tuned, allowMissingColumns=True)


def latest_versions(registry: DataFrame, columns: Sequence[str] = ("version", "algorithm", "artifact_path")) -> DataFrame:
    return registry.groupBy("model_display_name").agg(
        F.max_by(F.struct(*columns), "registered_at").alias("_m")
    ).select("model_display_name", "_m.*")
