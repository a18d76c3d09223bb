"""Training, search, evaluation and batch scoring of binary classifiers."""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.ordered import dense_index
from holdfast.functions.scalars import hash_number
from holdfast.operators import metrics, resample
from holdfast.operators.boosting import StumpBoosting
from holdfast.operators.forest import DeepForest
from holdfast.operators.quality import col, numeric_columns
from holdfast.session import fresh_path, materialise

SEED = 42
CLASS_METADATA = {"ml_attr": {"type": "nominal", "vals": ["0", "1"], "name": "label"}}


# ---- examples and splits ----------------------------------------------------------------------


def feature_columns(df: DataFrame, target: str, entity: str) -> list[str]:
    return [c for c in numeric_columns(df, with_boolean=True) if c not in (target, entity)]


def examples(df: DataFrame, target: str, entity: str, features: Sequence[str] | None = None) -> DataFrame:
    """``id bigint, vec array<double>, label int`` and the entity.

    Whole-number entities that occur once each are the ids; otherwise rows get a dense number, since
    neighbour searches and anti-joins need one id a row.
    """
    features = list(features or feature_columns(df, target, entity))
    whole = isinstance(df.schema[entity].dataType, T.IntegralType)
    if whole and df.groupBy(col(entity)).count().where((F.col("count") > 1) | col(entity).isNull() | (col(entity) < 0)).isEmpty():
        numbered, number = df, col(entity).cast("bigint")
    else:
        needed = df.select(col(entity), col(target), *[col(c) for c in features])
        numbered, number = dense_index(materialise(needed), "_id"), F.col("_id")
    return numbered.select(
        number.alias("id"),
        col(entity).alias("entity"),
        F.array(*[F.coalesce(col(c).cast("double"), F.lit(-1.0)) for c in features]).alias("vec"),
        col(target).cast("int").alias("label"),
    )


def stratified_split(df: DataFrame, stratum: str, key: str, test_size: float = 0.2, seed: int = SEED) -> DataFrame:
    """Add ``is_test``: in every stratum the rows with the smallest hashes, ``test_size`` of them.

    Hashes are spread evenly, so counting them by their top 16 bits finds the one slice that holds
    the cut; only that slice is ordered.  Rows with the same key stay together.
    """
    hashed = df.withColumn("_h", hash_number(F.col(key), F.lit(seed))).withColumn("_slice", F.shiftright("_h", 36))
    counts = hashed.groupBy(stratum, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(stratum).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(stratum)
    wanted = F.round(F.sum("_n").over(whole) * test_size).cast("bigint")
    placed = counts.withColumn("_cum", F.sum("_n").over(upto)).withColumn("_want", wanted)
    cut = placed.where("_cum >= _want and _cum - _n < _want").select(
        stratum, F.col("_slice").alias("_cut"), (F.col("_want") - F.col("_cum") + F.col("_n")).alias("_rest")
    )
    inside = Window.partitionBy(stratum).orderBy("_h")
    edge = (
        hashed.select(stratum, "_h", "_slice")
        .join(F.broadcast(cut), stratum)  # one row per class
        .where("_slice = _cut")
        .withColumn("_rank", F.row_number().over(inside))
        .where("_rank = _rest")
        .select(stratum, F.col("_h").alias("_edge"))
    )
    return (
        hashed.join(F.broadcast(edge), stratum, "left")
        .withColumn("is_test", F.coalesce(F.col("_h") <= F.col("_edge"), F.lit(False)))
        .drop("_h", "_slice", "_edge")
    )


def fold_assignment(df: DataFrame, key: str, folds: int = 5, seed: int = SEED) -> DataFrame:
    """Add ``fold`` in 0..folds-1 from a hash of the key, independent of the label."""
    return df.withColumn("fold", (hash_number(F.col(key), F.lit(seed + 1)) % folds).cast("int"))


def with_vectors(frame: DataFrame) -> DataFrame:
    """Vector and labelled class column for the estimators."""
    return frame.withColumn("features", array_to_vector("vec")).withColumn(
        "label", F.col("label").cast("double").alias("label", metadata=CLASS_METADATA)
    )


# ---- algorithms -------------------------------------------------------------------------------


def _logistic(rows: int, **p) -> Estimator:
    strength = p.pop("C", 1.0)
    return LogisticRegression(
        maxIter=p.pop("maxIter", 1000), regParam=1.0 / (strength * max(rows, 1)), standardization=False, **p
    )


ALGORITHMS = {
    "xgboost": lambda rows, **p: GBTClassifier(**({"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "seed": SEED} | p)),
    "random_forest": lambda rows, **p: DeepForest(**({"numTrees": 100, "seed": SEED} | p)),
    "logistic_regression": _logistic,
    "adaboost": lambda rows, **p: StumpBoosting(**({"maxIter": 50, "seed": SEED} | p)),
    "decision_tree": lambda rows, **p: DecisionTreeClassifier(**({"maxDepth": 10, "seed": SEED} | p)),
    "gradient_boosting": lambda rows, **p: GBTClassifier(
        **({"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "seed": SEED} | p)
    ),
}

# Search spaces.  Parameters that the estimators here do not have are left out.
SEARCH_SPACES = {
    "xgboost": {
        "maxIter": [50, 100, 200, 300],
        "maxDepth": [3, 4, 5, 6, 8, 10],
        "stepSize": [0.01, 0.05, 0.1, 0.2],
        "subsamplingRate": [0.6, 0.7, 0.8, 0.9, 1.0],
        "featureSubsetStrategy": ["0.6", "0.7", "0.8", "0.9", "all"],
    },
    "random_forest": {
        "numTrees": [50, 100, 200, 300],
        "maxDepth": [5, 10, 15, 20, 0],
        "minInstancesPerNode": [1, 2, 4],
        "featureSubsetStrategy": ["sqrt", "log2", "all"],
    },
    "logistic_regression": {
        "C": [0.01, 0.1, 1.0, 10.0, 100.0],
        "elasticNetParam": [1.0, 0.0],
        "maxIter": [500, 1000, 2000],
    },
    "gradient_boosting": {
        "maxIter": [50, 100, 200],
        "maxDepth": [3, 4, 5, 6],
        "stepSize": [0.01, 0.05, 0.1, 0.2],
        "subsamplingRate": [0.6, 0.7, 0.8, 0.9, 1.0],
    },
    "adaboost": {
        "maxIter": [25, 50, 100, 200],
        "stepSize": [0.01, 0.05, 0.1, 0.5, 1.0],
    },
    "decision_tree": {
        "maxDepth": [3, 5, 7, 10, 15, 20, 30],
        "minInstancesPerNode": [1, 2, 4, 8],
        "impurity": ["gini", "entropy"],
    },
}


def estimator(name: str, rows: int, **params) -> Estimator:
    if name not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {name!r}")
    return ALGORITHMS[name](rows, **params)


# ---- training and evaluation ------------------------------------------------------------------


def scored(model: Model, frame: DataFrame) -> DataFrame:
    """Rows with ``predicted_class`` and ``predicted_probability`` of class 1."""
    out = model.transform(frame if "features" in frame.columns else with_vectors(frame))
    return out.withColumn("predicted_class", F.col("prediction").cast("int")).withColumn(
        "predicted_probability", vector_to_array("probability")[1]
    )


def evaluate(models: dict[str, Model], frame: DataFrame) -> DataFrame:
    """One row of metrics per model; every model scores the frame once."""
    parts = None
    for name, model in models.items():
        part = scored(model, frame).select(
            F.lit(name).alias("model"), F.col("label").cast("int").alias("label"), "predicted_class", "predicted_probability"
        )
        parts = part if parts is None else parts.unionByName(part)
    parts = materialise(parts)  # scoring is the costly step and several aggregates follow
    rates = metrics.class_metrics(parts, "label", "predicted_class", ["model"])
    area = metrics.roc_auc(parts, "label", "predicted_probability", ["model"])
    return rates.join(area, "model").withColumn("auc", F.coalesce("auc", F.lit(0.0)))


def spread(frame: DataFrame) -> DataFrame:
    """At least one partition per core for the many passes of a fit; larger frames stay as they are."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= cores else frame.repartition(cores)


def train(
    frame: DataFrame,
    algorithms: Sequence[str] = tuple(ALGORITHMS),
    strategies: Sequence[str] = ("none", "smote"),
    test_size: float = 0.2,
    metric: str = "tn_rate",
    params: dict[str, dict] | None = None,
    parallelism: int = 6,
) -> tuple[DataFrame, dict[str, Model], DataFrame]:
    """Fit every algorithm on every resampled training split and rank them on the test split.

    ``parallelism`` fits run at once on one training split: the many short passes of one leave cores idle.
    Returns the ranked results, the models by ``<algorithm>_<strategy>`` and the split frame.
    """
    metrics.check_metric(metric)
    for name in algorithms:
        estimator(name, 1)
    for name in strategies:
        resample.strategy(name)
    # rows without a label teach nothing and cannot be tested; the split reads its input several times
    labelled = materialise(frame.where(F.col("label").isNotNull()))
    split = materialise(stratified_split(labelled, "label", "id", test_size))
    training, test = split.where(~F.col("is_test")), split.where("is_test")
    models: dict[str, Model] = {}
    runs = []
    for strategy in strategies:
        balance = resample.strategy(strategy)
        status, rows = "ok", training.select("id", "vec", "label")
        if balance is not None:
            try:
                rows = materialise(balance(rows))
            except resample.ResampleError as problem:
                status = f"skipped: {problem}"
        ready = spread(with_vectors(rows).select("features", "label")).persist()
        try:
            n = ready.count()

            def fit(algorithm: str) -> Model:
                return estimator(algorithm, n, **(params or {}).get(algorithm, {})).fit(ready)

            with ThreadPoolExecutor(max(1, parallelism)) as pool:
                fitted = list(pool.map(inheritable_thread_target(frame.sparkSession)(fit), algorithms))
            for algorithm, model in zip(algorithms, fitted):
                name = f"{algorithm}_{strategy}"
                models[name] = model
                runs.append((name, algorithm, strategy, status, n, len(runs)))
        finally:
            ready.unpersist()
    described = frame.sparkSession.createDataFrame(
        runs, "model string, algorithm string, smote_strategy string, resample_status string, train_rows bigint, seq int"
    )
    results = described.join(evaluate(models, test), "model")
    return metrics.rank_models(results, metric), models, split


def sample_settings(algorithm: str, n: int = 20, seed: int = SEED) -> list[dict]:
    """Up to ``n`` distinct settings drawn from the algorithm's search space."""
    if algorithm not in SEARCH_SPACES:
        raise ValueError(f"unknown algorithm {algorithm!r}")
    space = SEARCH_SPACES[algorithm]
    settings = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return random.Random(seed).sample(settings, min(n, len(settings)))


def search(
    training: DataFrame,
    algorithm: str,
    n_iter: int = 20,
    folds: int = 5,
    settings: Sequence[dict] | None = None,
    parallelism: int = 8,
) -> tuple[Model, DataFrame]:
    """Cross-validated random search by area under the curve; the best setting is fitted again on all
    training rows.  Returns the model and one row per setting."""
    settings = list(settings or sample_settings(algorithm, n_iter))
    ready = materialise(fold_assignment(with_vectors(training), "id", folds).select("id", "features", "label", "fold"))
    rows = ready.count()
    base = estimator(algorithm, rows)
    grid = []
    for setting in settings:
        candidate = estimator(algorithm, rows, **setting)
        grid.append({base.getParam(p.name): candidate.getOrDefault(p) for p in candidate.params if candidate.isSet(p)})
    validator = CrossValidator(
        estimator=base,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label", numBins=0),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=SEED,
    )
    if algorithm == "decision_tree":
        areas = _tree_areas(ready, settings, folds, validator.getEvaluator(), rows, parallelism)
        best = estimator(algorithm, rows, **settings[int(np.argmax(areas))]).fit(ready)
    else:
        fitted = validator.fit(ready)
        areas, best = fitted.avgMetrics, fitted.bestModel
    table = training.sparkSession.createDataFrame(
        [(algorithm, i, str(sorted(s.items())), float(a)) for i, (s, a) in enumerate(zip(settings, areas))],
        "algorithm string, setting int, params string, mean_auc double",
    )
    return best, table


def _tree_areas(ready: DataFrame, settings: Sequence[dict], folds: int, evaluator, rows: int, parallelism: int) -> np.ndarray:
    """The mean area of each setting over the folds.

    Single trees grow level by level and draw nothing, so those that differ in depth only are one tree cut off
    at several depths: it is fitted once a fold, to the greatest depth, and scores its fold at all of them.
    """
    alike: dict[tuple, list[int]] = {}
    for i, setting in enumerate(settings):
        alike.setdefault(tuple(sorted((k, str(v)) for k, v in setting.items() if k != "maxDepth")), []).append(i)
    depths = [estimator("decision_tree", rows, **s).getOrDefault("maxDepth") for s in settings]
    groups = sorted(alike.values(), key=lambda g: -max(depths[i] for i in g))
    ready = ready.persist()

    def fit(task: tuple[int, list[int]]) -> list[tuple[int, int, float]]:
        fold, group = task
        train, held = ready.where(F.col("fold") != fold), ready.where(F.col("fold") == fold)
        if train.isEmpty() or held.isEmpty():
            raise ValueError(f"no rows to train on or to score in fold {fold}")
        model = estimator("decision_tree", rows, **settings[max(group, key=lambda i: depths[i])]).fit(train)
        wanted = sorted({depths[i] for i in group})
        told = _scored_at_depths(model, held, wanted).persist()
        try:
            area = {d: evaluator.evaluate(told.select("label", F.col("shares")[j].alias("probability"))) for j, d in enumerate(wanted)}
        finally:
            told.unpersist()
        return [(i, fold, area[depths[i]]) for i in group]

    areas = np.zeros((folds, len(settings)))
    try:
        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            tasks = [(fold, group) for group in groups for fold in range(folds)]
            for found in pool.map(inheritable_thread_target(ready.sparkSession)(fit), tasks):
                for i, fold, area in found:
                    areas[fold, i] = area
    finally:
        ready.unpersist()
    return np.mean(areas, axis=0)


def _stops(left: np.ndarray, right: np.ndarray, says: np.ndarray, depths: Sequence[int]) -> list[np.ndarray]:
    """For each depth, which nodes end a row's way: leaves there, and nodes below which all leaves say the same class,
    as the estimator leaves those out."""
    levels = [np.zeros(1, np.int64)]
    while len(inner := levels[-1][left[levels[-1]] >= 0]):
        levels.append(np.concatenate([left[inner], right[inner]]))
    out = []
    for depth in depths:
        stop = left < 0
        for nodes in levels[depth : depth + 1]:
            stop[nodes] = True
        for nodes in levels[:depth][::-1]:
            inner = nodes[left[nodes] >= 0]
            a, b = left[inner], right[inner]
            stop[inner] = stop[a] & stop[b] & (says[a] == says[b])
        out.append(stop)
    return out


def _scored_at_depths(model: Model, frame: DataFrame, depths: Sequence[int]) -> DataFrame:
    """Label and ``shares``: the probability of class 1 by the tree cut off at each depth (ascending)."""
    path = fresh_path(frame.sparkSession, "tree")
    model.write().save(path)
    nodes = frame.sparkSession.read.parquet(f"{path}/data").orderBy("id").select(
        "leftChild", "rightChild", F.col("split.featureIndex").alias("feature"), F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("cut"),
        (F.col("impurityStats")[1] / F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b)).alias("share"), "prediction",
    )
    # as many rows as the fitted model has nodes in the driver
    tree = nodes.toArrow()
    left, right, feature, cut, share, says = (tree[c].fill_null(0).to_numpy() for c in tree.column_names)
    sent = frame.sparkSession.sparkContext.broadcast((left, right, feature, cut, share, _stops(left, right, says, depths)))

    @F.pandas_udf("array<double>")
    def shares(features: pd.Series) -> pd.Series:
        left, right, feature, cut, share, stops = sent.value
        if not len(features):
            return pd.Series([], dtype="object")
        x = np.stack(features.to_list())
        at, out = np.zeros(len(x), np.int64), np.empty((len(x), len(stops)))
        for j, stop in enumerate(stops):
            # a deeper tree's leaf lies at or below that of one cut off earlier
            going = np.flatnonzero(~stop[at])
            while len(going):
                here = at[going]
                at[going] = np.where(x[going, feature[here]] <= cut[here], left[here], right[here])
                going = going[~stop[at[going]]]
            out[:, j] = share[at]
        return pd.Series(list(out))

    return frame.select("label", shares(vector_to_array("features")).alias("shares"))


def batch_predictions(model: Model, frame: DataFrame, version: str = "v1_local") -> DataFrame:
    """Entity, class, probability (4 digits, half even), version and the known class."""
    return scored(model, frame).select(
        F.col("entity" if "entity" in frame.columns else "id").cast("string").alias("student_id"),
        "predicted_class",
        F.bround("predicted_probability", 4).alias("predicted_probability"),
        F.lit(version).alias("model_version"),
        F.col("label").cast("int").alias("actual_class"),
    )
