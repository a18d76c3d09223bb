import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from holdfast.operators import explain, learn, metrics, models
from holdfast.operators.boosting import StumpBoosting, StumpEnsembleModel
from holdfast.session import fresh_path, materialise


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 3)).round(3)
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 0.5, 400) > -0.8).astype(int)
    rows = [(i, f"s{i}", [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))]
    return materialise(spark.createDataFrame(rows, "id bigint, entity string, vec array<double>, label int"))


@pytest.fixture(scope="module")
def trained(frame):
    return learn.train(frame, ["logistic_regression", "decision_tree"], ["none", "smote"])


def test_split_is_exact_and_repeatable(frame):
    split = learn.stratified_split(frame, "label", "id", 0.2)
    counts = {r["label"]: (r["n"], r["t"]) for r in split.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert all(t == round(n * 0.2) for n, t in counts.values())
    again = learn.stratified_split(frame.repartition(3), "label", "id", 0.2)
    assert split.where("is_test").select("id").exceptAll(again.where("is_test").select("id")).count() == 0
    assert learn.stratified_split(frame, "label", "id", 0.0).where("is_test").count() == 0


def test_folds_cover_all_rows(frame):
    sizes = [r["count"] for r in learn.fold_assignment(frame, "id", 5).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and sum(sizes) == 400 and min(sizes) > 50


def test_competition(trained):
    results, fitted, split = trained
    rows = results.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2, 3, 4] and set(fitted) == {r["model"] for r in rows}
    assert [r["tn_rate"] for r in rows] == sorted((r["tn_rate"] for r in rows), reverse=True)
    assert all(0.5 < r["auc"] <= 1 and r["accuracy"] > 0.4 for r in rows)
    plain = {r["smote_strategy"]: r["train_rows"] for r in rows}
    assert plain["smote"] > plain["none"] == split.where("not is_test").count()


def test_failed_resampling_is_recorded(spark):
    rows = [(i, [float(i)], int(i >= 4)) for i in range(60)]
    tiny = spark.createDataFrame(rows, "id bigint, vec array<double>, label int")
    results, _, _ = learn.train(tiny, ["decision_tree"], ["smote"])
    assert results.first()["resample_status"].startswith("skipped")


def test_unknown_names(frame):
    with pytest.raises(ValueError):
        learn.train(frame, ["perceptron"])
    with pytest.raises(ValueError):
        learn.train(frame, ["decision_tree"], ["undersample"])
    with pytest.raises(ValueError):
        learn.train(frame, ["decision_tree"], metric="tn")
    with pytest.raises(ValueError):
        learn.sample_settings("svm")


def samme(x, y, rounds):
    """Plain re-statement: best Gini stump on weighted rows, votes by log odds of the error."""
    w = np.ones(len(y)) / len(y)
    vote = np.zeros(len(y))
    for _ in range(rounds):
        best = None
        for j in range(x.shape[1]):
            for t in np.unique(x[:, j])[:-1]:
                left = x[:, j] <= t
                impurity, said = 0.0, np.empty(len(y))
                for side in (left, ~left):
                    s = np.array([w[side & (y == 0)].sum(), w[side & (y == 1)].sum()])
                    impurity += s.sum() - (s**2).sum() / s.sum()
                    said[side] = s.argmax()
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, said)
        wrong = best[1] != y
        error = w[wrong].sum() / w.sum()
        alpha = np.log((1 - error) / error)
        vote += alpha * (2 * best[1] - 1)
        w = w * np.exp(alpha * wrong)
        w /= w.sum()
    return (vote > 0).astype(int)


def test_boosting_like_the_plain_algorithm(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, (300, 2)).astype(float)
    y = ((x[:, 0] > 5) ^ (rng.random(300) < 0.2) | (x[:, 1] > 9)).astype(int)
    rows = [(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))]
    ready = learn.with_vectors(spark.createDataFrame(rows, "id bigint, vec array<double>, label int"))
    model = StumpBoosting(maxIter=12).fit(ready)
    got = np.array([r[0] for r in model.transform(ready).orderBy("id").select("prediction").collect()])
    assert (got == samme(x, y, 12)).mean() > 0.99
    path = fresh_path(spark, "model")
    models.save_model(model, path)
    back = models.load_model(StumpEnsembleModel, path)
    assert back.stumps() == model.stumps() and sum(back.featureImportances) == pytest.approx(1.0)


def test_boosting_stops_on_a_perfect_stump(spark):
    rows = [(i, [float(i)], int(i > 10)) for i in range(20)]
    ready = learn.with_vectors(spark.createDataFrame(rows, "id bigint, vec array<double>, label int"))
    model = StumpBoosting().fit(ready)
    assert len(model.stumps()) == 1
    assert model.transform(ready).where("prediction <> label").count() == 0


def test_search_picks_the_best_setting(frame):
    model, tried = learn.search(frame, "decision_tree", folds=3, settings=[{"maxDepth": 1}, {"maxDepth": 4}])
    rows = tried.collect()
    best = max(rows, key=lambda r: r["mean_auc"])
    assert len(rows) == 2 and f"('maxDepth', {model.getMaxDepth()})" in best["params"]
    settings = learn.sample_settings("xgboost", 20)
    assert len(settings) == 20 and settings == learn.sample_settings("xgboost", 20)


def test_search_fits_trees_that_differ_in_depth_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 40, (600, 3)).astype(float)
    y = ((x[:, 0] > 20) ^ (x[:, 1] > 12) ^ (rng.random(600) < 0.25)).astype(int)
    frame = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))], "id bigint, vec array<double>, label int")
    settings = [{"maxDepth": d, "minInstancesPerNode": n, "impurity": k} for n, k in ((1, "gini"), (4, "entropy")) for d in (20, 0, 1, 2, 3, 5, 9)]
    ready = learn.materialise(learn.fold_assignment(learn.with_vectors(frame), "id", 3).select("id", "features", "label", "fold"))
    plain = learn.BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0)
    fitted, fit = [], learn.DecisionTreeClassifier._fit
    monkeypatch.setattr(learn.DecisionTreeClassifier, "_fit", lambda self, data: (fitted.append(self), fit(self, data))[1])
    _, tried = learn.search(frame, "decision_tree", folds=3, settings=settings)
    assert len(fitted) == 2 * 3 + 1
    got = [r["mean_auc"] for r in tried.orderBy("setting").collect()]
    for setting, area in zip(settings, got):
        areas = []
        for fold in range(3):
            model = learn.estimator("decision_tree", 600, **setting).fit(ready.where(F.col("fold") != fold))
            areas.append(plain.evaluate(model.transform(ready.where(F.col("fold") == fold))))
        assert area == pytest.approx(np.mean(areas), abs=1e-12), setting


def test_batch_predictions_and_artifact(spark, frame, trained):
    _, fitted, split = trained
    model = fitted["logistic_regression_none"]
    out = learn.batch_predictions(model, split)
    row = out.where("student_id = 's7'").first()
    assert row["model_version"] == "v1_local" and 0 <= row["predicted_probability"] <= 1
    assert out.count() == 400
    path = fresh_path(spark, "lr")
    models.save_model(model, path)
    again = learn.batch_predictions(models.load_model(LogisticRegressionModel, path), split)
    assert out.exceptAll(again).count() == 0


def test_importances(frame, trained):
    _, fitted, split = trained
    names = ["a", "b", "c"]
    model = fitted["logistic_regression_none"]
    native = explain.native_importance(model, names, frame)
    moved = explain.permutation_importance(model, split, names)
    ranked = explain.ranked_importance(native, moved).collect()
    assert [r["feature"] for r in ranked][:2] == ["a", "b"]
    assert ranked[0]["permutation_importance"] > 0.02
    # a feature the model ignores loses nothing
    tree = fitted["decision_tree_none"]
    unused = [n for n, v in zip(names, tree.featureImportances.toArray()) if v == 0]
    for r in explain.permutation_importance(tree, split, names).collect():
        if r["feature"] in unused:
            assert r["permutation_importance"] == 0.0


def test_shapley_of_an_additive_score(spark, frame, trained):
    _, fitted, split = trained
    model = fitted["logistic_regression_none"]
    got = {r["feature"]: r["shapley"] for r in explain.sampled_shapley(model, split, ["a", "b", "c"], paths=6).collect()}
    assert got["a"] > got["b"] > got["c"] >= 0


def test_manifest_and_log(spark, frame, trained):
    results, fitted, split = trained
    names = ["a", "b", "c"]
    model = fitted["logistic_regression_none"]
    ranked = explain.ranked_importance(explain.native_importance(model, names, frame), explain.permutation_importance(model, split, names))
    row = models.manifest(metrics.winner(results, "auc"), ranked, "/models/x", registered_at="2024-05-06 07:08:09")
    got = row.first()
    assert got["version"] == "v1_20240506_070809" and got["top_features"][0] == "a" and len(got["top_features"]) == 3
    assert '"total_features":3' in got["model_card"]
    path = fresh_path(spark, "registry")
    models.register(row, path)
    models.register(row.withColumn("registered_at", F.col("registered_at") + F.expr("interval 1 day")).withColumn("version", F.lit("later")), path)
    assert models.latest_versions(spark.read.parquet(path)).first()["version"] == "later"
    log = models.experiment_log(results)
    assert log.count() == 4 and log.first()["metrics"]["auc"] > 0
    tuned = spark.createDataFrame([("tree_tuned", 0.9)], "model string, auc double")
    assert models.with_tuned(results, tuned).count() == 5


def test_shapley_scores_every_set_of_features_once():
    """175 steps of 25 paths over six features pass at most 2 ** 6 sets; shares are those of the steps."""
    shares = explain._subset_shares(6, 25, 42)
    sets = [tuple(held) for held, _ in shares]
    assert len(sets) == len(set(sets)) <= 64
    of = {tuple(held): share for held, share in shares}
    # whatever the score of the empty and full set, attributions add up to their difference
    assert sum(of[(True,) * 6]) == pytest.approx(1.0) and sum(of[(False,) * 6]) == pytest.approx(-1.0)
    assert all(sum(share) == pytest.approx(0.0) for held, share in shares if any(held) and not all(held))


def test_stump_weights_follow_from_votes():
    import pyarrow as pa

    from holdfast.operators import boosting

    rng = np.random.default_rng(6)
    bins, y, held = rng.integers(0, 4, (50, 2)), rng.integers(0, 2, 50), rng.normal(size=50)
    votes = [(0, 1, 0, 1, 0.7), (1, 2, 1, 0, 0.3)]
    rows = [pa.array(y.astype(np.int32)), pa.array([b.astype(np.int32).tobytes() for b in bins]), pa.array(held)]
    batch = pa.RecordBatch.from_arrays(rows, ["y", "bins", "held"])
    wrong = [[(l if b[j] <= at else r) != c for j, at, l, r, _ in votes] for b, c in zip(bins, y)]
    want = held + np.array([[0.7, 0.3]]).repeat(50, 0).__mul__(wrong).sum(axis=1)
    kept = next(boosting._held_after(votes)(iter([batch])))
    assert np.allclose(kept["held"].to_numpy(), want) and kept["bins"].equals(batch["bins"])
    told = pa.Table.from_batches(boosting._weighed(votes, 0.2, [4, 4])(iter([batch, batch.slice(0, 0)]))).to_pylist()
    for cell in told:
        of = (bins[:, cell["j"]] == cell["bin"]) & (y == cell["y"])
        assert of.any() and np.isclose(cell["w"], np.exp(want[of] - 0.2).sum())
    assert sum(np.isclose(cell["w"], 0) for cell in told) == 0 and {c["j"] for c in told} == {0, 1}
