import numpy as np
import pytest

from holdfast.operators import metrics


def scored(spark, rows):
    return spark.createDataFrame(rows, "y int, z int, p double")


def test_auc_with_ties(spark):
    rng = np.random.default_rng(0)
    y, p = rng.integers(0, 2, 200), rng.integers(0, 20, 200) / 20
    got = metrics.roc_auc(scored(spark, [(int(a), 0, float(b)) for a, b in zip(y, p)]), "y", "p").first()["auc"]
    pos, neg = p[y == 1], p[y == 0]
    want = ((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2)
    assert got == pytest.approx(want)


def test_one_class_has_no_auc_and_a_zero_matrix(spark):
    df = scored(spark, [(1, 1, 0.9), (1, 1, 0.8)])
    assert metrics.roc_auc(df, "y", "p").first()["auc"] is None
    row = metrics.class_metrics(df, "y", "z").first()
    assert (row["tp"], row["tp_rate"], row["accuracy"], row["precision"], row["f1"]) == (0, 0.0, 1.0, 1.0, 1.0)


def test_rates(spark):
    df = scored(spark, [(1, 1, 0.9)] * 3 + [(1, 0, 0.2)] + [(0, 0, 0.1)] * 2 + [(0, 1, 0.7)] * 4)
    row = metrics.class_metrics(df, "y", "z").first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (2, 4, 1, 3)
    assert row["precision"] == pytest.approx(3 / 7) and row["recall"] == 0.75 and row["tn_rate"] == pytest.approx(1 / 3)
    none = metrics.class_metrics(scored(spark, [(1, 0, 0.1), (0, 0, 0.2)]), "y", "z").first()
    assert none["precision"] == 0.0 and none["f1"] == 0.0
    assert metrics.class_metrics(df.where("y > 5"), "y", "z").first()["accuracy"] == 0.0


def test_ranking_is_stable(spark):
    df = spark.createDataFrame([("a", 0.5, 2), ("b", 0.9, 1), ("c", 0.5, 0), ("d", None, 3)], "m string, auc double, seq int")
    assert [r["m"] for r in metrics.rank_models(df, "auc").orderBy("rank").collect()] == ["b", "c", "a", "d"]
    assert metrics.winner(df, "auc").first()["m"] == "b"
    with pytest.raises(ValueError):
        metrics.rank_models(df, "tn")


def test_summary(spark):
    df = scored(spark, [(1, 1, 0.9), (0, 1, 0.6), (0, 0, 0.1), (1, 0, 0.4)])
    row = metrics.prediction_summary(df, "z", "p", "y").first()
    assert row["median_probability"] == pytest.approx(0.5) and row["batch_accuracy"] == 0.5 and row["batch_auc"] == 0.75
    assert "batch_auc" not in metrics.prediction_summary(df, "z", "p").columns


def test_impact_ratio(spark):
    df = spark.createDataFrame([("a", 1)] * 3 + [("a", 0)] + [("b", 1), ("b", 0)], "g string, z int")
    got = {r["g"]: r["impact_ratio"] for r in metrics.group_rates(df, "g", "z", "a").collect()}
    assert got == {"a": 1.0, "b": pytest.approx(2 / 3)}
