import numpy as np
import pytest

from holdfast.operators import drift
from holdfast.operators.quality import value_shares


def sample(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def numpy_divergence(p, q, bins=50):
    edges = np.histogram_bin_edges(np.concatenate([p, q]), bins=bins)
    shares = []
    for v in (p, q):
        h = np.histogram(v, bins=edges, density=True)[0] + 1e-10
        shares.append(h / h.sum())
    m = sum(shares) / 2
    return sum(0.5 * (s * np.log(s / m)).sum() for s in shares)


@pytest.fixture(scope="module")
def base():
    return np.random.default_rng(42).normal(3, 0.4, 500)


@pytest.mark.parametrize("change", ["same", "mean", "variance", "narrow"])
def test_divergence_like_numpy(spark, base, change):
    other = {"same": base, "mean": base + 2, "variance": 3 + (base - 3) * 3, "narrow": base * 1e-7}[change]
    row = drift.feature_drift(sample(spark, base), sample(spark, other)).first()
    want = numpy_divergence(base, other)
    assert row["js_divergence"] == pytest.approx(want, abs=2e-3 if change != "same" else 1e-6)
    assert row["drifted"] == (want > 0.1)
    assert row["train_mean"] == round(base.mean(), 4) and row["serve_std"] == round(other.std(ddof=1), 4)


def test_constant_and_short_samples(spark):
    same = drift.feature_drift(sample(spark, [2.0] * 12), sample(spark, [2.0] * 15)).first()
    assert same["js_divergence"] == 0.0 and not same["drifted"]
    assert drift.histogram(sample(spark, [2.0] * 12), sample(spark, [2.0] * 15), ["x"]).collect() == [("x", 25, 12, 15)]
    few = drift.feature_drift(sample(spark, [1.0] * 9 + [None] * 5), sample(spark, range(20)))
    assert few.count() == 0


def test_prediction_flip(spark):
    train = spark.createDataFrame([(int(i % 4 > 0),) for i in range(400)], "y int")
    serve = spark.createDataFrame([(int(i % 5 == 0),) for i in range(400)], "predicted_class int")
    row = drift.prediction_drift(train, serve, "y").first()
    p, q = np.array([0.25, 0.75]), np.array([0.8, 0.2])
    m = (p + q) / 2
    assert row["js_divergence"] == pytest.approx(0.5 * (p * np.log(p / m)).sum() + 0.5 * (q * np.log(q / m)).sum(), abs=1e-6)
    assert row["drifted"]


def test_disjoint_classes(spark):
    a = value_shares(spark.createDataFrame([("x",)] * 3, "v string"), "v")
    b = value_shares(spark.createDataFrame([("y",)] * 3, "v string"), "v")
    assert drift.discrete_divergence(a, b).first()["js"] == pytest.approx(np.log(2), abs=1e-6)


def test_two_sample_statistic(spark, base):
    other = np.random.default_rng(1).exponential(3, 400)
    row = drift.distribution_skew(sample(spark, base), sample(spark, other)).first()
    values = np.concatenate([base, other])
    gap = max(abs((base <= v).mean() - (other <= v).mean()) for v in values)
    assert row["ks_statistic"] == pytest.approx(gap, abs=1e-6) and row["skewed"] and row["ks_pvalue"] < 1e-6
    same = drift.distribution_skew(sample(spark, base), sample(spark, base)).first()
    assert same["ks_statistic"] == 0.0 and same["ks_pvalue"] == 1.0 and not same["skewed"]


def test_alert(spark, base):
    calm = drift.feature_drift(sample(spark, base), sample(spark, base))
    loud = drift.feature_drift(sample(spark, base), sample(spark, base + 2))
    assert not drift.alert(calm).first()["alert_triggered"]
    assert drift.alert(loud).first()["alert_triggered"]


def test_common_features_are_sorted(spark):
    a = spark.sql("select 1 as z, 2.0D as b, 'x' as s, true as f, 3 as target")
    b = spark.sql("select 1 as b, 2 as z, 1 as s, 3 as target, true as f")
    assert drift.common_features(a, b, ["target"]) == ["b", "z"]


def test_stored_profile_gives_the_same_report(spark):
    train = spark.range(400).selectExpr("cast(id % 17 as double) as x", "if(id % 9 = 0, null, id * 0.5) as z", "cast(id % 4 > 0 as int) as y", "1.5 as steady")
    serve = spark.range(150).selectExpr("cast(id % 11 + 6 as double) as x", "id * 0.7 as z", "cast(id % 3 > 0 as int) as predicted_class", "1.5 as steady")
    profile = drift.training_profile(train, "y", ["predicted_class"])
    direct = drift.feature_drift(train, serve, ignore=["y", "predicted_class"])
    assert sorted(map(tuple, drift.drift_from_profile(profile, serve, ignore=["predicted_class"]).collect())) == sorted(map(tuple, direct.collect()))
    row = drift.drift_report(profile, serve).first()
    assert row["train_distribution"] == {"0.0": 0.25, "1.0": 0.75}
    assert (row["features_analyzed"], row["drifted_features"], row["alert_triggered"]) == (3, 2, True)


def test_exact_tail_by_all_orders():
    from itertools import combinations

    for n, m in ((1, 1), (2, 3), (4, 4), (5, 3), (1, 6)):
        gaps = []
        for taken in combinations(range(n + m), n):
            a = np.cumsum(np.isin(np.arange(n + m), taken))
            b = np.arange(1, n + m + 1) - a
            gaps.append(np.abs(a * m - b * n).max())
        for gap in {0, *gaps}:
            want = np.mean(np.array(gaps) >= gap)
            assert drift.path_tail(gap / (n * m), n, m) == pytest.approx(want)
    # two samples of three without overlap: 2 of 20 orders
    assert drift.path_tail(1.0, 3, 3) == pytest.approx(0.1)


def test_p_value_turns_asymptotic_beyond_the_bound(spark):
    train = spark.createDataFrame([(float(i),) for i in range(12)], "x double")
    serve = spark.createDataFrame([(i + 4.5,) for i in range(12)], "x double")
    exact = drift.distribution_skew(train, serve, exact_values=drift.EXACT_VALUES).first()["ks_pvalue"]
    beyond = drift.distribution_skew(train, serve, exact_values=11).first()["ks_pvalue"]
    assert drift.distribution_skew(train, serve).first()["ks_pvalue"] == beyond
    d = 5 / 12
    z = d * np.sqrt(6)
    assert exact == pytest.approx(drift.path_tail(d, 12, 12), abs=1e-6)
    assert beyond == pytest.approx(2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * z * z) for k in range(1, 101)), abs=1e-6)
    assert exact != beyond
