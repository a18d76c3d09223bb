"""Distribution drift between a training frame and a serving frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.ordered import running_sums
from holdfast.operators.quality import col, numeric_columns, value_shares
from holdfast.operators.relate import align_distributions
from holdfast.session import stage

BINS = 50
EPSILON = 1e-10
MIN_VALUES = 10


def common_features(train: DataFrame, serve: DataFrame, ignore: Sequence[str] = ()) -> list[str]:
    """Numeric columns of both frames in name order, the ignored ones left out."""
    return sorted((set(numeric_columns(train)) & set(numeric_columns(serve))) - set(ignore))


def _both(train: DataFrame, serve: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows of both frames under one schema; ``_train`` tells the side."""
    side = lambda df, flag: df.select(
        F.lit(flag).alias("_train"), *[col(c).cast("double").alias(f"_{i}") for i, c in enumerate(features)]
    )
    return side(train, True).unionByName(side(serve, False))


def _side_statistics(both: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row with an array of per-feature structs: bounds over both sides, moments per side."""
    aggs = []
    for i in range(len(features)):
        v = F.col(f"_{i}")
        aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        for name, where in (("train", F.col("_train")), ("serve", ~F.col("_train"))):
            mine = F.when(where, v)
            aggs += [
                F.count(mine).alias(f"n_{name}{i}"),
                F.avg(mine).alias(f"mean_{name}{i}"),
                F.stddev_samp(mine).alias(f"std_{name}{i}"),
            ]
    structs = []
    for i, c in enumerate(features):
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        flat = lo == hi
        low = F.when(flat, lo - 0.5).otherwise(lo)
        high = F.when(flat, hi + 0.5).otherwise(hi)
        structs.append(
            F.struct(
                F.lit(c).alias("feature"),
                low.alias("low"),
                ((high - low) / BINS).alias("width"),
                *[
                    F.col(f"{stat}_{name}{i}").alias(f"{stat}_{name}")
                    for name in ("train", "serve")
                    for stat in ("n", "mean", "std")
                ],
            )
        )
    return both.agg(*aggs).select(F.array(*structs).alias("stats"))


def _bin(value: Column, low: Column, width: Column) -> Column:
    """Equal-width bin, the last one closed on the right; NULL has none (``least`` alone would skip it)."""
    return F.when(value.isNotNull(), F.least(F.floor((value - low) / width), F.lit(BINS - 1)).cast("int"))


def _histogram(both: DataFrame, features: Sequence[str], stats: DataFrame) -> DataFrame:
    """(feature, bin, train, serve) counts for all features in one pass over the rows."""
    known = both.withColumn("_s", stats.scalar())
    cells = [
        F.struct(
            F.lit(i).alias("f"), _bin(F.col(f"_{i}"), F.col("_s")[i]["low"], F.col("_s")[i]["width"]).alias("bin")
        )
        for i in range(len(features))
    ]
    names = F.array(*[F.lit(c) for c in features])
    return (
        known.select("_train", F.inline(F.array(*cells)))
        .where("bin is not null")
        .groupBy("f", "bin")
        .agg(F.count_if("_train").alias("train"), F.count_if(~F.col("_train")).alias("serve"))
        .select(F.get(names, F.col("f")).alias("feature"), "bin", "train", "serve")
    )


def histogram(train: DataFrame, serve: DataFrame, features: Sequence[str]) -> DataFrame:
    """Two-sample histogram over the union range, 50 equal bins; empty bins are absent."""
    both = _both(train, serve, features)
    return _histogram(both, features, _side_statistics(both, features))


def _divergence_term(p: Column, q: Column) -> Column:
    middle = (p + q) / 2
    return 0.5 * p * F.log(p / middle) + 0.5 * q * F.log(q / middle)


def _smoothed(count: Column, total: Column, width: Column) -> Column:
    """Density share of a bin after adding epsilon to every one of the 50 densities."""
    return (count / total + EPSILON * width) / (1 + BINS * EPSILON * width)


def feature_drift(
    train: DataFrame,
    serve: DataFrame,
    features: Sequence[str] | None = None,
    threshold: float = 0.1,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """Jensen-Shannon divergence, drift flag, means and deviations per feature.

    Features with fewer than 10 values on a side are left out.  A bin empty on both sides has equal
    smoothed shares and adds nothing, so only occupied bins are summed.
    """
    features = list(features or common_features(train, serve, ignore))
    both = _both(train, serve, features)
    stats = _side_statistics(both, features)
    per_feature = stats.select(F.inline("stats"))
    return _divergences(_histogram(both, features, stats), per_feature, threshold)


def _divergences(bins: DataFrame, per_feature: DataFrame, threshold: float) -> DataFrame:
    """The report rows of binned counts (feature, bin, train, serve) and per-feature statistics."""
    joined = bins.join(F.broadcast(per_feature), "feature")  # one row per feature
    enough = joined.where((F.col("n_train") >= MIN_VALUES) & (F.col("n_serve") >= MIN_VALUES))
    p = _smoothed(F.col("train"), F.col("n_train"), F.col("width"))
    q = _smoothed(F.col("serve"), F.col("n_serve"), F.col("width"))
    moments = [F.first(f"{s}_{side}").alias(f"{s}_{side}") for s in ("mean", "std") for side in ("train", "serve")]
    return (
        enough.groupBy("feature")
        .agg(F.sum(_divergence_term(p, q)).alias("js"), *moments)
        .select(
            "feature",
            F.round("js", 6).alias("js_divergence"),
            (F.col("js") > threshold).alias("drifted"),
            F.round("mean_train", 4).alias("train_mean"),
            F.round("mean_serve", 4).alias("serve_mean"),
            F.round("std_train", 4).alias("train_std"),
            F.round("std_serve", 4).alias("serve_std"),
        )
    )


@dataclass
class Profile:
    """What drift checks need of the training data: counted values, moments and class shares, as written tables."""

    features: list[str]
    values: DataFrame  # feature, value, n
    moments: DataFrame  # feature, n, mean, std
    classes: DataFrame  # value, share


def _counted(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value, n) of all features; the shuffle has one row per feature and value."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), col(c).cast("double").alias("value")) for c in features])
    return df.select(F.inline(cells)).where("value is not null").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def _moments(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, n, mean, std) of all features, from one pass."""
    aggs = []
    for i, c in enumerate(features):
        value = col(c).cast("double")
        aggs += [F.count(value).alias(f"n{i}"), F.avg(value).alias(f"mean{i}"), F.stddev_samp(value).alias(f"std{i}")]
    rows = [F.struct(F.lit(c).alias("feature"), *[F.col(f"{s}{i}").alias(s) for s in ("n", "mean", "std")]) for i, c in enumerate(features)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def training_profile(train: DataFrame, target: str, ignore: Sequence[str] = (), folder: str | None = None) -> Profile:
    """Count the training data once; later checks read only what is written here."""
    features = sorted(set(numeric_columns(train)) - {target, *ignore})
    shares = value_shares(train.select(col(target).cast("double").alias("value")), "value")
    return Profile(
        features,
        stage(_counted(train, features), "profile-values", folder),
        stage(_moments(train, features), "profile-moments", folder),
        stage(shares, "profile-classes", folder),
    )


def drift_from_profile(profile: Profile, serve: DataFrame, threshold: float = 0.1, ignore: Sequence[str] = ()) -> DataFrame:
    """As ``feature_drift``, against a stored profile: the training data is not read again."""
    features = [c for c in profile.features if c in set(numeric_columns(serve)) - set(ignore)]
    known = profile.values.where(F.col("feature").isin(features))
    sides = known.select("feature", "value", F.col("n").alias("train"), F.lit(0).cast("bigint").alias("serve"))
    sides = sides.unionByName(_counted(serve, features).select("feature", "value", F.lit(0).cast("bigint").alias("train"), F.col("n").alias("serve")))
    bounds = sides.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    low = F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo"))
    high = F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi"))
    stats = bounds.select("feature", low.alias("low"), ((high - low) / BINS).alias("width"))
    for name, moments in (("train", profile.moments), ("serve", _moments(serve, features))):
        stats = stats.join(moments.select("feature", *[F.col(s).alias(f"{s}_{name}") for s in ("n", "mean", "std")]), "feature")
    placed = sides.join(F.broadcast(stats), "feature")  # one row per feature
    binned = placed.groupBy("feature", _bin(F.col("value"), F.col("low"), F.col("width")).alias("bin")).agg(
        F.sum("train").alias("train"), F.sum("serve").alias("serve")
    )
    return _divergences(binned, stats, threshold)


def prediction_drift_from_profile(profile: Profile, serve: DataFrame, predicted: str = "predicted_class", threshold: float = 0.1) -> DataFrame:
    """Divergence between stored training classes and predicted classes, with both distributions."""
    shares = value_shares(serve.select(col(predicted).cast("double").alias("value")), "value")
    found = discrete_divergence(profile.classes, shares)
    return found.select(
        F.round("js", 6).alias("js_divergence"),
        (F.col("js") > threshold).alias("drifted"),
        _as_map(profile.classes).alias("train_distribution"),
        _as_map(shares).alias("serve_distribution"),
    )


def _as_map(shares: DataFrame) -> Column:
    """Class shares as one map; there are as many entries as classes."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col("value").cast("string"), F.col("share"))))
    return shares.where("value is not null").agg(F.map_from_entries(pairs)).scalar()


def drift_report(profile: Profile, serve: DataFrame, predicted: str = "predicted_class", threshold: float = 0.1) -> DataFrame:
    """One row: drifted features, prediction drift with both class distributions, and the alert."""
    features = drift_from_profile(profile, serve, threshold, [predicted])
    classes = prediction_drift_from_profile(profile, serve, predicted, threshold)
    return alert(features, classes).withColumn("_p", F.lit(1)).join(classes.withColumn("_p", F.lit(1)), "_p").drop("_p", "drifted")


def discrete_divergence(left: DataFrame, right: DataFrame, key: str = "value") -> DataFrame:
    """Jensen-Shannon divergence of two (key, share) tables over the union of their keys."""
    aligned = align_distributions(left, right, key, "share")
    totals = aligned.agg(
        F.struct(
            (F.sum("p") + EPSILON * F.count(F.lit(1))).alias("p"),
            (F.sum("q") + EPSILON * F.count(F.lit(1))).alias("q"),
        )
    ).scalar()
    scaled = aligned.withColumn("_t", totals).select(
        ((F.col("p") + EPSILON) / F.col("_t.p")).alias("p"), ((F.col("q") + EPSILON) / F.col("_t.q")).alias("q")
    )
    return scaled.agg(F.sum(_divergence_term(F.col("p"), F.col("q"))).alias("js"))


def prediction_drift(
    train: DataFrame, serve: DataFrame, target: str, predicted: str = "predicted_class", threshold: float = 0.1
) -> DataFrame:
    """Divergence between the training classes and the predicted classes."""
    as_class = lambda df, c: df.select(col(c).cast("double").alias("value"))
    return discrete_divergence(
        value_shares(as_class(train, target), "value"), value_shares(as_class(serve, predicted), "value")
    ).select(F.round("js", 6).alias("js_divergence"), (F.col("js") > threshold).alias("drifted"))


def kolmogorov_tail(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample statistic."""
    z = F.sqrt(n * m / (n + m)) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda total, k: total + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * z * z),
    )
    return F.when(z < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series)))


#: Values a sample may have for an exact p-value within about a second a feature.
EXACT_VALUES = 10_000


def path_tail(statistic: float, n: int, m: int) -> float:
    """Exact two-sided p-value: the share of orders of n and m different values whose distance between the two
    step functions reaches the statistic.

    An order is a path from (0, 0) to (n, m). All points of one diagonal are stepped at once; each holds the
    share of the paths to it that stay closer than the statistic. Ties make it an upper bound.
    """
    reach = round(statistic * n * m)
    if reach <= 0:
        return 1.0
    inside = np.ones(1)
    low = 0  # first coordinate of the diagonal's first point
    for step in range(1, n + m + 1):
        first, last = max(0, step - m), min(n, step)
        i = np.arange(first, last + 1)
        before = np.zeros(last - first + 3)  # points first - 1 to last + 1 of the diagonal before
        before[low - first + 1 : low - first + 1 + len(inside)] = inside
        inside = (before[:-2] * i + before[1:-1] * (step - i)) / step
        inside[np.abs(i * m - (step - i) * n) >= reach] = 0.0
        low = first
    return float(min(1.0, max(0.0, 1.0 - inside[0])))


@F.pandas_udf(T.DoubleType())
def _path_tails(statistic: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([path_tail(float(d), int(a), int(b)) for d, a, b in zip(statistic, n, m)], dtype="float64")


def distribution_skew(
    train: DataFrame,
    serve: DataFrame,
    features: Sequence[str] | None = None,
    threshold: float = 0.1,
    ignore: Sequence[str] = (),
    first: int | None = None,
    exact_values: int = 0,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic, p-value and flag per feature; ``first`` limits the report to
    that many features in name order. The p-value is the asymptotic one; with ``exact_values`` (such as
    ``EXACT_VALUES``) it is exact while neither sample has more values of the feature than that."""
    features = list(features or common_features(train, serve, ignore))[:first]
    # features travel as numbers: one row per feature and distinct value is shuffled
    cells = [F.struct(F.lit(i).alias("f"), F.col(f"_{i}").alias("value")) for i in range(len(features))]
    counted = (
        _both(train, serve, features)
        .select("_train", F.inline(F.array(*cells)))
        .where("value is not null")
        .groupBy("f", "value")
        .agg(F.count_if("_train").alias("train"), F.count_if(~F.col("_train")).alias("serve"))
    )
    running = running_sums(counted, ["f"], ["value"], ["train", "serve"])
    n, m = F.col("all_train"), F.col("all_serve")
    gap = F.abs(F.col("cum_train") / n - F.col("cum_serve") / m)
    names = F.array(*[F.lit(c) for c in features])
    told = (
        running.where((n >= MIN_VALUES) & (m >= MIN_VALUES))
        .groupBy("f")
        .agg(F.max(gap).alias("ks"), F.max(n).alias("n"), F.max(m).alias("m"))
    )
    asymptotic = kolmogorov_tail(F.col("ks"), F.col("n"), F.col("m"))
    if not exact_values:
        return _skews(told, names, asymptotic, threshold)
    # Python sees every argument, so samples beyond the bound are passed as empty ones
    small = F.greatest("n", "m") <= exact_values
    sizes = [F.when(small, F.col(c)).otherwise(0) for c in ("n", "m")]
    told = told.withColumn("exact", _path_tails("ks", *sizes))
    return _skews(told, names, F.when(small, F.col("exact")).otherwise(asymptotic), threshold)


def _skews(told: DataFrame, names: Column, p_value: Column, threshold: float) -> DataFrame:
    return told.select(
        F.get(names, F.col("f")).alias("feature"),
        F.round("ks", 6).alias("ks_statistic"),
        F.round(p_value, 6).alias("ks_pvalue"),
        (F.col("ks") > threshold).alias("skewed"),
    )


def alert(features: DataFrame, predictions: DataFrame | None = None) -> DataFrame:
    """One row: number of drifted features, prediction drift, and whether to raise an alert."""
    flags = features.agg(
        F.count(F.lit(1)).alias("features_analyzed"), F.count_if("drifted").alias("drifted_features")
    )
    drifted = F.lit(False) if predictions is None else predictions.agg(F.bool_or("drifted")).scalar()
    return flags.withColumn("prediction_drifted", F.coalesce(drifted, F.lit(False))).withColumn(
        "alert_triggered", (F.col("drifted_features") > 0) | F.col("prediction_drifted")
    )
