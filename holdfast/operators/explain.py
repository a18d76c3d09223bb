"""Feature importances: native, by permutation, and sampled Shapley attributions."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.ordered import dense_index
from holdfast.operators.learn import scored
from holdfast.session import materialise

REPEATS = 5
PATHS = 25


def native_importance(model: Model, features: Sequence[str], frame: DataFrame) -> DataFrame:
    """(feature, native_importance) from the model itself; absolute coefficients for linear models."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances
        values = values.toArray() if hasattr(values, "toArray") else values
    elif hasattr(model, "coefficients"):
        values = [abs(v) for v in model.coefficients.toArray()]
    else:
        values = [0.0] * len(features)
    return frame.sparkSession.createDataFrame(
        [(f, float(v)) for f, v in zip(features, values)], "feature string, native_importance double"
    )


def _coprime(n: int, draw: random.Random) -> int:
    while True:
        step = draw.randrange(1, n + 1)
        if math.gcd(step, n) == 1:
            return step


def _accuracy_by(model: Model, frame: DataFrame, by: Sequence[str]) -> DataFrame:
    hit = (F.col("predicted_class") == F.col("label").cast("int")).cast("double")
    return scored(model, frame).groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def permutation_importance(
    model: Model, frame: DataFrame, features: Sequence[str], repeats: int = REPEATS, seed: int = 42
) -> DataFrame:
    """Mean accuracy lost when one feature's values are dealt to other rows.

    Rows are numbered 0..n-1; a repeat deals row r the values of row (a r + b) mod n with a coprime to
    n, which is a permutation.  One join per call brings every repeat's donor rows, and each feature is
    swapped in turn while scoring, so nothing but running sums is shuffled afterwards.
    """
    rows = materialise(dense_index(materialise(frame.select("vec", "label"))))
    n = rows.count()
    deals = []
    for r in range(repeats):
        draw = random.Random(seed + r)
        deals.append((r, _coprime(n, draw), draw.randrange(n)))
    # the product of two row numbers may pass 2^63, hence the decimal for many rows
    big = F.col("row_index").cast("bigint" if n <= 3_000_000_000 else "decimal(38,0)")
    asked = rows.withColumn(
        "_deal",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(r).alias("round"), F.pmod(big * a + b, F.lit(n)).cast("bigint").alias("donor"))
                    for r, a, b in deals
                ]
            )
        ),
    ).select("vec", "label", "_deal.round", "_deal.donor")
    donors = rows.select(F.col("row_index").alias("donor"), F.col("vec").alias("other"))
    swapped = (
        asked.join(donors, "donor")
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))))
        .select(
            F.array(
                *[
                    F.when(F.col("j") == i, F.get("other", F.lit(i))).otherwise(F.get("vec", F.lit(i)))
                    for i in range(len(features))
                ]
            ).alias("vec"),
            "label",
            "j",
        )
    )
    base = _accuracy_by(model, rows, []).scalar()
    names = F.array(*[F.lit(f) for f in features])
    # every round has the same number of rows, so the mean over rows is the mean over rounds
    return _accuracy_by(model, swapped, ["j"]).select(
        F.get(names, F.col("j")).alias("feature"), (base - F.col("accuracy")).alias("permutation_importance")
    )


def _subset_shares(p: int, paths: int, seed: int) -> list[tuple[list[bool], list[float]]]:
    """The sets of switched features that the paths pass, each once, and what a set's score adds to every feature's
    attribution: the sets of many paths are alike, above all the empty and the full one."""
    shares: dict[tuple[bool, ...], list[float]] = {}
    for k in range(paths):
        order = list(range(p))
        random.Random(seed + k).shuffle(order)
        held = [False] * p
        for step in range(p + 1):
            share = shares.setdefault(tuple(held), [0.0] * p)
            # a score belongs to the feature switched at this step (+) and to the one switched next (-)
            if step:
                share[order[step - 1]] += 1 / paths
            if step < p:
                share[order[step]] -= 1 / paths
                held[order[step]] = True
    return [(list(held), share) for held, share in shares.items()]


def sampled_shapley(
    model: Model, frame: DataFrame, features: Sequence[str], paths: int = PATHS, seed: int = 42
) -> DataFrame:
    """Mean absolute attribution per feature over all rows of the frame.

    Along a path, features switch one by one, in the path's order, from the mean row to the explained row; the change of
    the score is the attribution of the feature just switched.
    """
    p = len(features)
    means = frame.agg(F.array(*[F.avg(F.col("vec")[i]) for i in range(p)])).first()[0]
    as_array = lambda values: F.array(*[F.lit(v) for v in values])
    subsets = F.array(
        *[F.struct(as_array(held).alias("held"), as_array(share).alias("share")) for held, share in _subset_shares(p, paths, seed)]
    )
    fixed = materialise(frame.select("vec", "label"))
    numbered = dense_index(fixed)
    mixed = F.array(*[F.when(F.get("_s.held", F.lit(i)), F.get("vec", F.lit(i))).otherwise(F.lit(means[i])) for i in range(p)])
    steps = numbered.withColumn("_s", F.explode(subsets)).select("row_index", "_s.share", mixed.alias("vec"), "label")
    scores = scored(model, steps).select("row_index", "share", "predicted_probability")
    per_row = scores.groupBy("row_index").agg(
        *[F.sum(F.get("share", F.lit(j)) * F.col("predicted_probability")).alias(f"a{j}") for j in range(p)]
    )
    sums = per_row.agg(*[F.avg(F.abs(F.col(f"a{j}"))).alias(f"a{j}") for j in range(p)])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"a{j}").alias("shapley")) for j, f in enumerate(features)])
    return sums.select(F.inline(rows)).where("shapley is not null")


def ranked_importance(native: DataFrame, permutation: DataFrame, top: int | None = None) -> DataFrame:
    """Both importances ranked by the native one, or by permutation where the native is 0."""
    merged = native.join(permutation, "feature", "left").fillna(0.0, ["permutation_importance"])
    key = F.when(F.col("native_importance") != 0, F.col("native_importance")).otherwise(F.col("permutation_importance"))
    ordered = merged.withColumn("importance", key).orderBy(F.col("importance").desc(), "feature")
    return ordered.limit(top) if top else ordered
