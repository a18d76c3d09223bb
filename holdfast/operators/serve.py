"""Scoring requests: validation, defaults, feature order, cached and precomputed answers, fallbacks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions import skew
from holdfast.operators.prep import engineer_features
from holdfast.operators.quality import col

# Bounds of the optional request fields (lower, upper or None).
REQUEST_BOUNDS = {
    "hs_gpa": (0.0, 4.0),
    "sat_score": (400, 1600),
    "cumulative_gpa": (0.0, 4.0),
    "credits_earned": (0, None),
    "credits_attempted": (0, None),
    "efc": (0, None),
    "total_aid_amount": (0, None),
    "loan_amount": (0, None),
    "campus_distance_miles": (0, None),
}
# Request defaults.
REQUEST_DEFAULTS = {name: -1.0 for name in REQUEST_BOUNDS} | {"first_generation_flag": 0, "pell_eligible": 0}
# The answer when nothing else is known.
DEFAULT_ANSWER = {"predicted_class": -1, "probability": 0.5, "model_version": "none"}

def violated_rules(columns: Sequence[str], bounds: dict[str, tuple]) -> Column:
    """Array of the rules a row breaks; a missing optional field breaks none."""
    checks = []
    for name, (low, high) in bounds.items():
        if name in columns:
            if low is not None:
                checks.append(F.when(col(name) < low, F.lit(f"{name}>={low}")))
            if high is not None:
                checks.append(F.when(col(name) > high, F.lit(f"{name}<={high}")))
    return F.array_compact(F.array(*checks))


def validate_requests(df: DataFrame, bounds: dict[str, tuple] = REQUEST_BOUNDS) -> DataFrame:
    """Add ``violations`` and ``valid``; callers split on the flag."""
    return df.withColumn("violations", violated_rules(df.columns, bounds)).withColumn(
        "valid", F.size("violations") == 0
    )


def with_defaults(df: DataFrame, defaults: dict[str, float] = REQUEST_DEFAULTS) -> DataFrame:
    """Missing fields get their default; a real zero stays zero."""
    out = []
    for name, value in defaults.items():
        if name in df.columns:
            given = col(name).cast("int") if dict(df.dtypes)[name] == "boolean" else col(name)
            out.append(F.coalesce(given, F.lit(value)).alias(name))
        else:
            out.append(F.lit(value).alias(name))
    rest = [col(c) for c in df.columns if c not in defaults]
    return df.select(*rest, *out)


def align_features(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the model's features, by name and in its order; absent ones are 0, others go."""
    return df.select(
        *[col(c) for c in keep],
        *[
            F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(c) if c in df.columns else F.lit(0.0).alias(c)
            for c in expected
        ],
    )


def request_features(
    df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ("student_id",), first_cohort: int | None = None
) -> DataFrame:
    """The model's input for scoring requests: defaults, the same derived features as in training in
    their guarded form, then the model's columns by name.

    Pass the training data's ``first_cohort``, or one student's recency differs between batches.
    """
    return align_features(engineer_features(with_defaults(df), guarded=True, first_cohort=first_cohort), expected, keep)


def first_rows(df: DataFrame, order: Sequence[str], n: int = 50) -> DataFrame:
    """The first ``n`` rows in a stated order, for reports that show a few instances."""
    return df.orderBy(*order).limit(n)


def _salted_requests(requests: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Requests with hot keys spread over salts, and the hot keys themselves."""
    hot = skew.hot_keys(requests, key)
    return skew.salt_left(requests, key, hot), hot


def _lookup(salted: DataFrame, answers: DataFrame, key: str, hot: DataFrame, condition: Column | None = None) -> DataFrame:
    """Left join of salted requests to answers, which have one row per key."""
    right = skew.salt_right(answers, key, hot).withColumnsRenamed({key: "_k", skew.SALT: "_s"})
    match = (F.col(key) == F.col("_k")) & (F.col(skew.SALT) == F.col("_s"))
    if condition is not None:
        match = match & condition
    return salted.join(right, match, "left").drop("_k", "_s")


def _young(as_of: str, stored: str, ttl_seconds: int) -> Column:
    """Younger than the time to live, and not stored after the request: a batch holds later answers
    too, which a cache asked at that time could not have given."""
    age = F.col(as_of).cast("double") - F.col(stored).cast("double")
    return (age < ttl_seconds) & (age >= 0)


def latest_answers(log: DataFrame, key: str, ts: str, fields: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Last stored answer per key with its time, as a cache would hold it."""
    last = F.max_by(F.struct(ts, *fields), F.struct(ts, *tie)).alias("_a")
    return log.groupBy(key).agg(last).select(key, "_a.*")


def ttl_lookup(requests: DataFrame, cache: DataFrame, key: str, as_of: str, stored: str, ttl_seconds: int = 3600) -> DataFrame:
    """Requests left-joined to cached answers younger than the time to live (strictly)."""
    salted, hot = _salted_requests(requests, key)
    return _lookup(salted, cache, key, hot, _young(as_of, stored, ttl_seconds)).drop(skew.SALT)


def fallback_chain(
    requests: DataFrame,
    cache: DataFrame,
    batch: DataFrame,
    key: str,
    as_of: str,
    stored: str,
    ttl_seconds: int = 3600,
) -> DataFrame:
    """Answer each request from the live score, the cache, the batch table or the default.

    ``requests`` carries ``live_class``, ``live_probability`` and ``live_version`` (NULL when scoring
    failed); ``cache`` and ``batch`` carry class, probability and version under those prefixes.
    """
    salted, hot = _salted_requests(requests, key)
    found = _lookup(salted, cache, key, hot, _young(as_of, stored, ttl_seconds))
    found = _lookup(found, batch, key, hot)
    served = (
        F.when(F.col("live_class").isNotNull(), "live")
        .when(F.col("cache_class").isNotNull(), "cache")
        .when(F.col("batch_class").isNotNull(), "batch")
        .otherwise("default")
    )
    pick = lambda field, default: (
        F.when(served == "live", F.col(f"live_{field}"))
        .when(served == "cache", F.col(f"cache_{field}"))
        .when(served == "batch", F.col(f"batch_{field}"))
        .otherwise(F.lit(default))
    )
    return found.select(
        *[col(c) for c in requests.columns if not c.startswith("live_")],
        pick("class", DEFAULT_ANSWER["predicted_class"]).cast("int").alias("predicted_class"),
        pick("probability", DEFAULT_ANSWER["probability"]).alias("probability"),
        pick("version", DEFAULT_ANSWER["model_version"]).alias("model_version"),
        served.alias("served_from"),
        (served != "live").alias("degraded"),
    )


def tier_statistics(served: DataFrame) -> DataFrame:
    """Request count per tier, total and degraded share, one row."""
    count = lambda tier: F.count_if(F.col("served_from") == tier).alias(tier)
    return served.agg(
        *[count(t) for t in ("live", "cache", "batch", "default")],
        F.count(F.lit(1)).alias("total_requests"),
        F.round(F.coalesce(F.avg((F.col("served_from") != "live").cast("double")), F.lit(0.0)), 4).alias("degraded_pct"),
    )


def cache_statistics(lookups: DataFrame, answer: str) -> DataFrame:
    hit = col(answer).isNotNull()
    return lookups.agg(
        F.count_if(hit).alias("hits"),
        F.count_if(~hit).alias("misses"),
        F.round(F.coalesce(F.avg(hit.cast("double")), F.lit(0.0)), 4).alias("hit_rate"),
    )
