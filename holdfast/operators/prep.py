"""Preparation stages: harmonise, clean and encode, derive features, export."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions import scalars as S
from holdfast.functions.ordered import previous_value, running_sums
from holdfast.operators.quality import col, string_columns
from holdfast.operators.relate import first_row

# Expected type family of each student column.
STUDENT_TYPES = {
    "student_id": "string",
    "gender": "string",
    "ethnicity": "string",
    "first_generation_flag": "boolean",
    "hs_gpa": "double",
    "sat_score": "double",
    "act_score": "double",
    "home_state": "string",
    "campus": "string",
    "campus_latitude": "double",
    "campus_longitude": "double",
    "campus_distance_miles": "double",
    "hs_latitude": "double",
    "hs_longitude": "double",
    "cohort_year": "bigint",
    "term_gpa": "double",
    "cumulative_gpa": "double",
    "credits_attempted": "double",
    "credits_earned": "double",
    "course_count": "double",
    "major": "string",
    "major_changed_flag": "boolean",
    "academic_standing": "string",
    "efc": "double",
    "pell_eligible": "boolean",
    "total_aid_amount": "double",
    "loan_amount": "double",
    "grant_amount": "double",
    "scholarship_amount": "double",
    "unmet_need": "double",
    "work_study_flag": "boolean",
    "enrollment_status": "string",
    "second_year_ret_flag": "double",
}
# Features exported per entity.
EXPORT_FEATURES = [
    "hs_gpa", "sat_score", "act_score",
    "cumulative_gpa", "term_gpa", "credits_earned", "credits_attempted",
    "efc", "total_aid_amount", "loan_amount", "unmet_need",
    "campus_distance_miles", "cohort_year",
    "gpa_change", "gpa_momentum", "credit_ratio", "credit_deficit",
    "aid_coverage_ratio", "loan_dependency", "distance_bin", "test_score_composite",
]
# Distance bin edges in miles.
DISTANCE_EDGES = [0, 25, 50, 100, 250, 500, float("inf")]
# Columns that are never features, and constants kept by design.
NOT_FEATURES = ("event_type", "event_date", "term")
KEPT_CONSTANTS = ("campus_longitude", "campus_latitude")

_CASTS = {"string": S.as_text, "double": S.as_number, "bigint": S.as_integer, "boolean": S.as_flag}


def unique_columns(df: DataFrame) -> DataFrame:
    """Keep the first of several columns with the same name."""
    seen, names, keep = set(), [], []
    for i, c in enumerate(df.columns):
        names.append(f"_{i}")
        if c not in seen:
            seen.add(c)
            keep.append(F.col(f"_{i}").alias(c))
    return df if len(keep) == len(names) else df.toDF(*names).select(*keep)


def sentinel(kind: T.DataType):
    """Fill value of a type, None where nulls stay (dates, nested)."""
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return -1.0
    if isinstance(kind, T.IntegralType):
        return -1
    if isinstance(kind, T.StringType):
        return "unknown"
    if isinstance(kind, T.BooleanType):
        return False
    return None


def coerce_types(df: DataFrame, types: dict[str, str] = STUDENT_TYPES) -> DataFrame:
    return df.select(
        *[_CASTS[types[c]](col(c)).alias(c) if c in types else col(c) for c in df.columns]
    )


def fill_sentinels(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        value = sentinel(f.dataType)
        out.append(
            col(f.name)
            if value is None
            else F.coalesce(col(f.name), F.lit(value).cast(f.dataType)).alias(f.name)
        )
    return df.select(*out)


def harmonise(df: DataFrame, types: dict[str, str] = STUDENT_TYPES) -> DataFrame:
    """Distinct rows, unique columns, expected types, nulls replaced by sentinels."""
    return fill_sentinels(coerce_types(unique_columns(df).distinct(), types))


def harmonise_report(df: DataFrame, types: dict[str, str] = STUDENT_TYPES) -> DataFrame:
    """One row: rows in and out, duplicates, coerced columns, columns that needed filling."""
    unique = unique_columns(df)
    # distinct rows with the number of their copies, so one pass tells all counts
    copies = next(n for n in ("_copies" + "_" * i for i in range(len(unique.columns) + 1)) if n not in unique.columns)
    coerced = coerce_types(unique.groupBy(*[col(c) for c in unique.columns]).agg(F.count(F.lit(1)).alias(copies)), types)
    fillable = [f.name for f in coerced.schema.fields if f.name != copies and sentinel(f.dataType) is not None]
    filled = F.lit(0)
    for i in range(len(fillable)):
        filled = filled + (F.col(f"f{i}") > 0).cast("int")
    return (
        coerced.agg(
            F.count(F.lit(1)).alias("output_rows"),
            F.coalesce(F.sum(copies), F.lit(0).cast("bigint")).alias("initial_rows"),
            *[F.count_if(col(c).isNull()).alias(f"f{i}") for i, c in enumerate(fillable)],
        )
        .select(
            "initial_rows",
            (F.col("initial_rows") - F.col("output_rows")).alias("duplicates_removed"),
            F.lit(sum(c in types for c in unique.columns)).alias("columns_coerced"),
            filled.alias("nulls_filled"),
            "output_rows",
            F.lit(len(unique.columns)).alias("output_columns"),
        )
    )


def _overview(df: DataFrame, columns: Sequence[str], texts: Sequence[str]) -> tuple[list[str], dict[str, int]]:
    """Constant columns and rough level counts of the text columns; one job, one row back."""
    aggs = [F.coalesce(F.min(col(c)) == F.max(col(c)), F.lit(True)).alias(f"c{i}") for i, c in enumerate(columns)]
    aggs += [F.approx_count_distinct(col(c)).alias(f"t{i}") for i, c in enumerate(texts)]
    if not aggs:
        return [], {}
    row = df.agg(*aggs).first()
    constants = [c for i, c in enumerate(columns) if row[f"c{i}"]]
    return constants, {c: row[f"t{i}"] for i, c in enumerate(texts)}


def constant_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at most one distinct non-null value."""
    return _overview(df, columns, [])[0]


def categories(
    df: DataFrame, columns: Sequence[str], limit: int = 50, rough: dict[str, int] | None = None
) -> dict[str, list[str]]:
    """Sorted levels of the string columns that have at most ``limit`` of them.

    A rough count (``rough``, or counted here) first sorts out columns far above the limit, so that
    only a few times ``limit`` levels per column can reach the driver; those are counted exactly.
    """
    if rough is None:
        rough = _overview(df, [], columns)[1]
    candidates = [c for c in columns if rough[c] <= 2 * limit + 10]
    if not candidates:
        return {}
    levels = (
        df.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column"), col(c).alias("level")) for c in candidates]))
        )
        .where("level is not null")
        .distinct()
    )
    found: dict[str, list[str]] = {c: [] for c in candidates}
    for r in levels.collect():
        found[r["column"]].append(r["level"])
    return {c: sorted(v) for c, v in found.items() if len(v) <= limit}


def dummy_names(levels: dict[str, list[str]], taken: Sequence[str]) -> dict[tuple[str, str], str]:
    """``<column>_<level>`` reduced to letters, digits and underscores; a number ends a collision."""
    used, names = set(taken), {}
    for c, values in levels.items():
        for value in values:
            base = re.sub(r"[^A-Za-z0-9_]", "_", f"{c}_{value}")
            name, n = base, 2
            while name in used:
                name, n = f"{base}_{n}", n + 1
            used.add(name)
            names[c, value] = name
    return names


def one_hot(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Replace each listed column by one 0/1 column per level; original text is kept as metadata."""
    rest = [c for c in df.columns if c not in levels]
    names = dummy_names(levels, rest)
    dummies = [
        F.coalesce(col(c) == value, F.lit(False))
        .cast("int")
        .alias(name, metadata={"column": c, "level": value})
        for (c, value), name in names.items()
    ]
    return df.select(*[col(c) for c in rest], *dummies)


def clean(
    df: DataFrame,
    target: str = "second_year_ret_flag",
    entity: str = "student_id",
    max_categories: int = 50,
    drop_strings: bool = True,
    encode: bool = True,
    skip: Sequence[str] = NOT_FEATURES,
    keep_constant: Sequence[str] = KEPT_CONSTANTS,
) -> tuple[DataFrame, DataFrame]:
    """Numeric frame (the entity id apart) and a report of what happened to each column."""
    initial = list(df.columns)
    fate = {c: "skipped" for c in skip if c in df.columns and c != entity}
    df = df.drop(*fate)
    texts = [c for c in string_columns(df) if c != entity]
    checked = [c for c in df.columns if c not in keep_constant and c not in (target, entity)]
    constants, rough = _overview(df, checked, texts if encode else [])
    fate |= {c: "constant" for c in constants}
    df = df.drop(*constants)
    if encode:
        levels = categories(df, [c for c in texts if c not in constants], max_categories, rough)
        df = one_hot(df, levels)
        fate |= {c: f"encoded:{len(v)}" for c, v in levels.items()}
    if drop_strings:
        left = [c for c in string_columns(df) if c != entity]
        fate |= {c: "string" for c in left}
        df = df.drop(*left)
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    df = df.withColumns({c: col(c).cast("int") for c in flags}) if flags else df
    rows = [(c, fate.get(c, "kept")) for c in initial]
    return df, df.sparkSession.createDataFrame(rows, "column string, outcome string")


def student_features(columns: Sequence[str], first_cohort: Column | None = None, guarded: bool = False) -> dict[str, Column]:
    """Derived feature expressions, each only when its inputs exist.

    ``guarded`` computes the grade change only from two positive grades, as scoring requests do.
    """
    have = set(columns).issuperset
    out: dict[str, Column] = {}
    if have({"cumulative_gpa", "hs_gpa"}):
        change = F.col("cumulative_gpa") - F.col("hs_gpa")
        if guarded:
            change = F.when((F.col("cumulative_gpa") > 0) & (F.col("hs_gpa") > 0), change).otherwise(-1.0)
        out["gpa_change"] = change
        out["gpa_improved"] = S.positive_flag(change)
    if have({"term_gpa", "cumulative_gpa"}):
        out["gpa_momentum"] = S.guarded_ratio(F.col("term_gpa"), F.col("cumulative_gpa"), 1.0)
    if have({"credits_earned", "credits_attempted"}):
        out["credit_ratio"] = S.guarded_ratio(F.col("credits_earned"), F.col("credits_attempted"), 0.0)
        out["credit_deficit"] = F.col("credits_attempted") - F.col("credits_earned")
    if have({"efc", "total_aid_amount"}):
        coverage = S.guarded_ratio(F.col("total_aid_amount"), F.col("efc"), 0.0)
        out["aid_coverage_ratio"] = S.clipped(coverage, 0.0, 50.0)
    if have({"loan_amount", "total_aid_amount"}):
        out["loan_dependency"] = S.guarded_ratio(F.col("loan_amount"), F.col("total_aid_amount"), 0.0)
    if have({"campus_distance_miles"}):
        out["distance_bin"] = S.interval_bin(F.col("campus_distance_miles"), DISTANCE_EDGES)
    if have({"sat_score", "act_score"}):
        sat = S.scaled(F.col("sat_score"), 400, 1200)
        act = S.scaled(F.col("act_score"), 1, 35)
        out["test_score_composite"] = S.clipped((sat + act) / 2, 0.0, 1.0)
    if have({"cohort_year"}) and first_cohort is not None:
        out["cohort_recency"] = F.col("cohort_year") - first_cohort
    return out


def engineer_features(df: DataFrame, guarded: bool = False, first_cohort: int | None = None) -> DataFrame:
    """Add the derived features; infinities become NULL everywhere, then -1 in the new columns.

    ``first_cohort`` is the earliest cohort of the training data; where it is not given, this frame's.
    """
    first = df.agg(F.min("cohort_year")).scalar() if first_cohort is None and "cohort_year" in df.columns else first_cohort
    new = student_features(df.columns, first, guarded)
    wide = df.withColumns(new)
    out = []
    for f in wide.schema.fields:
        value = col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            value = S.finite(value)
        if f.name in new:
            value = F.coalesce(value, F.lit(-1).cast(f.dataType))
        out.append(value.alias(f.name))
    return wide.select(*out)


def export_features(
    df: DataFrame,
    entity: str = "student_id",
    features: Sequence[str] = EXPORT_FEATURES,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Entity id and the available listed features, one row per entity.

    Among several rows of an entity the one that comes first by ``order`` (all features unless
    given) is kept.
    """
    entity = entity if entity in df.columns else df.columns[0]
    available = [c for c in features if c in df.columns]
    return first_row(df.select(entity, *available, *[c for c in order or [] if c not in available]), entity, order or available).select(
        entity, *available
    )


def stage_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows and columns before and after a stage, and the columns it added and dropped."""
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    listed = lambda names: F.array(*[F.lit(c) for c in names]).cast("array<string>")
    one = after.sparkSession.range(1)
    return one.select(
        count(before).alias("input_rows"),
        F.lit(len(before.columns)).alias("input_columns"),
        count(after).alias("output_rows"),
        F.lit(len(after.columns)).alias("output_columns"),
        listed([c for c in after.columns if c not in before.columns]).alias("added"),
        listed([c for c in before.columns if c not in after.columns]).alias("dropped"),
    )


def export_report(df: DataFrame, exported: DataFrame, features: Sequence[str] = EXPORT_FEATURES) -> DataFrame:
    """One row: entities and features exported, and the listed features that were missing."""
    return exported.agg(F.count(F.lit(1)).alias("entities_synced")).select(
        "entities_synced",
        F.lit(len(exported.columns) - 1).alias("features_synced"),
        F.array(*[F.lit(c) for c in missing_features(df, features)]).cast("array<string>").alias("features_missing"),
    )


def missing_features(df: DataFrame, features: Sequence[str] = EXPORT_FEATURES) -> list[str]:
    return [c for c in features if c not in df.columns]


def latest_date_gap(
    events: DataFrame, key: str, kind: str, date: str, start: str, end: str, name: str = "gap_days"
) -> DataFrame:
    """Days between the latest ``start`` event and the latest ``end`` event of each key."""
    last = lambda value: F.max(F.when(F.col(kind) == value, F.col(date)))
    return events.groupBy(key).agg(S.days_between(last(end), last(start)).alias(name))


def running_standing(
    df: DataFrame, key: str, order: Sequence[str], value: str, below: dict[str, float], default: str, digits: int = 2
) -> DataFrame:
    """Cumulative mean of the value per key in order, and the first label whose limit it is below."""
    ones = df.withColumn("_one", F.col(value).isNotNull().cast("bigint"))
    sums = running_sums(ones, [key], order, [value, "_one"])
    average = F.round(F.try_divide(F.col(f"cum_{value}"), F.col("cum__one")), digits)
    label = F.lit(default)
    for name, limit in reversed(below.items()):
        label = F.when(F.col("average") < limit, name).otherwise(label)
    return sums.withColumn("average", average).withColumn("standing", label).drop("_one", f"cum_{value}", "cum__one")


def changed_from_previous(df: DataFrame, key: str, order: Sequence[str], value: str, name: str = "changed") -> DataFrame:
    """True where the value differs from the key's previous row; false on the first row."""
    before = previous_value(df, [key], order, value, "_previous")
    return before.withColumn(name, F.coalesce(F.col(value) != F.col("_previous"), F.lit(False))).drop("_previous")
