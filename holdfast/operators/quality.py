"""Profiling and data checks.  Reports are long-form frames: one row per column or finding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.scalars import in_future, outside

# Valid ranges of the student measures.
STUDENT_RANGES = {
    "hs_gpa": (0.0, 4.0),
    "sat_score": (400, 1600),
    "act_score": (1, 36),
    "term_gpa": (0.0, 4.0),
    "cumulative_gpa": (0.0, 4.0),
    "efc": (0, 100000),
}


def col(name: str) -> Column:
    return F.col("`" + name + "`")


def numeric_columns(df: DataFrame, with_boolean: bool = False) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType)
        or (with_boolean and isinstance(f.dataType, T.BooleanType))
    ]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def date_like_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if "date" in c.lower() or c.endswith("_dt")]


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null distinct count per column, in one pass: (column, digest of the value) pairs are
    de-duplicated before the shuffle and counted after it.

    A digest is the hash of 64 bits, which differs for all numbers, flags and dates of a type, and beside it a second
    one of anything else, whatever its length. Zero counts once, with either sign.
    The hashes of a row are two arrays: a struct a column makes a method too long for the JVM to compile.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    single = (T.IntegralType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    plain = {c for c in columns if isinstance(types[c], single)}

    def digest(c: str, *seed: Column) -> Column:
        value = col(c) if c in plain else col(c).cast("string").cast("binary")
        return F.when(col(c).isNotNull(), F.xxhash64(*seed, value))

    wide = df.select(
        F.array(*[digest(c) for c in columns]).alias("first"),
        F.array(*[F.lit(None).cast("bigint") if c in plain else digest(c, F.lit("_")) for c in columns]).alias("second"),
    )
    names = F.array(*[F.lit(c) for c in columns])
    return (
        wide.select(F.posexplode("first").alias("i", "first"), "second")
        .where("first is not null")
        .select("i", "first", F.get("second", F.col("i")).alias("second"))
        .distinct()
        .groupBy("i")
        .agg(F.count(F.lit(1)).alias("distinct_count"))
        .select(F.get(names, F.col("i")).alias("column"), "distinct_count")
    )


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Type, nulls, distinct count and, for numbers and flags, min, max, mean and sample deviation.

    Every row is turned into (column, value) pairs that are folded per column before the shuffle, so
    wide tables cost one small aggregate instead of hundreds side by side.
    """
    columns = list(columns or df.columns)
    numbers = set(numeric_columns(df, with_boolean=True))
    types = dict(df.dtypes)

    def number(c: str) -> Column:
        if c not in numbers:
            return F.lit(None).cast("double")
        return col(c).cast("int").cast("double") if types[c] == "boolean" else col(c).cast("double")

    cells = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("i"),
                        col(c).isNull().alias("missing"),
                        number(c).alias("value"),
                        *([] if exact else [F.xxhash64(col(c)).alias("hash")]),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
    sketch = [] if exact else [F.approx_count_distinct(F.when(~F.col("missing"), F.col("hash"))).alias("distinct_count")]
    known = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype")) for c in columns])
    profile = (
        cells.groupBy("i")
        .agg(
            F.count_if("missing").alias("null_count"),
            F.round(F.avg(F.col("missing").cast("double")), 4).alias("null_pct"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.round(F.avg("value"), 4).alias("mean"),
            F.round(F.stddev_samp("value"), 4).alias("std"),
            *sketch,
        )
        .withColumn("_c", F.get(known, F.col("i")))
        .select("_c.column", "_c.dtype", "*")
        .drop("i", "_c")
    )
    if not exact:
        return profile
    return profile.join(distinct_counts(df, columns), "column", "left").fillna(0, ["distinct_count"])


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns that hold nulls, with count and rate."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"c{i}").alias("null_count"),
            F.round(F.try_divide(F.col(f"c{i}"), F.col("n")), 4).alias("null_pct"),
        )
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*rows))).where("null_count > 0")


def range_violations(df: DataFrame, rules: dict[str, tuple[float, float]]) -> DataFrame:
    """Number of values outside their inclusive range, per ruled column that is present."""
    rules = {c: r for c, r in rules.items() if c in df.columns}
    counts = df.agg(
        *[F.count_if(outside(col(c), lo, hi)).alias(f"c{i}") for i, (c, (lo, hi)) in enumerate(rules.items())]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(float(lo)).alias("low"),
            F.lit(float(hi)).alias("high"),
            F.col(f"c{i}").alias("violations"),
        )
        for i, (c, (lo, hi)) in enumerate(rules.items())
    ]
    return counts.select(F.inline(F.array(*rows)))


def range_examples(
    df: DataFrame, rules: dict[str, tuple[float, float]], order: Sequence[str], limit: int = 5
) -> DataFrame:
    """The first ``limit`` offending values per column in the order given; the limit is the report's."""
    from pyspark.sql import Window

    offending = df.select(
        *order,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.when(outside(col(c), lo, hi), col(c).cast("double")).alias("example"),
                    )
                    for c, (lo, hi) in rules.items()
                    if c in df.columns
                ]
            )
        ),
    ).where("example is not null")
    # row_number with a limit is cut down per input partition before it is shuffled
    place = F.row_number().over(Window.partitionBy("column").orderBy(*order, "example"))
    return offending.withColumn("position", place).where(F.col("position") <= limit).select(
        "column", "position", "example"
    )


def future_dates(df: DataFrame, as_of: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """Count of dates later than ``as_of`` per date-like column."""
    columns = list(columns or date_like_columns(df.columns))
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, future_count bigint")
    counts = df.agg(*[F.count_if(in_future(col(c), as_of)).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("future_count")) for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


def value_shares(df: DataFrame, column: str, name: str = "value") -> DataFrame:
    """Normalised counts of the non-null values."""
    counts = (
        df.where(col(column).isNotNull()).groupBy(col(column).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def class_balance(df: DataFrame, target: str, floor: float = 0.10) -> DataFrame:
    """Share of the rarest class and whether it is below the floor; a single class counts as 0."""
    return (
        value_shares(df, target)
        .agg(F.count(F.lit(1)).alias("n_classes"), F.min("share").alias("least"))
        .select(
            "n_classes",
            F.when(F.col("n_classes") > 1, F.col("least")).otherwise(0.0).alias("minority_share"),
        )
        .withColumn("imbalanced", F.col("minority_share") < floor)
    )


def anomalies(
    df: DataFrame,
    ranges: dict[str, tuple[float, float]],
    as_of: Column,
    target: str | None = None,
    warning_below: float = 0.05,
    floor: float = 0.10,
) -> DataFrame:
    """All findings of the checks: (type, column, severity, count)."""
    ranges = {c: r for c, r in ranges.items() if c in df.columns}
    checks = [("null_values", c, col(c).isNull()) for c in df.columns]
    checks += [("out_of_range", c, outside(col(c), lo, hi)) for c, (lo, hi) in ranges.items()]
    checks += [("future_date", c, in_future(col(c), as_of)) for c in date_like_columns(df.columns)]
    # all of them in one pass over the rows
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(test).alias(f"k{i}") for i, (_, _, test) in enumerate(checks)])
    rows = []
    for i, (kind, c, _) in enumerate(checks):
        severity = F.lit("ERROR")
        if kind == "null_values":
            rate = F.round(F.try_divide(F.col(f"k{i}"), F.col("n")), 4)
            severity = F.when(rate < warning_below, "WARNING").otherwise("ERROR")
        rows.append(
            F.struct(
                F.lit(kind).alias("type"), F.lit(c).alias("column"), severity.alias("severity"), F.col(f"k{i}").alias("count")
            )
        )
    out = counts.select(F.inline(F.array(*rows))).where(F.col("count") > 0)
    if target is not None and target in df.columns:
        out = out.unionByName(
            class_balance(df, target, floor)
            .where("imbalanced")
            .select(
                F.lit("class_imbalance").alias("type"),
                F.lit(target).alias("column"),
                F.lit("WARNING").alias("severity"),
                F.col("n_classes").alias("count"),
            )
        )
    return out


def anomaly_summary(findings: DataFrame) -> DataFrame:
    return findings.agg(
        F.count(F.lit(1)).alias("anomaly_count"),
        F.count_if(F.col("severity") == "ERROR").alias("error_count"),
        F.count_if(F.col("severity") == "WARNING").alias("warning_count"),
    )


def gate(findings: DataFrame, threshold: int) -> None:
    """Raise when the number of ERROR findings exceeds the threshold; 0 switches the gate off."""
    if threshold <= 0:
        return
    errors = findings.where(F.col("severity") == "ERROR").count()
    if errors > threshold:
        raise ValueError(f"{errors} validation errors exceed the threshold of {threshold}")


def domain_violations(df: DataFrame, domains: dict[str, Sequence]) -> DataFrame:
    """Distinct values outside the allowed list, with their counts."""
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.when(~col(c).isin(list(allowed)), col(c).cast("string")).alias("value"),
                    )
                    for c, allowed in domains.items()
                ]
            )
        )
    )
    return pairs.where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def schema_differences(expected: Sequence[str], df: DataFrame) -> DataFrame:
    """Column names as (column, status): common, missing or extra."""
    have, want = set(df.columns), set(expected)
    rows = [(c, "common" if c in have else "missing") for c in sorted(want)]
    rows += [(c, "extra") for c in sorted(have - want)]
    return df.sparkSession.createDataFrame(rows, "column string, status string")


def quality_rates(df: DataFrame, rates: dict[str, tuple[Column | None, Column]]) -> DataFrame:
    """Named rates in one pass: each is the mean of an expression over an optional row filter."""
    return df.agg(
        *[
            F.avg(F.when(where, value.cast("double")) if where is not None else value.cast("double")).alias(name)
            for name, (where, value) in rates.items()
        ]
    )


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL for a constant column."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def leakage(df: DataFrame, target: str, columns: Sequence[str] | None = None, limit: float = 0.99) -> DataFrame:
    """Per feature: correlation with the target, equality with it, and the resulting flag."""
    columns = [c for c in (columns or numeric_columns(df)) if c != target]
    aggs = []
    for i, c in enumerate(columns):
        aggs.append(pearson(col(c), col(target)).alias(f"r{i}"))
        aggs.append(F.bool_and(col(c).cast("double").eqNullSafe(col(target).cast("double"))).alias(f"e{i}"))
    rows = [
        F.struct(
            F.lit(c).alias("feature"), F.col(f"r{i}").alias("correlation"), F.col(f"e{i}").alias("identical")
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows))).withColumn(
        "leaks", F.coalesce(F.abs("correlation") > limit, F.lit(False)) | F.col("identical")
    )
