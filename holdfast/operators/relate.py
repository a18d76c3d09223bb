"""Joins and per-key selection: latest values, suffix renames, the analysis-frame merge, key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import skew
from holdfast.functions.scalars import hash_number


def latest_values(
    df: DataFrame, key: str, order: Sequence[str], values: Sequence[str] | None = None, hot_rows: int = 1_000_000
) -> DataFrame:
    """Latest non-null value of every column per key, by the order columns.

    Columns are picked one by one, so a row may mix values of several input rows.
    A partial aggregate runs before the shuffle, so a hot key costs no more than any other. With several order
    columns its rows are many times as wide as those it reads, as each value keeps its order; where a count finds
    no key of ``hot_rows`` rows, each key's rows are therefore put in order once, for all values.
    """
    values = [c for c in (values or df.columns) if c != key]
    if len(order) > 1 and not skew.may_be_hot(df, key, hot_rows):
        latest_first = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
        whole = latest_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        picked = df.select(
            key,
            *[F.first(c, ignorenulls=True).over(whole).alias(c) for c in values],
            F.row_number().over(latest_first).alias("_place"),
        )
        return picked.where("_place = 1").drop("_place")
    # a single number keeps the aggregate on hashes; a struct of tie-breaks makes it sort
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return df.groupBy(key).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c) for c in values]
    )


def latest_row(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The one real row per key that comes last by the order columns."""
    rest = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(best).select(key, "_row.*")


def first_row(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row per key that comes first by the order columns."""
    rest = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(best).select(key, "_row.*").select(*df.columns)


def with_suffix(right: DataFrame, left_columns: Sequence[str], key: str, suffix: str) -> DataFrame:
    """Rename right-hand columns that the left side already has; the key keeps its name."""
    taken = set(left_columns) - {key}
    return right.select(
        *[F.col(f"`{c}`").alias(c + suffix) if c in taken else F.col(f"`{c}`") for c in right.columns]
    )


def merge_tables(
    events: DataFrame,
    key: str,
    sides: Sequence[tuple[DataFrame | None, str]],
    keep: Column | None = None,
    hot_share: float = 0.001,
    hot_rows: int = 1_000_000,
    rows_per_salt: int = 500_000,
) -> DataFrame:
    """Filtered events left-joined to each (table, suffix); absent tables (None) are skipped.

    Rows of a hot key are spread over salts once, as many as its rows ask for, and every side is joined
    on (key, salt), so the event side is shuffled once for all joins and no key fills a task. Where a count
    finds no key that can be hot, the join is by the key alone, and what is grouped by it stays in place.
    """
    base = events.where(keep) if keep is not None else events
    present = [(side, suffix) for side, suffix in sides if side is not None]
    if not present:
        return base
    columns = list(base.columns)
    salted = skew.may_be_hot(base, key, hot_rows)
    hot = skew.hot_keys(base, key, hot_share, hot_rows, rows_per_salt) if salted else None
    merged = skew.salt_left(base, key, hot) if salted else base
    for side, suffix in present:
        right = with_suffix(side, columns, key, suffix)
        columns += [c for c in right.columns if c != key]
        if salted:
            merged = merged.join(skew.salt_right(right, key, hot), [key, skew.SALT], "left")
        else:
            merged = merged.join(right, key, "left")
    return merged.select(*[F.col(f"`{c}`") for c in columns])


def merge_students(tables: dict[str, DataFrame]) -> DataFrame:
    """The student analysis frame: one row per enrolment event."""
    academic = tables.get("academic_records")
    # terms of one code are told apart by all their values, so each run takes the same one
    ties = [c for c in academic.columns if c not in ("student_id", "term_code")] if academic is not None else []
    latest = latest_values(academic, "student_id", ["term_code", *ties]) if academic is not None else None
    return merge_tables(
        tables["enrollment_events"],
        "student_id",
        [(tables.get("demographics"), "_demo"), (tables.get("financial_aid"), "_fin"), (latest, "_acad")],
        keep=F.col("event_type") == "enrollment",
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (a right side that would multiply join output)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct child keys without a parent.  Both sides are reduced to distinct keys first."""
    keys = child.select(F.col(child_key).alias("key")).where("key is not null").distinct()
    known = parent.select(F.col(parent_key).alias("key")).distinct()
    return keys.join(known, "key", "left_anti")


def align_distributions(left: DataFrame, right: DataFrame, key: str, share: str) -> DataFrame:
    """Full outer alignment of two (key, share) tables; a share missing on one side is 0."""
    a = left.select(key, F.col(share).alias("p"))
    b = right.select(key, F.col(share).alias("q"))
    return a.join(b, key, "full").select(
        key, F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("q", F.lit(0.0)).alias("q")
    )


def share_assignment(df: DataFrame, key: str, splits: dict[str, int], seed: int = 42) -> DataFrame:
    """Assign each key to a named share of traffic; percentages sum to 100."""
    if sum(splits.values()) != 100:
        raise ValueError("traffic percentages must sum to 100")
    draw = hash_number(F.col(key), F.lit(seed)) % 100
    upper, chain = 0, None
    for name, percent in splits.items():
        upper += percent
        chain = F.when(draw < upper, name) if chain is None else chain.when(draw < upper, name)
    return df.withColumn("assigned_version", chain)
