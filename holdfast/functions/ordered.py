"""Running totals, quantiles, average ranks and dense row numbers without a one-task sort.

A window over a whole table, or over a group that holds a third of it, would sort everything in
one task.  Here rows are first collapsed per (keys, value), values are cut into buckets at
approximate quantiles, the window runs inside (keys, bucket), and the totals of the earlier
buckets - at most ``buckets`` numbers per key - are added back.  Bucket borders only steer the
parallelism: results are exact for any borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def bucket_count(spark: SparkSession) -> int:
    """Power of two, at least the number of shuffle partitions, at most 4096."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(4096, 1 << max(2, (wanted - 1).bit_length()))


def bucket_of(value: Column, borders: Column, buckets: int) -> Column:
    """Number of borders below the value, by bisection."""
    steps = []
    step = buckets // 2
    while step:
        steps.append(F.lit(step))
        step //= 2
    return F.aggregate(
        F.array(*steps),
        F.lit(0),
        lambda at, s: at + F.when(F.get(borders, at + s - 1) < value, s).otherwise(0),
    )


def _with_buckets(
    df: DataFrame, keys: Sequence[str], order: str, read: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Add ``_bucket`` by the order column, and one non-null column standing for nullable keys.

    The border subquery also touches the ``read`` columns: it then scans exactly what the main plan
    scans, and Spark runs a shuffle below both only once.
    """
    buckets = bucket_count(df.sparkSession)
    position = F.col(order)
    if dict(df.dtypes)[order] in ("timestamp_ntz", "date"):
        position = position.cast("timestamp")
    position = position.cast("double")
    percentages = [i / buckets for i in range(1, buckets)]
    borders = df.agg(
        F.struct(
            F.percentile_approx(position, percentages, max(1000, 4 * buckets)).alias("at"),
            *[F.max(c).alias(f"_{i}") for i, c in enumerate([*keys, *read])],
        )
    ).scalar()
    # a subquery cannot stand inside the lambda, so it passes through a column
    placed = df.withColumn("_borders", borders)
    placed = placed.withColumn("_bucket", bucket_of(position, F.col("_borders.at"), buckets)).drop("_borders")
    nullable = any(f.nullable for f in df.schema.fields if f.name in keys)
    if not nullable:
        return placed, list(keys)
    # struct equality takes two nulls as equal, and keeps window and join on one partitioning
    return placed.withColumn("_key", F.struct(*keys)), ["_key"]


def _add_offsets(local: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = offsets.withColumnsRenamed({k: f"_r{i}" for i, k in enumerate([*keys, "_bucket"])})
    match = F.col("_bucket") == F.col(f"_r{len(keys)}")
    for i, k in enumerate(keys):
        match = match & (F.col(k) == F.col(f"_r{i}"))
    return local.join(renamed, match, "left").drop(*[f"_r{i}" for i in range(len(keys) + 1)])


def _earlier_buckets(keys: Sequence[str]):
    # at most `buckets` rows per key
    return Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_bucket")


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """All rows with ``cum_<sum>``, each sum over the key's rows up to the current one in order, and
    ``all_<sum>``, the sum over all the key's rows.

    The first order column must cast to a number (numbers, dates and timestamps do).
    """
    placed, by = _with_buckets(df, keys, order[0], sums)
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in sums])
    before = _earlier_buckets(by).rowsBetween(Window.unboundedPreceding, -1)
    whole = _earlier_buckets(by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (
        placed.groupBy(*by, "_bucket")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            *by,
            "_bucket",
            *[F.sum(c).over(before).alias(f"_off_{c}") for c in sums],
            *[F.sum(c).over(whole).alias(f"all_{c}") for c in sums],
        )
    )
    zero = {c: F.lit(0).cast(t) for c, t in placed.select(*[F.sum(c).alias(c) for c in sums]).dtypes}
    return _add_offsets(local, offsets, by).select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[
            (F.coalesce(f"_in_{c}", zero[c]) + F.coalesce(f"_off_{c}", zero[c])).alias(f"cum_{c}")
            for c in sums
        ],
        *[f"all_{c}" for c in sums],
    )


def running_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """All rows with the last non-null value among the key's rows up to the current one, NULL before the first."""
    placed, by = _with_buckets(df, keys, order[0], [value])
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select("*", F.last(value, ignorenulls=True).over(inside).alias("_in"))
    at = F.when(F.col(value).isNotNull(), F.struct(*order))
    last = placed.groupBy(*by, "_bucket").agg(F.max_by(value, at).alias("_last"))
    before = _earlier_buckets(by).rowsBetween(Window.unboundedPreceding, -1)
    offsets = last.select(*by, "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_before"))
    told = _add_offsets(local, offsets, by)
    return told.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("_in", "_before").alias(name))


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """All rows with the value of the key's row just before, NULL on its first row."""
    placed, by = _with_buckets(df, keys, order[0])
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    local = placed.select("*", F.lag(value).over(inside).alias("_lag"), F.row_number().over(inside).alias("_at"))
    last = placed.groupBy(*by, "_bucket").agg(F.max_by(F.struct(value), F.struct(*order)).alias("_last"))
    offsets = last.select(*by, "_bucket", F.lag("_last").over(_earlier_buckets(by)).alias("_before"))
    return _add_offsets(local, offsets, by).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.when(F.col("_at") > 1, F.col("_lag")).otherwise(F.col("_before")[value]).alias(name),
    )


def running_totals(df: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str]) -> DataFrame:
    """One row per (keys, order value): each sum column, ``cum_<sum>`` up to and including it and
    ``all_<sum>`` of the key."""
    collapsed = df.groupBy(*keys, order).agg(*[F.sum(c).alias(c) for c in sums])
    return running_sums(collapsed, keys, [order], sums)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float]
) -> DataFrame:
    """Linearly interpolated quantiles per key, NULLs skipped; ``probabilities`` names the outputs."""
    keys = list(keys)
    counted = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v"), F.lit(1).cast("bigint").alias("_n")
    )
    ranked = running_totals(counted, keys, "_v", ["_n"])
    picks = []
    for name, p in probabilities.items():
        at = (F.col("all__n") - 1) * F.lit(p)
        low = F.min(F.when(F.col("cum__n") > F.floor(at), F.col("_v")))
        high = F.min(F.when(F.col("cum__n") > F.ceil(at), F.col("_v")))
        share = F.max(at - F.floor(at))
        picks.append((low + (high - low) * share).alias(name))
    return ranked.groupBy(*keys).agg(*picks)


def average_ranks(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per (keys, value) with ``n`` copies and their shared (average) 1-based ``rank``."""
    ones = df.select(*keys, value, F.lit(1).cast("bigint").alias("n"))
    totals = running_totals(ones, keys, value, ["n"])
    return totals.select(
        *keys, value, "n", (F.col("cum_n") - (F.col("n") - 1) / F.lit(2.0)).alias("rank")
    )


def dense_index(fixed: DataFrame, name: str = "row_index") -> DataFrame:
    """Numbers 0..n-1 over the rows of a *materialised* frame, without a shuffle of the rows.

    ``monotonically_increasing_id`` is (partition, position); adding each partition's offset makes it
    dense.  The offset table has one row per partition.
    """
    tagged = fixed.withColumn("_mid", F.monotonically_increasing_id())
    part = F.shiftright("_mid", 33)
    position = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_off"))
    return (
        tagged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_off") + position)
        .drop("_mid", "_part", "_off")
    )
