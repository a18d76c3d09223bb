"""Sketches stored for each short window, merged to longer ones without reading the points again.

A row holds the counts of a window's points and two mergeable sketches: quantiles of the values (KLL) and
distinct entities (HyperLogLog). Both are built-in aggregates with a partial step, so no group has to fit a
task. Rows lie in a folder for each day; storing a day's points again replaces that day only.

Null and NaN values count as points but have no place among the quantiles; a window without values has NULL
quantiles. The rank of a quantile is off by about 2.3 / k ** 0.9 of the values at most (99 % of times), and it is
the smallest value that reaches the rank; windows of up to k values are exact. Counts of entities are off by
about 1.04 / sqrt(2 ** lg) (one deviation), null entities are not counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Accuracy of the two sketches.
QUANTILE_K, DISTINCT_LG = 1024, 12
MINUTE = 60


def _start(ts: str, seconds: int):
    """Start of the window of that many seconds since the epoch."""
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    return F.timestamp_seconds(F.floor(second / seconds) * seconds)


def sketched(points: DataFrame, ts: str, series: Sequence[str], value: str, entity: str, seconds: int = MINUTE, k: int = QUANTILE_K) -> DataFrame:
    """One row per (window, series): ``points``, ``value_count``, ``value_sketch`` and ``entity_sketch``."""
    number = F.col(value).cast("double")
    usable = F.when(~F.isnan(number), number)
    return (
        points.where(F.col(ts).isNotNull())
        .groupBy(_start(ts, seconds).alias("window_start"), *series)
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.count(usable).alias("value_count"),
            F.kll_sketch_agg_double(usable, k).alias("value_sketch"),
            F.hll_sketch_agg(F.col(entity), DISTINCT_LG).alias("entity_sketch"),
        )
    )


def store(sketches: DataFrame, folder: str) -> None:
    """Write sketches into a folder per day; days that are not among them stay as they are."""
    day = F.floor(F.unix_seconds("window_start") / 86400)
    dated = sketches.withColumn("day", F.date_from_unix_date(day.cast("int")))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def merged(
    sketches: DataFrame, series: Sequence[str], seconds: int | None, quantiles: dict[str, float], k: int = QUANTILE_K
) -> DataFrame:
    """Points, quantiles and distinct entities of longer windows, or over all time if ``seconds`` is None."""
    window = [] if seconds is None else [_start("window_start", seconds).alias("window_start")]
    totals = sketches.groupBy(*window, *series).agg(
        F.sum("points").alias("points"),
        F.sum("value_count").alias("value_count"),
        F.kll_merge_agg_double("value_sketch", k).alias("_values"),
        F.hll_union_agg("entity_sketch").alias("_entities"),
    )
    at = lambda q: F.when(F.col("value_count") > 0, F.kll_sketch_get_quantile_double("_values", F.lit(float(q))))
    return totals.select(
        *[c for c in totals.columns if not c.startswith("_")],
        *[at(q).alias(name) for name, q in quantiles.items()],
        F.hll_sketch_estimate("_entities").alias("entities"),
    )
