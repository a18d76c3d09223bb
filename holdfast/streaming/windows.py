"""Tumbling-window metrics and threshold alerts over metric points (ts, series, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.ordered import exact_quantiles

FIVE_MINUTES = 300
ONE_MINUTE = 60


def _window(ts: str, seconds: int) -> Column:
    return F.window(F.col(ts), f"{seconds} seconds")


def windowed(
    points: DataFrame, ts: str, series: Sequence[str], seconds: int, measures: dict[str, Column], delay: str | None = None
) -> DataFrame:
    """Tumbling aggregate per series; with ``delay`` a watermark bounds the state of a stream."""
    frame = points.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay) if delay else points
    return (
        frame.groupBy(_window(ts, seconds).alias("_w"), *series)
        .agg(*[m.alias(name) for name, m in measures.items()])
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *series, *measures)
    )


def window_mean(points, ts, series, value, seconds=FIVE_MINUTES, delay=None):
    return windowed(points, ts, series, seconds, {"mean": F.avg(value)}, delay)


def window_sum(points, ts, series, value, seconds=FIVE_MINUTES, delay=None):
    return windowed(points, ts, series, seconds, {"total": F.sum(value)}, delay)


def window_rate(points, ts, series, error: Column, seconds=ONE_MINUTE, delay=None):
    """Requests and errors per second, and the error share of the window."""
    out = windowed(
        points, ts, series, seconds, {"requests": F.count(F.lit(1)), "errors": F.count_if(error)}, delay
    )
    return out.select(
        "*",
        (F.col("requests") / seconds).alias("requests_per_s"),
        (F.col("errors") / seconds).alias("errors_per_s"),
        F.try_divide("errors", "requests").alias("error_share"),
    )


def window_percentiles(points, ts, series, value, seconds=FIVE_MINUTES, delay=None):
    """Approximate median and 99th percentile, in batch or as a stream."""
    return windowed(
        points,
        ts,
        series,
        seconds,
        {"p50": F.percentile_approx(value, 0.5, 10000), "p99": F.percentile_approx(value, 0.99, 10000)},
        delay,
    )


def window_percentiles_exact(points, ts, series, value, seconds=FIVE_MINUTES):
    """Exact interpolated median and 99th percentile (batch only)."""
    framed = points.withColumn("window_start", _window(ts, seconds)["start"])
    return exact_quantiles(framed, ["window_start", *series], value, {"p50": 0.5, "p99": 0.99})


def threshold_alerts(windows: DataFrame, value: str, threshold: float) -> DataFrame:
    """Windows whose value exceeds the threshold (strictly)."""
    return windows.where(F.col(value) > threshold)


def sustained_alerts(
    windows: DataFrame, series: Sequence[str], value: str, threshold: float, seconds: int, duration: int
) -> DataFrame:
    """Windows that end a run of breaching windows covering at least ``duration`` seconds.

    A missing window breaks the run, as the range frame counts only windows inside the duration.
    The windows are aggregates already, so a partition holds one series' windows, not its points.
    """
    needed = max(1, -(-duration // seconds))
    epoch = F.col("window_start").cast("timestamp").cast("bigint")
    frame = Window.partitionBy(*series).orderBy("_epoch").rangeBetween(-(needed - 1) * seconds, 0)
    breach = (F.col(value) > threshold).cast("int")
    return (
        windows.withColumn("_epoch", epoch)
        .withColumn("breaching_windows", F.coalesce(F.sum(breach).over(frame), F.lit(0)))
        .where(F.col("breaching_windows") >= needed)
        .drop("_epoch")
    )
