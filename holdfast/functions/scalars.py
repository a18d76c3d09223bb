"""Column expressions used by the preparation, privacy and scoring operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_number(c: Column) -> Column:
    """Lenient numeric cast: text that is no number, and NaN, become NULL."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def as_integer(c: Column) -> Column:
    return c.try_cast("bigint")


def as_flag(c: Column) -> Column:
    return c.try_cast("boolean")


def as_text(c: Column) -> Column:
    """String form; the literals ``nan`` and ``None`` stand for missing."""
    text = c.cast("string")
    return F.when(~text.isin("nan", "None"), text)


def finite(c: Column) -> Column:
    """Infinities become NULL."""
    return F.when(F.abs(c) != F.lit(float("inf")), c)


def guarded_ratio(numerator: Column, denominator: Column, default: float) -> Column:
    """``numerator / denominator`` where the denominator is positive, else the default."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(default))


def clipped(c: Column, low: float, high: float) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def positive_flag(c: Column) -> Column:
    return F.coalesce(c > 0, F.lit(False)).cast("int")


def interval_bin(c: Column, edges: Sequence[float]) -> Column:
    """Index of the interval ``(edges[i], edges[i+1]]`` (the first one closed on the left), else -1."""
    chain = F.when(c.isNull() | (c < edges[0]), -1)
    for i, upper in enumerate(edges[1:]):
        chain = chain.when(c <= upper, i)
    return chain.otherwise(-1)


def scaled(c: Column, low: float, span: float) -> Column:
    return (c - low) / span


def days_between(later: Column, earlier: Column) -> Column:
    return F.date_diff(later, earlier)


def outside(c: Column, low: float, high: float) -> Column:
    """Strictly outside the inclusive range; NULL is not a violation."""
    return (c < low) | (c > high)


def in_future(c: Column, as_of: Column) -> Column:
    """Later than ``as_of`` (midnight of the reference day); unparseable text counts as NULL."""
    return F.try_to_timestamp(c.cast("string")) > as_of.cast("timestamp")


def token(c: Column, label: str) -> Column:
    return F.when(c.isNotNull(), F.lit(f"[{label}]"))


def short_sha256(c: Column) -> Column:
    """First 16 hex characters of the SHA-256 of the string form."""
    return F.substring(F.sha2(c.cast("string"), 256), 1, 16)


def hash_number(*parts: Column) -> Column:
    """Deterministic whole number below 2^52 from the MD5 of the parts' text forms.

    It stands in for a seeded generator, and any engine with MD5 draws the same.
    """
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def hash_unit(*parts: Column) -> Column:
    """Deterministic uniform number in [0, 1) from a hash."""
    return hash_number(*parts).cast("double") / F.lit(float(1 << 52))


def cache_key(entity: Column) -> Column:
    return F.concat(F.lit("pred:"), entity.cast("string"))


def version_label(ts: Column) -> Column:
    return F.concat(F.lit("v1_"), F.date_format(ts, "yyyyMMdd_HHmmss"))
