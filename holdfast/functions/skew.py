"""Salting for equi-joins whose key may concentrate a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


#: Salts for rows without a key; they join nothing, so their number costs nothing.
KEYLESS = 4096


#: Groups of keys that are counted to tell whether any key can be hot.
GROUPS = 65_536


def may_be_hot(df: DataFrame, key: str, min_rows: int) -> bool:
    """Whether any key, or the rows without one, may number ``min_rows``; False is certain.

    Keys are counted by groups of a hash, so that little is shuffled whatever the number of keys.
    """
    group = F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(GROUPS)))
    counts = df.groupBy(group.alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    return not counts.where(F.col("_n") >= min_rows).isEmpty()


def hot_keys(df: DataFrame, key: str, share: float = 0.001, min_rows: int = 1_000_000, rows_per_salt: int = 500_000) -> DataFrame:
    """Keys holding more than ``share`` of the rows, hence fewer than ``1 / share`` of them, each with
    the number of salts (``_ways``) that leaves ``rows_per_salt`` rows to a salt."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    hot = counts.where((F.col("_n") >= min_rows) & (F.col("_n") > total * share))
    return hot.select(key, F.greatest(F.lit(2), F.ceil(F.col("_n") / rows_per_salt)).cast("int").alias("_ways"))


def salt_left(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Spread rows of hot keys over their salts, and rows without a key over many; all others get 0."""
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    marked = df.join(F.broadcast(hot), key, "left")
    ways = F.coalesce("_ways", F.when(F.col(key).isNull(), F.lit(KEYLESS)), F.lit(1))
    return marked.withColumn(SALT, F.pmod(spread, ways.cast("bigint")).cast("int")).drop("_ways")


def salt_right(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Repeat the matching rows of hot keys once per salt."""
    marked = df.join(F.broadcast(hot), key, "left")
    salts = F.sequence(F.lit(0), F.coalesce("_ways", F.lit(1)) - 1)
    return marked.withColumn(SALT, F.explode(salts)).drop("_ways")
