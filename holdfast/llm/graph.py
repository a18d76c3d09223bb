"""Connected components of written links, without any node's links meeting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, left: str, right: str, kind: str = "bigint") -> DataFrame:
    """node and component (its least node) of every node that has a link to another one."""
    return labels(stars(links, left, right, kind))


def labels(edges: DataFrame) -> DataFrame:
    """node and component: the least node among the neighbours in (u, v) of each node, or itself."""
    known = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), "v"))).alias("e"))
    return known.groupBy(F.col("e.u").alias("node")).agg(F.min("e.v").alias("component"))


def stars(links: DataFrame, left: str, right: str, kind: str = "bigint", rounds: int | None = None) -> DataFrame:
    """Edges (u, v) that connect the same nodes: each node with the least one of its component.

    With ``rounds`` it stops early: the edges connect the same nodes still, but not all with the least one.

    Large-star and small-star steps alternate until nothing changes: each node's links move to the
    least node it knows. Per node only a minimum is kept, the links join it as narrow rows, and each
    step is written, so a lost executor repeats one step.
    """
    a, b = F.col(left).cast(kind), F.col(right).cast(kind)
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stage(edges, "links")
    before = _state(edges)
    while before[0] and (rounds is None or rounds > 0):
        rounds = rounds - 1 if rounds is not None else None
        both = edges.union(edges.select("v", "u"))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where(F.col("u") != F.col("v")).distinct(), "links")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stage(moved.select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct(), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
