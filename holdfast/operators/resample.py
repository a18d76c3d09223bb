"""Class balancing by interpolation between neighbours, and cleaning of the result.

Frames have ``id bigint, vec array<double>, label int``; synthetic rows get ids below zero.  Draws
come from hashes of ids and a seed, so a repeated task makes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.ordered import dense_index
from holdfast.functions.scalars import hash_number, hash_unit
from holdfast.operators.neighbours import nearest_neighbours
from holdfast.operators.projections import projected_neighbours
from holdfast.session import materialise

NEIGHBOURS = 5
CLEANING_NEIGHBOURS = 3
#: Vectors up to this length are searched by boxes and exactly; longer ones by projections, whose recall is measured.
EXACT_DIMENSIONS = 12
#: Draws of a base row that one task makes at most, and base rows in a block of running sums.
PIECE, BLOCK = 10_000, 100_000


class ResampleError(ValueError):
    """The strategy cannot be applied to this frame."""


def _class_counts(frame: DataFrame) -> tuple[int, int, int]:
    """Minority label, its count and the majority's count."""
    counts = {r["label"]: r["n"] for r in frame.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) != 2:
        raise ResampleError(f"two classes needed, found {sorted(counts)}")
    minority = min(counts, key=lambda c: (counts[c], c))
    return minority, counts[minority], sum(counts.values()) - counts[minority]


def _with_drawn_before(base: DataFrame) -> DataFrame:
    """Adds the sum of the quotas of all earlier rows, by blocks of rows and then within a block."""
    blocked = base.withColumn("_block", F.floor(F.col("row_index") / BLOCK))
    sums = blocked.groupBy("_block").agg(F.sum("quota").alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_block").orderBy("row_index").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocked.withColumn("_in", F.coalesce(F.sum("quota").over(within), F.lit(0)))
    return placed.join(sums, "_block").withColumn("drawn_before", F.col("_start") + F.col("_in")).drop("_block", "_in", "_start")


def _interpolate(base: DataFrame, quota: Column, neighbours: DataFrame, minority: int, seed: int) -> DataFrame:
    """``quota`` rows per base row, each on the line to a drawn neighbour.

    ``base`` carries ``row_index``; ``neighbours`` is the k-nearest table of the base rows, at most k
    short rows per id, which are gathered into one array.
    """
    around = neighbours.groupBy("id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "nvec"))), lambda s: s["nvec"]).alias("around")
    )
    # a row's quota is cut into pieces that are dealt out, so one row's draws need not be one task's
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("quota") - 1) / PIECE).cast("bigint"))
    wanted = _with_drawn_before(base.withColumn("quota", quota.cast("bigint")).where("quota > 0"))
    cut = wanted.withColumn("piece", F.explode(pieces)).repartition("id", "piece")
    first, last = F.col("piece") * PIECE + 1, F.least(F.col("quota"), (F.col("piece") + 1) * PIECE)
    drawn = cut.join(around, "id").withColumn("draw", F.explode(F.sequence(first, last)))
    pick = (hash_number(F.col("id"), F.col("draw"), F.lit(seed)) % F.size("around")).cast("int")
    step = hash_unit(F.col("id"), F.col("draw"), F.lit(seed + 1))
    return (
        drawn.withColumn("_to", F.get("around", pick))
        .withColumn("_step", step)
        .withColumn("_step_vec", F.transform("vec", lambda x: F.col("_step")))
        .select(
            # quotas differ by row; ids count down from -1 by the draws of earlier rows
            (-(F.col("drawn_before") + F.col("draw"))).alias("id"),
            F.zip_with(
                "vec", F.zip_with("_to", "_step_vec", lambda t, s: F.struct(t.alias("t"), s.alias("s"))),
                lambda x, ts: x + ts["s"] * (ts["t"] - x),
            ).alias("vec"),
            F.lit(minority).alias("label"),
        )
    )


def _fixed(frame: DataFrame) -> DataFrame:
    return materialise(frame.select(F.col("id").cast("bigint").alias("id"), "vec", F.col("label").cast("int").alias("label")))


def _neighbours(queries: DataFrame, points: DataFrame, k: int, vectors: bool = False) -> DataFrame:
    first = points.select("vec").first()
    if first is None or len(first["vec"]) <= EXACT_DIMENSIONS:
        return nearest_neighbours(queries, points, k, vectors=vectors)
    return projected_neighbours(queries, points, k, vectors=vectors)[0]


def smote(frame: DataFrame, k: int = NEIGHBOURS, seed: int = 42) -> DataFrame:
    """Add synthetic minority rows until the classes are equal."""
    frame = _fixed(frame)
    minority, few, many = _class_counts(frame)
    if few <= k:
        raise ResampleError(f"{few} minority rows, more than {k} needed")
    base = dense_index(frame.where(F.col("label") == minority))
    near = _neighbours(base, base, k, vectors=True)
    missing = many - few
    quota = F.lit(missing // few) + (F.col("row_index") < missing % few).cast("int")
    return frame.unionByName(_interpolate(base, quota, near, minority, seed))


def adasyn(frame: DataFrame, k: int = NEIGHBOURS, seed: int = 42) -> DataFrame:
    """Like SMOTE, with more synthetic rows where a minority row has more majority neighbours."""
    frame = _fixed(frame)
    minority, few, many = _class_counts(frame)
    if few <= k:
        raise ResampleError(f"{few} minority rows, more than {k} needed")
    base = dense_index(frame.where(F.col("label") == minority))
    hardness = (
        _neighbours(base, frame, k)
        .groupBy("id")
        .agg((F.count_if(F.col("nlabel") != minority) / F.lit(k)).alias("hardness"))
    )
    weighted = materialise(base.join(hardness, "id"))
    total = weighted.agg(F.sum("hardness")).first()[0]
    if not total:
        raise ResampleError("no minority row has a majority neighbour")
    quota = F.rint(F.col("hardness") / F.lit(total) * F.lit(many - few)).cast("bigint")
    near = _neighbours(base, base, k, vectors=True)
    return frame.unionByName(_interpolate(weighted, quota, near, minority, seed))


def tomek_links(frame: DataFrame) -> DataFrame:
    """Ids of rows in a link: mutual nearest neighbours of opposite class."""
    frame = _fixed(frame)
    nearest = _neighbours(frame, frame, 1).select("id", "neighbour", "nlabel")
    opposite = nearest.join(frame.select("id", "label"), "id").where("label <> nlabel")
    # a pair seen from both ends is mutual; counting pairs needs no join on a crowded neighbour
    pairs = opposite.groupBy(F.least("id", "neighbour").alias("a"), F.greatest("id", "neighbour").alias("b"))
    mutual = pairs.agg(F.count(F.lit(1)).alias("n")).where("n = 2")
    return mutual.select(F.explode(F.array("a", "b")).alias("id"))


def remove_tomek_links(frame: DataFrame) -> DataFrame:
    frame = _fixed(frame)
    return frame.join(tomek_links(frame), "id", "left_anti")


def edited(frame: DataFrame, k: int = CLEANING_NEIGHBOURS) -> DataFrame:
    """Keep rows whose k nearest neighbours all have their label."""
    frame = _fixed(frame)
    near = _neighbours(frame, frame, k)
    strangers = (
        near.join(frame.select("id", "label"), "id").where("label <> nlabel").select("id").distinct()
    )
    return frame.join(strangers, "id", "left_anti")


def smote_tomek(frame: DataFrame, seed: int = 42) -> DataFrame:
    return remove_tomek_links(smote(frame, seed=seed))


def smote_enn(frame: DataFrame, seed: int = 42) -> DataFrame:
    return edited(smote(frame, seed=seed))


STRATEGIES: dict[str, Callable[[DataFrame], DataFrame] | None] = {
    "none": None,
    "smote": smote,
    "adasyn": adasyn,
    "smotetomek": smote_tomek,
    "smoteenn": smote_enn,
}


def strategy(name: str):
    if name not in STRATEGIES:
        raise ValueError(f"unknown resampling strategy {name!r}")
    return STRATEGIES[name]
