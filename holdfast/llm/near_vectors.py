"""Near vectors of one label: binary codes, multi-index tables, exact cosine.

Vectors are centred, and rotated so that the signs of their coordinates lose little (iterative
quantisation, fitted on a bounded sample). The signs are the code, cut into tables of ``WIDTH`` bits.
Two vectors are candidates if in some table their bits differ in one place at most: a vector is stored
under its own bits and probes these and their neighbours. A pair found in several tables is taken in
the first. Candidates whose whole codes are close are compared by cosine in double precision, unless a few
coordinates of both show that it cannot reach the threshold: those alone meet in the buckets, so only
pairs that may be links fetch their vectors.

Equal vectors of one label are one point with a number of copies, so a common vector is
one row. Defined results: vectors that are null, empty, zero or hold null or non-finite components, and
vectors without a label, link with nothing; vectors of different lengths are not compared; rows without
an id are left out and rows with equal ids count once; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import stage
from holdfast.llm.graph import components

#: Bits of a code and of a table, differing bits at which whole codes still count as close, sampled vectors.
BITS, WIDTH, RADIUS, SAMPLE = 64, 10, 26, 10_000
THRESHOLD = 0.93
#: Coordinates of a sketch, its steps in one, and what its rounding may take from a bound, many times over.
COORDINATES, STEPS, SLACK = 16, 32_767, 1e-3


def learn_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Centre and projection of unit vectors onto ``bits`` coordinates whose signs are the code.

    Principal axes first (with random directions where there are fewer than bits), then turns that
    bring the coordinates nearest to their signs: sign, orthogonal Procrustes, and again.
    """
    rng = np.random.default_rng(seed)
    size = sample.shape[1]
    centre = sample.mean(axis=0) if len(sample) else np.zeros(size)
    x = sample - centre
    _, axes = np.linalg.eigh(x.T @ x + 1e-9 * np.eye(size))
    axes = axes[:, ::-1][:, :bits]
    if size < bits:
        axes = np.hstack([axes, rng.normal(size=(size, bits - size)) / np.sqrt(size)])
    turn = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    projected = x @ axes
    for _ in range(rounds if len(sample) > 1 else 0):
        left, _, right = np.linalg.svd(np.where(projected @ turn > 0, 1.0, -1.0).T @ projected)
        turn = (left @ right).T
    return centre, axes @ turn


def _units(vectors: list, size: int) -> np.ndarray:
    out = np.zeros((len(vectors), size))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    # scaled first, so that squares neither overflow nor vanish
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _sketches(units: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Coordinates along the basis and the length of what is left: the products of two rows add up to no less
    than the cosine of their vectors."""
    along = units @ basis
    rest = np.sqrt(np.maximum(1 - (along * along).sum(axis=1), 0))
    return np.rint(np.column_stack([along, rest]) * STEPS).astype(np.int16)


def _points(vectors: DataFrame) -> DataFrame:
    """A row per distinct usable vector: point (its least id), label, vector, copies; and the rows they stand for."""
    usable = vectors.where(F.col("label").isNotNull() & (F.size("vector") > 0))
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    return usable.where(F.coalesce(fine, F.lit(False)))


def linked_points(points: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """a, b (a < b) of all found pairs of points (point, label, vector) with a cosine of at least ``threshold``."""
    size = points.agg(F.max(F.size("vector"))).first()[0]
    if size is None:
        return points.sparkSession.createDataFrame([], "a bigint, b bigint")
    chosen = points.orderBy(F.xxhash64("point"), "point").select("point").limit(sample)
    drawn = [r[0] for r in points.join(F.broadcast(chosen), "point", "left_semi").orderBy("point").select("vector").collect()]
    drawn = _units(drawn, size)
    centre, turn = learn_rotation(drawn)
    basis = np.linalg.eigh(drawn.T @ drawn)[1][:, ::-1][:, :COORDINATES]
    sent = points.sparkSession.sparkContext.broadcast((centre, turn, basis))
    tables = [(k, min(WIDTH, BITS - k)) for k in range(0, BITS, WIDTH)]
    if tables[-1][1] < WIDTH:  # bits left over widen the last table
        tables = tables[:-2] + [(tables[-2][0], tables[-2][1] + tables[-1][1])]

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centre, turn, basis = sent.value
        weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
        for batch in batches:
            units = _units(batch["vector"].tolist(), len(centre))
            signs = (units - centre) @ turn > 0
            codes = (signs * weights).sum(axis=1, dtype=np.uint64).view(np.int64)
            yield batch[["point", "label", "size"]].assign(code=codes, sketch=[row.tobytes() for row in _sketches(units, basis)])

    kinds = dict(points.dtypes)
    sized = points.withColumn("size", F.size("vector"))
    codes = stage(sized.mapInPandas(code, f"point bigint, label {kinds['label']}, size int, code bigint, sketch binary"), "codes")

    def bits(name: str, place: int, width: int) -> str:
        return f"((shiftrightunsigned({name}, {place}) & {(1 << width) - 1}L))"

    stored = F.array(*[F.struct(F.lit(i).alias("t"), F.expr(bits("code", p, w)).alias("slot")) for i, (p, w) in enumerate(tables)])
    tried = [F.struct(F.lit(i).alias("t"), F.expr(f"{bits('code', p, w)} ^ {flip}L").alias("slot")) for i, (p, w) in enumerate(tables) for flip in [0] + [1 << b for b in range(w)]]
    left = codes.select("label", "size", F.col("point").alias("a"), F.col("code").alias("x"), F.col("sketch").alias("sx"), F.explode(stored).alias("s")).select("label", "size", "a", "x", "sx", "s.*")
    right = codes.select("label", "size", F.col("point").alias("b"), F.col("code").alias("y"), F.col("sketch").alias("sy"), F.explode(F.array(*tried)).alias("s")).select("label", "size", "b", "y", "sy", "s.*")
    first = "CASE " + " ".join(f"WHEN bit_count({bits('(x ^ y)', p, w)}) <= 1 THEN {i}" for i, (p, w) in enumerate(tables)) + " END"

    def hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                u, v = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int16).reshape(batch.num_rows, -1) for c in (2, 3))
                bound = np.einsum("ij,ij->i", u, v, dtype=np.float64) / STEPS**2
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(bound >= threshold - SLACK))

    # Spark does not count the exploded rows of a small table, and would gather them all in the driver to broadcast them
    met = left.hint("merge").join(right, ["label", "size", "t", "slot"]).where("a < b").where(F.expr(f"bit_count(x ^ y) <= {RADIUS}") & (F.expr(first) == F.col("t")))
    met = stage(met.select("a", "b", "sx", "sy").mapInArrow(hopeful, "a bigint, b bigint"), "vector-pairs")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                width = max(map(len, batch["u"]))
                cosine = np.einsum("ij,ij->i", _units(batch["u"].tolist(), width), _units(batch["v"].tolist(), width))
                yield batch[["a", "b"]][cosine >= threshold]

    u = points.select(F.col("point").alias("a"), F.col("vector").alias("u"))
    v = points.select(F.col("point").alias("b"), F.col("vector").alias("v"))
    return met.join(u, "a").join(v, "b").select("a", "b", "u", "v").mapInPandas(compare, "a bigint, b bigint")


def near_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id and kept, a row per vector."""
    rows = table.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull()).dropDuplicates(["vec_id"])
    usable = _points(rows).withColumn("key", F.sha2(F.to_json(F.struct("vector")), 256))
    points = usable.groupBy("label", "key").agg(F.min("vec_id").alias("point"), F.count(F.lit(1)).alias("copies"), F.min("vector").alias("vector"))
    points = stage(points, "points")
    links = stage(linked_points(points.select("point", "label", "vector"), threshold), "vector-links")
    both = links.select(F.col("a").alias("point"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("point"), F.col("a").alias("other")))
    weight = points.select(F.col("point").alias("other"), F.col("copies").alias("weight"))
    degrees = both.join(weight, "other").groupBy("point").agg(F.sum("weight").alias("linked"))
    found = components(links, "a", "b").withColumnRenamed("node", "point")
    told = points.select("label", "key", "point", "copies").join(degrees, "point", "left").join(found, "point", "left")
    told = told.select("label", "key", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "point").alias("component"))
    told = stage(told, "told-points")
    keyed = rows.select("vec_id").join(usable.select("vec_id", "label", "key"), "vec_id", "left").join(told, ["label", "key"], "left")
    out = keyed.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
