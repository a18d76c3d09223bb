"""Exact nearest neighbours without comparing all pairs.

Points are cut into boxes of bounded size, always across the widest side at approximate quantiles.
A query first searches its own box; its k-th distance then tells which other boxes can still hold a
closer point, and only those are searched.  Box borders steer the work, not the result.

* Inside a task a box is cut further, into leaves of some dozens of points. A query's cell of some hundreds
  bounds its k-th distance, and only leaves within that bound are compared with it.
* Equal points: at most k + 1 copies (those with the smallest ids) can be among anyone's k nearest,
  so further copies are left out of the candidates.  No box then holds more than its share.
* Many queries in one box are dealt out over salts, each with its own copy of the box.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from holdfast.session import materialise, stage

BOX_ROWS = (2000, 65_536)  # by the number of points: small frames are cut finer, so that all cores have boxes
MAX_BOXES = 50_000  # bounds what is sent to every task; beyond it boxes grow instead
QUERY_ROWS = 20000
LEAF, CELL = 64, 512  # points in a leaf of a task's tree, and in the cell that bounds a query's k-th distance
_BLOCK = 1_000_000  # distances held at a time inside a task


def _bounds(points: DataFrame, dim: int) -> list:
    """Box, size and lower and upper corner of every box."""
    side = [F.col("vec")[i] for i in range(dim)]
    return (
        points.groupBy("box")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.min(s) for s in side]).alias("lo"),
            F.array(*[F.max(s) for s in side]).alias("hi"),
        )
        .collect()
    )


def _cut(points: DataFrame, dim: int, box_rows: int) -> tuple[DataFrame, list[dict]]:
    """Split boxes until each holds at most ``box_rows`` points; returns the points and the cuts made.

    One row per box reaches the driver.  Every round splits a box up to 16 ways, so rounds grow
    with the logarithm of the data.
    """
    levels: list[dict] = []
    points = points.withColumn("box", F.lit(0).cast("bigint"))
    next_box = 1
    while True:
        large = {
            r["box"]: r
            for r in _bounds(points, dim)
            if r["n"] > box_rows and any(h > l for l, h in zip(r["lo"], r["hi"]))
        }
        if not large:
            return points, levels
        axis = {b: int(np.argmax(np.subtract(r["hi"], r["lo"]))) for b, r in large.items()}
        pieces = {b: int(min(16, -(-r["n"] // box_rows))) for b, r in large.items()}
        plan = points.sparkSession.createDataFrame(
            [(b, axis[b], pieces[b]) for b in large], "box bigint, axis int, pieces int"
        )
        grid = [i / 48 for i in range(1, 48)]
        quantiles = (
            points.join(F.broadcast(plan), "box")  # one row per box to split, under MAX_BOXES
            .groupBy("box")
            .agg(F.percentile_approx(F.get("vec", F.col("axis")), grid, 1000).alias("q"))
            .collect()
        )
        level = {}
        for r in quantiles:
            b = r["box"]
            wanted = [r["q"][max(0, round(48 * i / pieces[b]) - 1)] for i in range(1, pieces[b])]
            top = large[b]["hi"][axis[b]]
            cuts = sorted({c for c in wanted if c < top})
            if not cuts:  # most points share the top value; split it off
                # a midpoint of neighbouring floats may round up to the top, which would split nothing
                middle = large[b]["lo"][axis[b]] / 2 + top / 2
                cuts = [middle if middle < top else large[b]["lo"][axis[b]]]
            level[b] = (axis[b], cuts, next_box)
            next_box += len(cuts) + 1
        levels.append(level)
        points = _descend(points, level)


def _descend(frame: DataFrame, level: dict) -> DataFrame:
    """Move rows of split boxes into their piece: the number of cuts below the coordinate."""
    cuts = frame.sparkSession.createDataFrame(
        [(b, axis, borders, first) for b, (axis, borders, first) in level.items()],
        "box bigint, _axis int, _cuts array<double>, _first bigint",
    )
    moved = frame.join(F.broadcast(cuts), "box", "left")  # one row per split box
    at = F.get("vec", F.col("_axis"))
    piece = F.col("_first") + F.size(F.filter("_cuts", lambda c: c < at))
    return moved.withColumn("box", F.coalesce(piece, F.col("box"))).drop("_axis", "_cuts", "_first")


def nearest_in_box(k: int, keep_self: bool):
    """Nearest candidates of a box for its queries, block by block. A point is told by its ``mark``, whatever that is."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        queries, points = rows[rows["asking"]], rows[~rows["asking"]]
        columns = ["id", "neighbour", "distance", "nmark", "nlabel"]
        if not len(queries) or not len(points):
            return pd.DataFrame({c: pd.Series([], dtype=t) for c, t in zip(columns, ("int64", "int64", "float64", "object", "int32"))})
        points = points.sort_values("id", kind="stable").reset_index(drop=True)
        p = np.stack(points["vec"].to_numpy()).astype(np.float64, copy=False)
        pid, plabel = points["id"].to_numpy(), points["label"].to_numpy()
        pmark = points["mark"].to_numpy()
        found = []
        step = max(1, _BLOCK // len(p))
        for start in range(0, len(queries), step):
            block = queries.iloc[start : start + step]
            ids, q = block["id"].to_numpy(), np.stack(block["vec"].to_numpy()).astype(np.float64, copy=False)
            square = np.zeros((len(q), len(p)))
            for d in range(p.shape[1]):
                side = q[:, d, None] - p[None, :, d]
                side *= side
                square += side
            if not keep_self:
                at = np.searchsorted(pid, ids)
                own = np.flatnonzero((at < len(pid)) & (pid[np.minimum(at, len(pid) - 1)] == ids))
                square[own, at[own]] = np.inf
            take = min(k, len(p))
            limit = np.partition(square, take - 1, axis=1)[:, take - 1]
            # everything up to the k-th distance, so that ties resolve by id
            row, column = np.nonzero((square <= limit[:, None]) & np.isfinite(square))
            distance = np.sqrt(square[row, column])
            near = pd.DataFrame(
                {"id": ids[row], "neighbour": pid[column], "distance": distance, "at": column}
            )
            near = near.sort_values(["id", "distance", "neighbour"]).groupby("id", sort=False).head(k)
            found.append(near)
        out = pd.concat(found)
        out["nmark"] = pmark[out["at"].to_numpy()]
        out["nlabel"] = plabel[out["at"].to_numpy()]
        return out[columns]

    return search


FOUND = "id bigint, neighbour bigint, distance double, nvec array<double>, nlabel int"


def candidates_by_box(queries: DataFrame, points: DataFrame, query_rows: int, search, mark: str) -> DataFrame:
    """Run the search per (box, salt) over points with a ``mark`` of type ``mark``; a box with many queries gets several
    salts. The number of boxes has no bound, so only those with many queries are joined, and the size of their table decides how."""
    load = queries.groupBy("box").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("salts"))
    load = stage(load.where("salts > 1"), "crowded")
    salts = F.coalesce("salts", F.lit(1))
    dealt = queries.join(load, "box", "left").select(
        F.lit(True).alias("asking"), "box", F.pmod(F.xxhash64("id"), salts).cast("int").alias("salt"),
        "id", "vec", F.lit(None).cast("int").alias("label"), F.lit(None).cast(mark).alias("mark"),
    )
    copies = points.join(load, "box", "left").select(
        F.lit(False).alias("asking"), "box", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
        "id", "vec", "label", "mark",
    )
    rows = dealt.unionByName(copies)
    # light in bytes but heavy to compute: keep the partitions that size-based coalescing would merge
    context = rows.sparkSession
    tasks = max(int(context.conf.get("spark.sql.shuffle.partitions")), 4 * context.sparkContext.defaultParallelism)
    found = f"id bigint, neighbour bigint, distance double, nmark {mark}, nlabel int"
    return rows.repartition(tasks, "box", "salt").groupBy("box", "salt").applyInPandas(search, found)


class _Tree:
    """Points of one box in leaves, cut at medians across the widest side."""

    def __init__(self, points: np.ndarray):
        self.points, dim = points, points.shape[1]
        self.order = np.arange(len(points))
        leaves: list[tuple[int, int]] = []
        self.cells: list[tuple[int, int]] = []  # start and end of each cell's points
        self.cuts: dict[tuple[int, int], tuple[int, float, int]] = {}
        stack = [(0, len(points), False)]
        while stack:
            start, end, inside = stack.pop()
            rows = points[self.order[start:end]]
            side = rows.max(axis=0) - rows.min(axis=0)
            axis, size = int(np.argmax(side)), end - start
            if not inside and (size <= CELL or not side[axis] > 0):
                self.cells.append((start, end))
                inside = True
            if size <= LEAF or not side[axis] > 0:
                leaves.append((start, end))
                continue
            middle = size // 2
            at = np.argpartition(rows[:, axis], middle)
            self.order[start:end] = self.order[start:end][at]
            if not inside:
                self.cuts[start, end] = (axis, float(rows[at[middle], axis]), start + middle)
            stack += [(start + middle, end, inside), (start, start + middle, inside)]
        self.sorted = points[self.order]
        self.leaves = np.array(leaves, np.int64).reshape(-1, 2)
        self.lo = np.array([self.sorted[a:b].min(axis=0) for a, b in leaves]).reshape(-1, dim)
        self.hi = np.array([self.sorted[a:b].max(axis=0) for a, b in leaves]).reshape(-1, dim)

    def groups(self, queries: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Each cell with the queries that lie in it, at most ``2 * CELL`` at a time."""
        stack = [(0, len(self.points), np.arange(len(queries)))]
        while stack:
            start, end, rows = stack.pop()
            if not len(rows):
                continue
            if (start, end) not in self.cuts:
                for first in range(0, len(rows), 2 * CELL):
                    yield start, end, rows[first : first + 2 * CELL]
                continue
            axis, cut, middle = self.cuts[start, end]
            low = queries[rows, axis] < cut
            stack += [(middle, end, rows[~low]), (start, middle, rows[low])]


def _gaps(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance of every query to every box."""
    total = np.zeros((len(q), len(lo)))
    for d in range(q.shape[1]):
        side = np.maximum(lo[None, :, d] - q[:, d, None], q[:, d, None] - hi[None, :, d])
        np.maximum(side, 0.0, out=side)
        side *= side
        total += side
    return total


def _reached(q: np.ndarray, limit: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, box) no farther apart than the query's limit, for queries that lie together."""
    gap = np.maximum(np.maximum(lo - q.max(axis=0), q.min(axis=0) - hi), 0.0)
    near = np.flatnonzero((gap * gap).sum(axis=1) <= limit.max())
    row, at = np.nonzero(_gaps(q, lo[near], hi[near]) <= limit[:, None])
    return row, near[at]


_SLACK = 1 + 1e-9  # borders and bounds are rounded; exact distances decide


def _products(own: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by products, and what their rounding may amount to for each query."""
    norm, size = (own * own).sum(axis=1), (p * p).sum(axis=1)
    square = own @ p.T
    square *= -2.0
    square += size
    square += norm[:, None]
    return square, 1e-13 * (norm + size.max())


def _kth_within(q: np.ndarray, p: np.ndarray, k: int) -> np.ndarray:
    """A bound of each query's squared distance to its k-th nearest other point."""
    centre = q.min(axis=0) / 2 + q.max(axis=0) / 2
    square, grant = _products(q - centre, p - centre)
    return np.partition(square, k, axis=1)[:, k] + grant


def _close_pairs(tree: _Tree, q: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, place in the tree's order) within the limit, give or take rounding.

    Distances come from products around the queries' middle; the rounding of those is granted on top.
    """
    row, leaf = _reached(q, limit * _SLACK, tree.lo, tree.hi)
    by_leaf = np.argsort(leaf, kind="stable")
    row, leaf = row[by_leaf], leaf[by_leaf]
    starts = np.flatnonzero(np.diff(leaf, prepend=-1))
    centre = q.min(axis=0) / 2 + q.max(axis=0) / 2
    own = q - centre
    rows, places = [], []
    for first, last in zip(starts, np.append(starts[1:], len(leaf))):
        asked = row[first:last]
        a, b = tree.leaves[leaf[first]]
        square, grant = _products(own[asked], tree.sorted[a:b] - centre)
        i, j = np.nonzero(~(square > (limit[asked] * _SLACK + grant)[:, None]))  # what overflows stays
        rows.append(asked[i])
        places.append(a + j)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(places)


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, as the rows of a matrix."""
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))


def _nested(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _search_box(k: int, keep_self: bool, vectors: bool, corners: tuple[np.ndarray, np.ndarray, np.ndarray] | None):
    """A box's queries answered from its points: a row for each query with its nearest, k at most.

    With ``corners`` (numbers, lower and upper corners of all boxes) queries are in their own box, and a row
    without answers follows for each further box that their k-th distance reaches; else queries come with a reach.
    """
    schema = pa.schema([
        ("id", pa.int64()), ("vec", pa.list_(pa.float64())), ("box", pa.int64()), ("reach", pa.float64()),
        ("distance", pa.list_(pa.float64())), ("neighbour", pa.list_(pa.int64())), ("nlabel", pa.list_(pa.int32())),
        *([("nvec", pa.list_(pa.list_(pa.float64())))] if vectors else []),
    ])

    def answers(tree: _Tree | None, q, ids, reach, pid):
        """The k-th distance of each query, and its nearest as flat arrays with the query's place."""
        kth, found = np.full(len(q), np.inf), []
        if tree is None:
            return kth, found
        for start, end, rows in tree.groups(q):
            here, own_ids = q[rows], ids[rows]
            limit = np.full(len(rows), np.inf)
            if end - start > k:
                # one more than k, as the query itself may be among them
                limit = np.nan_to_num(_kth_within(here, tree.sorted[start:end], k), nan=np.inf)
            if reach is not None:
                limit = np.minimum(limit, reach[rows] * reach[rows])
            step = max(1, _BLOCK // len(tree.points)) if np.isinf(limit).any() else len(rows)
            for first in range(0, len(rows), step):
                part = slice(first, first + step)
                i, at = _close_pairs(tree, here[part], limit[part])
                i = i + first
                side = here[i] - tree.sorted[at]
                square = np.zeros(len(i))
                for d in range(side.shape[1]):
                    square += side[:, d] * side[:, d]
                distance, near = np.sqrt(square), pid[tree.order[at]]
                fine = np.isfinite(distance)
                if not keep_self:
                    fine &= near != own_ids[i]
                if reach is not None:
                    fine &= distance <= reach[rows][i]
                i, at, distance, near = i[fine], at[fine], distance[fine], near[fine]
                order = np.lexsort((near, distance, i))
                i = i[order]
                begins = np.flatnonzero(np.diff(i, prepend=-1))
                rank = np.arange(len(i)) - np.repeat(begins, np.diff(np.append(begins, len(i))))
                order, rank, i = order[rank < k], rank[rank < k], i[rank < k]
                last = rank == k - 1
                kth[rows[i[last]]] = distance[order[last]]
                found.append((rows[i], distance[order], near[order], tree.order[at[order]]))
        return kth, found

    def search(table: pa.Table) -> pa.Table:
        asking = table["asking"].to_numpy()
        points, queries = table.filter(pa.array(~asking)), table.filter(pa.array(asking))
        ids, q = queries["id"].to_numpy(), _vectors(queries["vec"])
        p = _vectors(points["vec"])
        pid, plabel = points["id"].to_numpy(), points["label"].combine_chunks()
        if not len(ids):
            return schema.empty_table()
        box = table["box"][0].as_py()
        reach = None if corners is not None else queries["reach"].to_numpy()
        fit = np.flatnonzero(np.isfinite(q).all(axis=1))
        tree = _Tree(p) if len(p) else None
        kth, found = answers(tree, q[fit], ids[fit], None if reach is None else reach[fit], pid)
        place, distance, near, at = (np.concatenate([f[c] for f in found]) if found else np.zeros(0, t)
                                     for c, t in enumerate((np.int64, np.float64, np.int64, np.int64)))
        order = np.argsort(place, kind="stable")
        place, distance, near, at = fit[place[order]], distance[order], near[order], at[order]
        ends = np.searchsorted(place, np.arange(len(ids) + 1))
        columns = [
            pa.array(ids), queries["vec"].combine_chunks().cast(schema.field("vec").type), pa.array(np.full(len(ids), box)),
            pa.array(np.full(len(ids), np.nan), from_pandas=True),
            _nested(distance, ends, pa.float64()), _nested(near, ends, pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), plabel.take(pa.array(at)).cast(pa.int32())),
        ]
        if vectors:
            inner = points["vec"].combine_chunks().cast(schema.field("vec").type).take(pa.array(at))
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner))
        out = [pa.Table.from_arrays(columns, schema=schema)]
        if corners is not None:
            all_kth = np.full(len(ids), np.inf)
            all_kth[fit] = kth
            if tree is None:  # a box may be empty
                further = np.repeat(np.arange(len(fit)), len(corners[0])), np.tile(corners[0], len(fit))
            else:
                further = _further(tree, q[fit], kth, box, corners)
            rows, boxes = fit[further[0]], further[1]
            empty = [pa.nulls(len(rows), f.type) for f in list(schema)[4:]]
            out.append(pa.Table.from_arrays([
                pa.array(ids[rows]), columns[1].take(pa.array(rows)), pa.array(boxes), pa.array(all_kth[rows]), *empty,
            ], schema=schema))
        return pa.concat_tables(out)

    return search, schema


def _further(tree: _Tree, q: np.ndarray, kth: np.ndarray, box: int, corners) -> tuple[np.ndarray, np.ndarray]:
    """Queries and the boxes, other than their own, that their k-th distance reaches."""
    numbers, lo, hi = corners
    rows, boxes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, _, group in tree.groups(q):
        # near ones first, so that a query with a far k-th neighbour does not widen the search of all
        group = group[np.argsort(kth[group], kind="stable")]
        for part in np.array_split(group, max(1, len(group) // 128)):
            row, at = _reached(q[part], kth[part] * kth[part] * _SLACK, lo, hi)
            other = numbers[at] != box
            rows.append(part[row[other]])
            boxes.append(numbers[at[other]])
    return np.concatenate(rows), np.concatenate(boxes)


def _searched(queries: DataFrame, points: DataFrame, query_rows: int, search, schema: pa.Schema) -> DataFrame:
    """Run the search per (box, salt); a box with many queries gets several salts."""
    load = queries.groupBy("box").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("salts"))
    load = F.broadcast(load)  # one row per box, MAX_BOXES or so of them
    reach = "reach" if "reach" in queries.columns else F.lit(None).cast("double").alias("reach")
    dealt = queries.join(load, "box").select(
        F.lit(True).alias("asking"), "box", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"),
        "id", "vec", F.lit(None).cast("int").alias("label"), reach,
    )
    copies = points.join(load, "box").select(
        F.lit(False).alias("asking"), "box", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        "id", "vec", "label", F.lit(None).cast("double").alias("reach"),
    )
    rows = dealt.unionByName(copies)
    # light in bytes but heavy to compute: keep the partitions that size-based coalescing would merge
    context = rows.sparkSession
    tasks = max(int(context.conf.get("spark.sql.shuffle.partitions")), 4 * context.sparkContext.defaultParallelism)
    return rows.repartition(tasks, "box", "salt").groupBy("box", "salt").applyInArrow(search, from_arrow_schema(schema))


def distinct_points(points: DataFrame, k: int) -> DataFrame:
    """Points without the copies that can be among nobody's k nearest."""
    # rows are ordered by the hash first, which is cheaper to compare than vectors
    copies = F.row_number().over(Window.partitionBy("_hash", "vec").orderBy("id"))
    hashed = points.withColumn("_hash", F.xxhash64("vec")).withColumn("_copy", copies)
    return hashed.where(F.col("_copy") <= k + 1).select("id", "vec", "label")


def search_block(k: int, keep_self: bool, block):
    """Searches queries that come with a reach (the distance of a k-th neighbour known so far, or none) among one
    broadcast block of points: their ids, vectors, labels and marks."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, p, plabel, pmark = block.value
        step = max(1, 4 * _BLOCK // max(1, len(p)))
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                ids, q = part["id"].to_numpy(), _vectors(pa.chunked_array([part["vec"]])).astype(np.float64, copy=False)
                reach = part["reach"].fill_null(np.inf).to_numpy(zero_copy_only=False)
                centre = q.min(axis=0) / 2 + q.max(axis=0) / 2
                square, grant = _products(q - centre, p - centre)
                if not keep_self:
                    for i in range(len(ids)):
                        square[i, np.searchsorted(pid, ids[i], "left") : np.searchsorted(pid, ids[i], "right")] = np.inf
                limit = reach * reach
                unknown = np.flatnonzero(np.isinf(limit))
                if len(unknown) and len(p) > k:
                    limit[unknown] = np.nan_to_num(np.partition(square[unknown], k - 1, axis=1)[:, k - 1] + grant[unknown], nan=np.inf)
                i, at = np.nonzero(~(square > (limit * _SLACK + grant)[:, None]))  # what overflows stays
                side = q[i] - p[at]
                total = np.zeros(len(i))
                for d in range(side.shape[1]):
                    total += side[:, d] * side[:, d]
                distance = np.sqrt(total)
                fine = np.isfinite(distance) & (distance <= reach[i])
                if not keep_self:
                    fine &= pid[at] != ids[i]
                i, at, distance = i[fine], at[fine], distance[fine]
                order = np.lexsort((pid[at], distance, i))
                i, at, distance = i[order], at[order], distance[order]
                begins = np.flatnonzero(np.diff(i, prepend=-1))
                rank = np.arange(len(i)) - np.repeat(begins, np.diff(np.append(begins, len(i))))
                i, at, distance = (a[rank < k] for a in (i, at, distance))
                told = [pa.array(ids[i]), pa.array(pid[at]), pa.array(distance), pmark.take(pa.array(at)), plabel.take(pa.array(at))]
                yield pa.RecordBatch.from_arrays(told, ["id", "neighbour", "distance", "nmark", "nlabel"])

    return search


def nearest_neighbours(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    box_rows: int | None = None,
    query_rows: int = QUERY_ROWS,
    keep_self: bool = False,
    vectors: bool = True,
) -> DataFrame:
    """(id, rank, neighbour, distance, nlabel, nvec): the k nearest points of every query.

    Both frames have ``id bigint, vec array<double>, label int``.  Ties go to the smaller id; a point
    with the query's own id is skipped unless ``keep_self``. Without ``vectors`` there is no ``nvec``.
    """
    found = FOUND if vectors else FOUND.replace(" nvec array<double>,", "")
    # what is not finite is at no finite distance from anything
    finite = points.where(F.forall("vec", lambda x: x - x == 0))
    distinct = materialise(distinct_points(finite, k))
    first = distinct.first()
    if first is None:
        return queries.sparkSession.createDataFrame([], f"{found}, rank int")
    n = distinct.count()
    if box_rows is None:
        cores = queries.sparkSession.sparkContext.defaultParallelism
        box_rows = min(max(BOX_ROWS[0], n // (4 * cores)), BOX_ROWS[1])
    boxed, levels = _cut(distinct, len(first["vec"]), max(box_rows, -(-n // MAX_BOXES)))
    asking = queries.select("id", "vec").withColumn("box", F.lit(0).cast("bigint"))
    for level in levels:
        asking = _descend(asking, level)
    bounds = _bounds(boxed, len(first["vec"]))
    corners = tuple(np.array([b[c] for b in bounds]) for c in ("box", "lo", "hi"))
    own = materialise(_searched(asking, boxed, query_rows, *_search_box(k, keep_self, vectors, corners)))
    near = ["distance", "neighbour", "nlabel", *(["nvec"] if vectors else [])]
    candidates = own.where("reach is null").select("id", *near)
    if len(bounds) > 1:
        further = own.where("reach is not null").select("id", "vec", "box", "reach")
        there = _searched(further, boxed, query_rows, *_search_box(k, keep_self, vectors, None))
        candidates = candidates.unionByName(there.where(F.size("neighbour") > 0).select("id", *near))
    # a query's candidates: k per box it reached
    gathered = F.flatten(F.collect_list(F.arrays_zip(*near)))
    best = F.slice(F.array_sort(gathered), 1, k)
    ranked = candidates.groupBy("id").agg(best.alias("near")).select("id", F.posexplode("near").alias("at", "near"))
    return ranked.select("id", *[F.col(f"near.{c}") for c in near], (F.col("at") + 1).alias("rank"))
