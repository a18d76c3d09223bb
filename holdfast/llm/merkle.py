"""A dataset manifest as trees of digests, with one multiproof for all leaves of a block.

Every row is a leaf; the leaves of a group form a tree in which runs of three become their digest, and
the roots of the groups form a tree of the same kind. A block of neighbouring leaves needs only the nodes
that it cannot derive itself: their coordinates (tree, level, place) are worked out from the leaves'
places alone, level by level from the bottom, so that each is asked for once. All blocks fetch theirs in
one join. Then each block derives the inner nodes that its leaves share, up to the root, and expands
the proof of each leaf from them.

The digest H of values is the SHA-256, in lowercase hexadecimal, of the values one after the other; a
leaf is H of its columns, each as the number of its UTF-8 bytes, a colon and the value, or ``-`` if null.

Defined results: a null group is a group of its own, before all others; null keys come first; rows with
equal keys follow each other by leaf; equal rows are separate leaves; an empty table has no root;
a null text, empty and very long texts are values like any other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import bounded, spark_schema, stage
from holdfast.llm.ordering import numbered

#: Children of a node, levels that a task builds at once, and so the leaves of a block.
RUN, LEVELS = 3, 4
BLOCK = RUN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the roots of the groups.
TOP = -1
#: Blocks that ask for one node under one key; nodes near a root are given in several copies.
ASKERS = 1000


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """The digest of a row."""
    told = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.sha2(F.concat(*told), 256)


@dataclass
class Manifest:
    """blocks: tree, n, block and the leaves at their places; nodes: tree, level, place, digest; trees: group, tree, n."""

    blocks: DataFrame
    nodes: DataFrame
    trees: DataFrame
    top_blocks: DataFrame

    def given(self) -> DataFrame:
        """The nodes of all levels; the leaves are those of level 0."""
        out = self.nodes.select("tree", "level", "place", "digest")
        for blocks in (self.blocks, self.top_blocks):
            leaves = blocks.select("tree", F.lit(0).alias("level"), F.explode("entries").alias("e"))
            out = out.unionByName(leaves.select("tree", "level", F.col("e.place"), F.col("e.digest")))
        return out


def _blocks(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (tree, n, place, ...) as arrays of up to ``BLOCK`` neighbours."""
    block = F.floor(F.col("place") / BLOCK).alias("block")
    entry = F.struct("place", *columns)
    return rows.groupBy("tree", "n", block).agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def _build(blocks: DataFrame, base: int) -> DataFrame:
    """The nodes above the entries of full blocks, which are the nodes of level ``base``, by up to ``LEVELS`` levels."""
    schema = spark_schema("tree bigint, n bigint, level int, place bigint, digest binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                width = row["n"]
                for _ in range(base):
                    width = -(-width // RUN)
                place = row["entries"][0]["place"]
                nodes = [e["digest"].hex() for e in row["entries"]]
                for level in range(base + 1, base + LEVELS + 1):
                    if width == 1:
                        break
                    nodes = [digest(*nodes[i : i + RUN]) for i in range(0, len(nodes), RUN)]
                    width, place = -(-width // RUN), place // RUN
                    out += [(row["tree"], row["n"], level, place + i, bytes.fromhex(d)) for i, d in enumerate(nodes)]
            yield _batch(out, schema)

    return blocks.select("tree", "n", "entries").mapInArrow(work, schema)


def _batch(rows: list[tuple], schema) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = zip(*rows) if rows else [[] for _ in arrow]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _nodes(blocks: DataFrame, height: int) -> DataFrame:
    """All nodes above the leaves."""
    made = stage(_build(blocks, 0), "nodes")
    every = made
    for base in range(LEVELS, height, LEVELS):
        # a tree whose root lies on this level is done, as its width there is one
        rows = made.where(F.col("level") == base)
        made = stage(_build(_blocks(rows, ["digest"]), base), "nodes")
        every = every.unionByName(made)
    return every


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n``."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "source", key: str = "doc_id", held: dict[str, Column] | None = None) -> Manifest:
    """The trees of a table; ``held`` gives columns as a copy under audit holds them."""
    own = [F.col(f"`{f}`") for f in fields]
    copied = [(held or {}).get(f, F.col(f"`{f}`")) for f in fields]
    leaves = docs.select(
        F.col(f"`{group}`").cast("string").alias("grouped"),
        F.col(f"`{key}`").alias("name"),
        F.unhex(leaf(own)).alias("digest"),
        F.unhex(leaf(copied)).alias("held") if held else F.lit(None).cast("binary").alias("held"),
    )
    leaves = stage(leaves, "leaves")
    order = [F.col("grouped").asc_nulls_first(), F.col("name").asc_nulls_first(), F.col("digest").asc()]
    placed = numbered(leaves, order, "place", "ordered-leaves")
    trees = placed.groupBy("grouped").agg(F.min("place").alias("base"), F.count(F.lit(1)).alias("n"))
    # groups are in order of their first leaves
    trees = stage(numbered(stage(trees, "groups"), [F.col("base").asc()], "tree", "ordered-groups"), "trees")
    sizes = F.broadcast(trees) if bounded(trees, ["grouped"]) else trees
    rows = placed.alias("l").join(sizes.alias("t"), F.col("l.grouped").eqNullSafe(F.col("t.grouped")))
    rows = rows.select("tree", "n", (F.col("place") - F.col("base")).alias("place"), "name", "digest", "held")
    blocks = stage(_blocks(rows, ["name", "digest", "held"]), "blocks")
    n_trees, longest = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    nodes = _nodes(blocks, height(longest))
    alone = blocks.where("n = 1").select("tree", F.lit(0).alias("level"), F.col("entries")[0]["digest"].alias("digest"))
    roots = nodes.where("place = 0").select("tree", "level", "digest").unionByName(alone)
    roots = roots.groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))
    top = roots.select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(n_trees).cast("bigint").alias("n"), F.col("tree").alias("place"), F.col("tree").alias("name"), "digest", F.lit(None).cast("binary").alias("held"))
    top_blocks = stage(_blocks(top, ["name", "digest", "held"]), "group-blocks")
    nodes = nodes.unionByName(_nodes(top_blocks, height(n_trees)))
    return Manifest(blocks, nodes, trees, top_blocks)


def missing(row: np.ndarray, place: np.ndarray, width: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For leaves (row of a block, place) of trees with ``width[row]`` leaves: level, rows and places of the
    fewest nodes that give the proofs of them all. A node is asked for once a block, and only if it does not
    follow from others."""
    out = []
    span = int(width.max(initial=0)) + RUN
    known = np.unique(row * span + place)
    level, width = 0, width.copy()
    while len(known := known[width[known // span] > 1]):
        rows, places = known // span, known % span
        parents = np.unique(rows * span + places // RUN)
        first = parents // span * span + parents % span * RUN
        children = (first[:, None] + np.arange(RUN)).ravel()
        there = children % span < np.repeat(width[parents // span], RUN)
        lacking = children[there & ~np.isin(children, known)]
        out.append((level, lacking // span, lacking % span))
        known, width, level = parents, -(-width // RUN), level + 1
    return out


def _copies(level: Column) -> Column:
    """Copies of a node of a level: two sibling subtrees of 3 ** level leaves ask for it at most."""
    asking = F.pow(F.lit(float(RUN)), level) * (2 / BLOCK)
    return F.greatest(F.lit(1), F.ceil(asking / ASKERS)).cast("bigint")


def _fetched(made: Manifest, blocks: DataFrame) -> DataFrame:
    """The blocks with the nodes that each lacks."""
    schema = spark_schema("tree bigint, block bigint, level int, place bigint")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees, block, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            places = batch.column(3)
            offsets = places.offsets.to_numpy()
            row = np.repeat(np.arange(len(n)), np.diff(offsets))
            for level, rows, at in missing(row, places.flatten().to_numpy(), n):
                columns = [pa.array(trees[rows]), pa.array(block[rows]), pa.array(np.full(len(rows), level, np.int32)), pa.array(at)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    asked = blocks.select("tree", "block", "n", F.col("entries.place").alias("places")).mapInArrow(work, schema)
    copies = _copies(F.col("level"))
    asked = asked.withColumn("copy", F.pmod(F.col("block"), copies))
    given = made.given().withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1)))
    got = asked.join(given, ["tree", "level", "place", "copy"])
    got = got.groupBy("tree", "block").agg(F.collect_list(F.struct("level", "place", "digest")).alias("fetched"))
    return blocks.join(got, ["tree", "block"], "left")


def expand(n: int, leaves: dict[int, str], fetched: list[tuple[int, int, str]]) -> tuple[dict[int, list[tuple[str, str]]], str]:
    """Of a block: for each place the siblings (left, right) level by level, and the root of the tree.

    Leaves are original digests; the inner nodes that several of them share are derived once, and so are
    the upper ends of their proofs.
    """
    levels: list[dict[int, str]] = [dict(leaves)]
    for level, place, node in fetched:
        while len(levels) <= level:
            levels.append({})
        levels[level][place] = node
    runs: list[dict[int, list[str]]] = []
    width, inside = n, set(leaves)
    while width > 1:
        here = levels[len(runs)]
        parents = {p // RUN for p in inside}
        runs.append({q: [here[c] for c in range(q * RUN, min(q * RUN + RUN, width))] for q in parents})
        if len(levels) == len(runs):
            levels.append({})
        levels[len(runs)].update((q, digest(*run)) for q, run in runs[-1].items())
        width, inside = -(-width // RUN), parents
    # from the root down: the proof of a node is its siblings, then the proof of its parent
    proofs: dict[int, list[tuple[str, str]]] = {0: []}
    for level in range(len(runs) - 1, -1, -1):
        below = set(leaves) if level == 0 else set(runs[level - 1])
        proofs = {p: [("".join(runs[level][p // RUN][: p % RUN]), "".join(runs[level][p // RUN][p % RUN + 1 :])), *proofs[p // RUN]] for p in below}
    return proofs, levels[len(runs)][0]


def fold(node: str, proof: list[tuple[str, str]]) -> str:
    """The root that a leaf and its proof give."""
    for left, right in proof:
        node = digest(left, node, right)
    return node


def _expanded(row: dict) -> Iterator[tuple[dict, list[tuple[str, str]], str]]:
    fetched = [(f["level"], f["place"], f["digest"].hex()) for f in row["fetched"] or []]
    proofs, root = expand(row["n"], {e["place"]: e["digest"].hex() for e in row["entries"]}, fetched)
    for entry in row["entries"]:
        yield entry, proofs[entry["place"]], root


def prove(made: Manifest, blocks: DataFrame) -> DataFrame:
    """name, leaf, proof (siblings left and right of the path, level by level) and root of all leaves in
    ``blocks``, which may hold any leaves of the manifest's trees."""
    kind = blocks.schema["entries"].dataType.elementType["name"].dataType.simpleString()
    schema = spark_schema(f"name {kind}, leaf string, proof array<struct<left:string,right:string>>, root string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                rows = [(e["name"], e["digest"].hex(), [{"left": a, "right": b} for a, b in proof], root) for row in part for e, proof, root in _expanded(row)]
                yield _batch(rows, schema)

    return _fetched(made, blocks).select("n", "entries", "fetched").mapInArrow(work, schema)


def _slices(batch: pa.RecordBatch, blocks: int = 100) -> Iterator[list[dict]]:
    for i in range(0, batch.num_rows, blocks):
        yield batch.slice(i, blocks).to_pylist()


def subset(made: Manifest, names: DataFrame) -> DataFrame:
    """The blocks of the manifest with only the leaves whose keys are in the one column of ``names``."""
    wanted = names.select(F.col(names.columns[0]).alias("name")).distinct()
    rows = made.blocks.select("tree", "n", F.explode("entries").alias("e")).select("tree", "n", "e.*")
    return _blocks(rows.join(wanted, "name", "left_semi"), ["name", "digest", "held"])


def audit(made: Manifest) -> DataFrame:
    """name, leaf, subroot, root, proof_sha256 (of all siblings up to the root), folded_root (from the held copy's
    leaf and the original's siblings) and verified of every leaf."""
    kind = made.blocks.schema["entries"].dataType.elementType["name"].dataType.simpleString()
    schema = spark_schema(f"name {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    above = stage(prove(made, made.top_blocks).select(F.col("name").alias("tree"), F.col("proof").alias("above"), F.col("leaf").alias("subroot"), "root"), "group-proofs")
    # a row has as many siblings as the tree of groups has levels
    light = above.limit(20_001).count() <= 20_000
    whole = _fetched(made, made.blocks).join(F.broadcast(above) if light else above, "tree")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                out = []
                for row in part:
                    above = [(s["left"], s["right"]) for s in row["above"]]
                    for entry, proof, subroot in _expanded(row):
                        path = proof + above
                        original = entry["digest"].hex()
                        held = entry["held"].hex() if entry["held"] is not None else original
                        folded = fold(held, path)
                        out.append((entry["name"], original, subroot, row["root"], digest(*(s for pair in path for s in pair)), folded, folded == row["root"]))
                yield _batch(out, schema)

    return whole.select("n", "entries", "fetched", "above", "root").mapInArrow(work, schema)
