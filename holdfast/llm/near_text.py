"""Near copies among texts: weighted minimum hashing with early termination, banding, verification.

A text is the set of its runs of five words, each weighing 1 + ln(count). Every run is a Poisson process
whose rate is its weight; each arrival falls on one of the registers, and a register keeps the run that
reaches it first. A run stops as soon as its next arrival is later than every register's first, so most
stop after few. Two texts agree in a register with the probability Jaccard similarity of their weights.
Texts that agree in a band of registers are compared exactly: they are linked if the Jaccard similarity
of their sets of five-word runs is 0.8 or more.

Copies (the same words in the same order, whatever the case, spaces and marks around words) are one text from the
start. Within a bucket only the least text is compared with the others at first; texts that already hang
together are not compared again; the texts that all others were compared with leave their bucket. If many pairs
between classes are left then, as where many texts share a passage and little else, the texts of those buckets
get new ones: a bucket for each of their rarest runs, as many as a text of similarity 0.8 to another one
cannot lack all of. This loses no link, and a common passage makes no bucket. Each further round takes
``GROWTH`` times as many of the least texts of a bucket as the last one; once the pairs left between classes, over all
buckets, are no more than ``PAIRS`` a text, all of them are compared. So a group of copies is not expanded
into its pairs, and no link that would join two classes is lost. Pairs are first compared by a few bits of each register of their plain sets, which rules
out those that agree in far fewer than similar texts do (six standard deviations); the texts of the others are compared.

Defined results: rows without an id get no class; texts without words are copies of nothing; texts with
fewer than five words are one run; rows with equal ids are one document; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import join_small, map_texts, slabs, stage, text_or_empty, unused
from holdfast.llm.graph import labels, stars
from holdfast.session import scratch

RUN = 5
#: Bands and registers a band: two texts of similarity 0.8 share a band of their plain sets with probability 0.9994.
BANDS, ROWS = 40, 8
THRESHOLD = 0.8
#: Pairs a text up to which all that are left between classes are compared at once.
PAIRS = 8
#: Frequent runs that are told apart by their counts at most.
FREQUENT = 200_000
#: Growth of the texts of a bucket that a round compares with the others.
GROWTH = 8
#: Registers in which texts of similarity 0.8 agree in four bits: 0.8125 of 320, with a deviation of 0.0218.
AGREEING = 0.68
MAX_WORDS = 200_000
#: Characters sketched at once.
SKETCHED = 1_000_000
MARKS = ".,;:!?\"'()[]{}<>*#-_"
GOLD = np.uint64(0x9E3779B97F4A7C15)

_WORDS: dict[str, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and the number of words of each."""
    import xxhash

    tokens = [t.split() for t in texts]
    lengths = np.array([len(t) for t in tokens], np.int64)
    coded = pa.array(list(chain.from_iterable(tokens)), pa.large_string()).dictionary_encode()
    if len(_WORDS) > MAX_WORDS:
        _WORDS.clear()
    words = coded.dictionary.to_pylist()
    for word in words:
        if word not in _WORDS:
            bare = word.strip(MARKS).lower() or word
            _WORDS[word] = xxhash.xxh64_intdigest(bare.encode())
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    hashes = hashes[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
    return hashes, lengths


def runs(hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of each distinct run, in order of the texts."""
    n = len(hashes)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    left = ends[owner] - np.arange(n)
    rolled = np.zeros(n, np.uint64)
    for k in range(RUN):
        # a batch may hold fewer words than a run
        shifted = np.zeros(n, np.uint64)
        shifted[: max(0, n - k)] = hashes[k:]
        rolled = np.where(left > k, rolled * GOLD + shifted, rolled)
    # the last words of a text start no run of their own, unless the text is shorter than a run
    starts = (left >= RUN) | (left == lengths[owner])
    owner, rolled = owner[starts], _mix(rolled[starts])
    order = np.lexsort((rolled, owner))
    owner, rolled = owner[order], rolled[order]
    fresh = np.ones(len(rolled), bool)
    fresh[1:] = (rolled[1:] != rolled[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(fresh)
    return owner[at], rolled[at], np.diff(np.append(at, len(rolled)))


def signatures(owner: np.ndarray, run: np.ndarray, count: np.ndarray, texts: int, registers: int = BANDS * ROWS) -> np.ndarray:
    """The run that reaches each register of each text first."""
    first = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, np.uint64)
    rate = 1.0 + np.log(count)
    time = np.zeros(len(run))
    latest = np.full(texts, np.inf)
    step = np.uint64(0)
    with np.errstate(over="ignore"):
        while len(run):
            step += np.uint64(1)
            draw = _mix(run + GOLD * step)
            time = time - np.log(((draw >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53) / rate
            slot = owner * registers + (_mix(draw) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(first, slot, time)
            won = first[slot] == time
            winner[slot[won]] = run[won]
            # an old bound only stops runs later, so that of the last, short texts is renewed now and then
            if step < 8 or step % np.uint64(8) == 0:
                open_texts = owner[np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))]
                latest[open_texts] = first.reshape(texts, registers)[open_texts].max(axis=1)
            go = time < latest[owner]
            owner, run, rate, time = owner[go], run[go], rate[go], time[go]
    return winner.reshape(texts, registers)


def bands(winner: np.ndarray) -> np.ndarray:
    """A hash of each band, which also tells bands apart."""
    grouped = winner.reshape(len(winner), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * GOLD, grouped.shape[:2]).copy()
    for k in range(ROWS):
        out = _mix(out * GOLD + grouped[:, :, k])
    return out.view(np.int64)


def sketch(texts: list[str]) -> dict[str, object]:
    """content (a digest of the words, null without words), size (distinct runs), band hashes of each text, those of
    its weighted runs and, where they differ, those of its plain set, and four bits of each register of the plain set."""
    import xxhash

    hashes, lengths = word_hashes(texts)
    ends = np.cumsum(lengths).tolist()
    content = [xxhash.xxh3_128_digest(hashes[e - n : e].tobytes()) if n else None for e, n in zip(ends, lengths.tolist())]
    owner, run, count = runs(hashes, lengths)
    winners = signatures(owner, run, count, len(texts))
    made = bands(winners)
    size = np.bincount(owner, minlength=len(texts)).astype(np.int32)
    # texts in which a run recurs once more, as plain sets
    again = np.unique(owner[count > 1])
    of = np.isin(owner, again)
    winners[again] = signatures(np.searchsorted(again, owner[of]), run[of], np.ones(int(of.sum())), len(again))
    plain = bands(winners[again])
    nibbles = (winners >> np.uint64(60)).astype(np.uint8)
    marks = nibbles[:, ::2] << np.uint8(4) | nibbles[:, 1::2]
    added = plain != made[again]
    kept = np.concatenate([np.ones(made.shape, bool), np.zeros(made.shape, bool)], axis=1)
    kept[again, BANDS:] = added
    both = np.concatenate([made, made], axis=1)
    both[again, BANDS:] = plain
    offsets = pa.array(np.append(0, np.cumsum(kept.sum(axis=1))).astype(np.int32))
    return {"content": pa.array(content, pa.binary()), "size": pa.array(size), "bands": pa.ListArray.from_arrays(offsets, pa.array(both[kept])), "marks": [m.tobytes() for m in marks]}


def similarity(left: list[str], right: list[str]) -> np.ndarray:
    """Jaccard similarity of the sets of runs of each pair of texts."""
    names: dict[str, int] = {}
    a = np.array([names.setdefault(t, len(names)) for t in left], np.int64)
    b = np.array([names.setdefault(t, len(names)) for t in right], np.int64)
    owner, run, _ = runs(*word_hashes(list(names)))
    borders = np.searchsorted(owner, np.arange(len(names) + 1))
    out = np.zeros(len(left))
    for i, (x, y) in enumerate(zip(a, b)):
        one, two = run[borders[x] : borders[x + 1]], run[borders[y] : borders[y + 1]]
        if len(one) and len(two):
            at = np.minimum(np.searchsorted(two, one), len(two) - 1)
            shared = int((two[at] == one).sum())
            out[i] = shared / (len(one) + len(two) - shared)
    return out


def _linked(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # rows of one text follow each other, so its runs are made once for many pairs
            batch = batch.sort_values(["a", "b"], ignore_index=True)
            left, right = batch["left"].tolist(), batch["right"].tolist()
            for x, y in slabs([q if i and left[i - 1] == p else p + q for i, (p, q) in enumerate(zip(left, right))]):
                good = similarity(left[x:y], right[x:y]) >= threshold
                yield batch[["a", "b"]].iloc[x:y][good]

    left = texts.select(F.col("id").alias("a"), F.col("body").alias("left"))
    right = texts.select(F.col("id").alias("b"), F.col("body").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInPandas(work, "a bigint, b bigint")


def _likely(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) without those that agree in too few registers to be similar."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
            unlike = left ^ right
            agreeing = ((unlike & 15) == 0).sum(axis=1) + ((unlike >> 4) == 0).sum(axis=1)
            of = pa.array(agreeing >= AGREEING * 2 * left.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(of) for i in (0, 1)], names=["a", "b"])

    left, right = (texts.select(F.col("id").alias(i), F.col("marks").alias(m)) for i, m in (("a", "left"), ("b", "right")))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInArrow(work, "a bigint, b bigint")


def _by_rare_runs(open_texts: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """bucket, id, size, component and place: a bucket for each run of a text that may be the rarest it shares with a similar one.

    Of a text's n runs a similar text has at least threshold * n, so at least one of any n - threshold * n + 1 of them.
    Taken in one order for all texts, the first run that two texts share is among these in both; where it has
    place i of n, at most n - i + 1 runs are shared. Any order does. This one puts frequent runs last, the most frequent
    at the end, so that a passage of many texts makes no bucket; it tells apart at most ``FREQUENT`` runs.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for a, b in slabs(texts, SKETCHED):
                owner, run, _ = runs(*word_hashes(texts[a:b]))
                yield ids[a:b], owner, run.view(np.int64)

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, run in each(batches):
            yield pa.RecordBatch.from_arrays([pa.array(run)], names=["run"])

    of = bodies.join(open_texts.select("id"), "id", "left_semi").select("id", "body")
    counts = of.mapInArrow(every, "run bigint").groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    counts, least = stage(counts.where("n >= 4"), "frequent-runs"), 4
    while counts.where(F.col("n") >= least).limit(FREQUENT + 1).count() > FREQUENT:
        least *= 4
    found = sorted(tuple(r) for r in counts.where(F.col("n") >= least).collect())
    frequent, often = (np.array([f[i] for f in found], np.int64) for i in (0, 1))

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, owner, run in each(batches):
            n = np.zeros(len(run), np.int64)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, run), len(frequent) - 1)
                n = np.where(frequent[at] == run, often[at], 0)
            order = np.lexsort((run, n, owner))
            owner, run = owner[order], run[order]
            size = np.bincount(owner, minlength=len(ids))[owner]
            place = np.arange(len(run)) - np.searchsorted(owner, owner) + 1
            of = place <= size - np.ceil(threshold * size - 1e-9) + 1
            columns = [pa.array(x[of]) for x in (run, ids[owner], size.astype(np.int32), place.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "id", "size", "place"])

    placed = of.mapInArrow(rare, "bucket bigint, id bigint, size int, place int")
    return placed.join(open_texts.select("id", "component"), "id").select("bucket", "id", "size", "component", "place")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (the least id of its class) and kept (it is that one), a row per document."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), text_or_empty(text).alias("body"))
    rows = rows.where(F.col("doc_id").isNotNull())
    sketched = stage(map_texts(rows, sketch, "content binary, size int, bands array<bigint>, marks binary", text="body", limit=SKETCHED), "sketches")
    worded = sketched.where(F.col("content").isNotNull())
    # one text per content; copies only count through the least id
    texts = worded.groupBy("content").agg(F.min("doc_id").alias("id"), F.min("size").alias("size"), F.min("bands").alias("bands"), F.min("marks").alias("marks"))
    texts = stage(texts, "distinct-texts")
    placed = texts.select("id", "size", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = stage(placed.join(stage(shared, "shared-buckets"), "bucket"), "members")
    wanted = stage(members.select(F.col("id").alias("doc_id")).distinct(), "candidates")
    bodies = join_small(rows, wanted, "doc_id", "left_semi", 500_000).groupBy(F.col("doc_id").alias("id")).agg(F.min("body").alias("body"))
    bodies = stage(bodies, "candidate-texts")

    # a band says nothing of the place of what two texts share
    members = members.withColumn("component", F.col("id")).withColumn("place", F.lit(1))
    few = texts.count()

    def alike(one: str, other: str, place: str, other_place: str):
        # sets of such similarity cannot differ more in size, and share at least so many runs
        shared = F.least(F.col(one) - F.col(place), F.col(other) - F.col(other_place)) + 1
        enough = shared >= threshold / (1 + threshold) * (F.col(one) + F.col(other)) - 1e-9
        return (F.least(one, other) >= threshold * F.greatest(one, other) - 1e-9) & enough

    links, found, whole, last, width = None, None, True, False, 1
    first, crowded = True, False
    while not last:
        by_class = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).cast("double").alias("n"))
        pairs_left = (F.pow(F.sum("n"), F.lit(2)) - F.sum(F.pow("n", F.lit(2)))) / 2
        buckets = by_class.groupBy("bucket").agg(F.count(F.lit(1)).alias("classes"), pairs_left.alias("pairs"))
        buckets = stage(buckets.where("classes > 1").select("bucket", "pairs"), "open-buckets")
        total = buckets.agg(F.sum("pairs")).first()[0]
        if total is None:
            break
        members = stage(members.join(buckets.select("bucket"), "bucket", "left_semi"), "members")
        last = total <= PAIRS * few
        if crowded and not last:
            members, crowded = stage(_by_rare_runs(members.select("id", "size", "component").distinct(), bodies, threshold), "members"), False
            width = GROWTH**2
            continue
        pivots = members
        if not last:
            # only the least few of a bucket leave their tasks
            place = F.row_number().over(Window.partitionBy("bucket").orderBy("id"))
            pivots = stage(members.withColumn("_place", place).where(F.col("_place") <= width), "pivots")
        chosen = pivots.select("bucket", F.col("id").alias("_id"), F.col("component").alias("_of"), F.col("size").alias("_n"), F.col("place").alias("_at"))
        pairs = members.join(chosen, "bucket").where((F.col("id") > F.col("_id")) & (F.col("component") != F.col("_of")) & alike("size", "_n", "place", "_at"))
        pairs = stage(pairs.select(F.col("_id").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
        new = stage(_linked(_likely(pairs, texts.select("id", "marks")), bodies, threshold), "new-links")
        if new.limit(1).count():
            # between rounds one step does: what it leaves apart is only compared once more
            edges = stars(new if links is None else links.unionByName(new), "a", "b", rounds=None if last else 1)
            links, found, whole = edges.select(F.col("u").alias("a"), F.col("v").alias("b")), stage(labels(edges), "components"), last
        if not last:
            edges = pivots.groupBy("bucket").agg(F.max("id").alias("_edge"))
            members = members.join(edges, "bucket").where("id > _edge").select("bucket", "id", "size", "place")
            if found is not None:
                members = members.join(found.withColumnRenamed("node", "id"), "id", "left")
            else:
                members = members.withColumn("component", F.lit(None).cast("bigint"))
            members = stage(members.withColumn("component", F.coalesce("component", "id")), "members")
            width *= GROWTH
            crowded, first = first, False
    if not whole:
        found = stage(labels(stars(links, "a", "b")), "components")
    own = texts.select("content", "id")
    if found is not None:
        own = own.join(found.withColumnRenamed("node", "id"), "id", "left").select("content", F.coalesce("component", "id").alias("class_id"))
    else:
        own = own.withColumnRenamed("id", "class_id")
    own = stage(own, "classes")
    told = sketched.select("doc_id", "content").join(own, "content", "left")
    classes = told.groupBy("doc_id").agg(F.min(F.coalesce("class_id", "doc_id")).alias("class_id"))
    return classes.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of one document of each class, with their own columns; rows without an id stay."""
    name = unused(docs, "_gone")
    with scratch(docs.sparkSession) as made:
        gone = near_copies(docs, doc_id, text, threshold).where(~F.col("kept")).select(F.col("doc_id").alias(name))
        gone = stage(gone, "near-copies")
        made.pop()
    return join_small(docs, gone, F.col(f"`{doc_id}`").cast("bigint") == F.col(name), "left_anti", 500_000)
