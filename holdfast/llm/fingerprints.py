"""Fingerprints of texts by quartiles of byte triplets, and their likeness.

Every three neighbouring bytes of a text in UTF-8 are hashed to one of ``BUCKETS`` buckets and counted. A
fingerprint holds one byte for the length (eight steps a doubling) and two bits a bucket: in which
quarter of the text's own counts it lies. So a change of some words moves few buckets, and texts of any length have
fingerprints of one size. Two fingerprints differ by the sum of the steps between their buckets, in
shares of what unrelated ones differ by, and by up to ``LENGTH_SHARE`` for their lengths; the sum is bounded by one,
and the likeness is one minus it.

Defined results: a null text is the empty text; texts under three bytes have no triplet and differ
only in length; equal texts have equal fingerprints; extra columns are ignored. In the order of documents,
rows with equal ids follow each other by the hash of their text, null ids come last, and a
single row is followed by itself.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_texts, slabs, spark_schema, stage, text_or_empty

BUCKETS = 512
#: What the buckets of unrelated texts differ by on average, of at most three steps.
UNRELATED = 1.25
#: Length steps that count, and the share of the whole difference that they make up at most.
LENGTH_STEPS, LENGTH_SHARE = 32, 0.25
#: Bytes of text of a block, which one task puts in order.
BLOCK_BYTES = 16_000_000
_FACTOR = np.uint32(0x9E3779B1)


def triplet_counts(raw: bytes, sizes: np.ndarray) -> np.ndarray:
    """A row of bucket counts for each of the texts that lie in ``raw`` one after the other."""
    n, texts = len(raw), len(sizes)
    if n < 3:
        return np.zeros((texts, BUCKETS), np.int64)
    data = np.frombuffer(raw, np.uint8).astype(np.uint32)
    hashed = (data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)) * _FACTOR
    slot = (hashed >> np.uint32(32 - 9)).astype(np.int64)
    slot += np.repeat(np.arange(texts, dtype=np.int64) * BUCKETS, sizes)[:-2]
    # triplets that reach into the next text
    inside = np.ones(n, bool)
    ends = np.cumsum(sizes)
    for back in (1, 2):
        at = ends - back
        inside[at[at >= 0]] = False
    return np.bincount(slot[inside[:-2]], minlength=texts * BUCKETS).reshape(texts, BUCKETS)


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """A row of bytes for each text: length, then four buckets a byte."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = triplet_counts(b"".join(texts), sizes)
    ranked = np.sort(counts, axis=1)
    codes = np.zeros(counts.shape, np.uint8)
    for quarter in (1, 2, 3):
        border = ranked[:, quarter * BUCKETS // 4 - 1]
        codes += counts > border[:, None]
    packed = codes.reshape(len(texts), BUCKETS // 4, 4) << np.array([6, 4, 2, 0], np.uint8)
    length = np.minimum(np.rint(8 * np.log2(1.0 + sizes)), 255).astype(np.uint8)
    return np.concatenate([length[:, None], np.bitwise_or.reduce(packed, axis=2)], axis=1)


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of each pair of fingerprints (rows of bytes): one for equal ones, down to zero."""
    shifts = np.array([6, 4, 2, 0], np.uint8)
    a, b = (((x[:, 1:, None] >> shifts) & 3).reshape(len(x), -1).astype(np.int16) for x in (left, right))
    steps = np.abs(a - b).sum(axis=1)
    # short texts fill few buckets: the steps that they have at all are the measure then
    most = np.minimum(np.maximum(a, b).sum(axis=1), UNRELATED * BUCKETS)
    apart = np.abs(left[:, 0].astype(np.int16) - right[:, 0])
    lengths = np.minimum(apart, LENGTH_STEPS) / LENGTH_STEPS * LENGTH_SHARE
    return 1.0 - np.minimum(steps / np.maximum(most, 1) + lengths, 1.0)


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars and fingerprint (hexadecimal) of every row."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(text).alias("body"))

    def work(texts: list[str]) -> dict:
        return {"n_chars": [len(t) for t in texts], "fingerprint": [f.tobytes().hex() for f in fingerprints([t.encode() for t in texts])]}

    return map_texts(rows, work, "n_chars bigint, fingerprint string", text="body")


def compare(pairs: DataFrame, left: str, right: str, name: str = "likeness") -> DataFrame:
    """The rows with the likeness of two columns of fingerprints (null if one is null)."""
    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        both = a.notna() & b.notna()
        out = pd.Series(np.nan, index=a.index, dtype="object").where(both, None)
        if both.any():
            read = [np.frombuffer(bytes.fromhex("".join(x[both])), np.uint8).reshape(int(both.sum()), -1) for x in (a, b)]
            out[both] = likeness(*read)
        return out.astype("Float64")

    return pairs.withColumn(name, alike(F.col(f"`{left}`"), F.col(f"`{right}`")))


def _key(doc_id: int | None, hashed: int) -> tuple[bool, int, int]:
    """Descending ids, null last, then by the hash of the text."""
    return doc_id is None, -(doc_id or 0), hashed


def edited_documents(docs: DataFrame, share: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of every row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last ``n_chars`` / ``share`` characters replaced by the first as many (or
    all) of the next document in descending order of ids (after the last: the first).

    Ids and hashes alone are put in order first, which gives the first key of each block. Texts are
    fingerprinted where they lie and shuffled once, to their block; the first row of a block also goes to the
    block before, as the one that follows its last. Within a block rows stream by in order, and only
    the last one is carried on.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), text_or_empty(text).alias("body")).withColumn("hashed", F.xxhash64("body"))
    keys = stage(rows.select("doc_id", "hashed", F.octet_length("body").cast("long").alias("size")), "text-keys")
    order = [F.col("doc_id").desc_nulls_last(), F.col("hashed").asc()]
    ordered = keys.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for batch in batches:
            firsts = []
            for doc_id, hashed, size in zip(*(c.to_pylist() for c in batch.columns)):
                key = (doc_id, hashed)
                if last is None or (key != last and total + size > BLOCK_BYTES):
                    firsts.append(key)
                    total = 0
                last, total = key, total + size
            columns = zip(*firsts) if firsts else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "hashed"])

    # a row a block of texts, by their bytes
    bounds = sorted(_key(*f) for f in ordered.mapInArrow(cut, "doc_id bigint, hashed bigint").collect())
    spread = spark_schema("block int, guest boolean, doc_id bigint, hashed bigint, body string, mark binary")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, texts = (batch.column(i).to_pylist() for i in (0, 1, 2))
            for a, b in slabs(texts):
                marks = [m.tobytes() for m in fingerprints([t.encode() for t in texts[a:b]])]
                own = [_key(*k) for k in zip(ids[a:b], hashes[a:b])]
                block = [bisect_right(bounds, k) - 1 for k in own]
                part = batch.slice(a, b - a)
                kept = [part.column(i) for i in range(3)] + [pa.array(marks, pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array([False] * len(own)), *kept], names=spread.names)
                at = [i for i, (k, n) in enumerate(zip(own, block)) if bounds[n] == k]
                if at:
                    before = [(block[i] or len(bounds)) - 1 for i in at]
                    moved = [column.take(pa.array(at)) for column in kept]
                    yield pa.RecordBatch.from_arrays([pa.array(before, pa.int32()), pa.array([True] * len(at)), *moved], names=spread.names)

    placed = rows.select("doc_id", "hashed", "body").mapInArrow(deal, spread)
    # one block a task, where hashes of their numbers would put some together
    inside = placed.repartitionById(max(1, len(bounds)), "block").sortWithinPartitions("block", "guest", *order)
    told = spark_schema("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: list[tuple] = []
        for batch in batches:
            texts = batch.column(3).to_pylist()
            block, guest, ids, marks = (batch.column(i).to_pylist() for i in (0, 1, 2, 4))
            for a, b in slabs(texts):
                here = carried + list(zip(block[a:b], guest[a:b], ids[a:b], texts[a:b], marks[a:b]))
                # a row that is no guest is always followed by one of its block
                pairs = [(one, two) for one, two in zip(here, here[1:]) if not one[1]]
                carried = here[-1:]
                if not pairs:
                    continue
                cuts = [len(one[3]) // share for one, _ in pairs]
                edited = [(one[3][: len(one[3]) - cut] + two[3][:cut]).encode() for (one, two), cut in zip(pairs, cuts)]
                own, following = (np.frombuffer(b"".join(p[i][4] for p in pairs), np.uint8).reshape(len(pairs), -1) for i in (0, 1))
                changed = fingerprints(edited)
                columns = [
                    pa.array([one[2] for one, _ in pairs], pa.int64()),
                    pa.array([len(one[3]) for one, _ in pairs], pa.int64()),
                    [hashlib.sha256(t).hexdigest() for t in edited],
                    [one[4].hex() for one, _ in pairs],
                    [m.tobytes().hex() for m in changed],
                    likeness(own, changed),
                    likeness(own, following),
                ]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=told.names)

    return inside.select("block", "guest", "doc_id", "body", "mark").mapInArrow(edit, told)
