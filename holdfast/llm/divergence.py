"""How far the sources of a language differ in their words, by exact counts.

A term is a run of letters of A to Z, of which only these are put in lower case, and of characters beyond
ASCII. Terms are found in the bytes of many texts at once and counted there by packing: terms of up to
eight bytes become one number, those of up to sixteen two, padded with zero bytes, which no term
holds; numbers are put in order by their digits of sixteen bits, last digit first, and equal neighbours
are counted. Longer terms are kept apart by length, in buckets of byte strings of one size, which are sorted
as bytes. Only counts of (language, source, term) leave a task.

A language keeps the terms in at least ``MIN_DOCS`` of its documents. With N the occurrences of kept terms and V
their number, p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)), for a source's documents in the language
and for the whole language. All arithmetic is of integers.

Defined results: null text, language and source are empty strings, and so are groups of their own; equal
or null ids are documents of their own; a group without terms has p from the smoothing alone; a
language without kept terms has pairs of value 0 and no terms; extra columns are ignored; an empty table has no
rows. The result of pairs holds the square of a language's sources, so a language's sources,
unlike its documents and terms, are taken to fit in the memory of a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import bounded, spark_schema, stage

SCALE, SMOOTH, MIN_DOCS, TOP = 1_000_000_000, 5, 30, 50
#: Bytes of text that a task packs at once, and sources compared with each other at once.
SLAB, TILE = 6_000_000, 256


def term_places(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start and length of each term of texts that end at ``ends``."""
    upper = (data >= 0x41) & (data <= 0x5A)
    data = data + upper * np.uint8(0x20)
    inside = (data >= 0x80) | ((data >= 0x61) & (data <= 0x7A))
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    # a term does not go on into the next text
    borders = ends[(ends > 0) & (ends < len(data))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(first)
    return data, starts, np.flatnonzero(last) + 1 - starts


def packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each start as one number, the first byte in the highest place."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(8):
        there = lengths > i
        if not there.any():
            break
        byte = data[np.where(there, starts + i, 0)].astype(np.uint64)
        out |= np.where(there, byte, np.uint64(0)) << np.uint64(8 * (7 - i))
    return out


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """The stable order of numbers of one or more words, highest word first."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = ((word >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                # numpy sorts numbers of sixteen bits by radix
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run; ``fresh`` marks the first of a run."""
    at = np.flatnonzero(fresh)
    return at, np.diff(np.append(at, len(fresh)))


def term_counts(data: np.ndarray, ends: np.ndarray, group: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each bucket of lengths: terms, then of each (term, group) the term's number, the group, its
    occurrences and the documents that hold it. ``group`` is a number for each text."""
    data, starts, lengths = term_places(data, ends)
    owner = np.searchsorted(ends, starts, side="right")
    for low, high in ((0, 8), (8, 16), (16, None)):
        of = lengths > low if high is None else (lengths > low) & (lengths <= high)
        at, size, text = starts[of], lengths[of], owner[of]
        if not len(at):
            continue
        if high is not None:
            words = [packed(data, at + 8 * w, size - 8 * w) for w in range(high // 8)]
            order = radix_order(words)
            words = [w[order] for w in words]
            fresh = np.ones(len(order), bool)
            fresh[1:] = np.logical_or.reduce([w[1:] != w[:-1] for w in words])
            yield _told(data, at, size, text, group, order, fresh)
        else:
            by_size = np.argsort(size, kind="stable")
            at, size, text = at[by_size], size[by_size], text[by_size]
            for first, n in zip(*_runs(np.append(True, size[1:] != size[:-1]))):
                one, length = slice(first, first + n), int(size[first])
                strings = data[at[one, None] + np.arange(length)].view(f"S{length}").ravel()
                order = np.argsort(strings, kind="stable")
                fresh = np.append(True, strings[order][1:] != strings[order][:-1])
                yield _told(data, at[one], size[one], text[one], group, order, fresh)


def _told(data: np.ndarray, at: np.ndarray, size: np.ndarray, text: np.ndarray, group: np.ndarray, order: np.ndarray, fresh: np.ndarray):
    """Counts of terms in order, of which ``fresh`` marks the first of each."""
    names = [data[a : a + n].tobytes() for a, n in zip(at[order][fresh].tolist(), size[order][fresh].tolist())]
    term = np.cumsum(fresh) - 1
    # the order is stable, so the places of a term are by text
    text = text[order]
    fresh = fresh.copy()
    fresh[1:] |= text[1:] != text[:-1]
    first, times = _runs(fresh)
    # a row is a (term, text) now; texts of one group come together
    term, of = term[first], group[text[first]]
    order = np.lexsort((of, term))
    term, of, times = term[order], of[order], times[order]
    fresh = np.ones(len(term), bool)
    fresh[1:] = (term[1:] != term[:-1]) | (of[1:] != of[:-1])
    first, docs = _runs(fresh)
    return names, term[first], of[first], np.add.reduceat(times, first), docs


def count_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (rows that hold it): partial counts, to be added up."""
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "body"))])
    schema = spark_schema("lang string, source string, term string, n bigint, docs bigint")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, raw = _bytes(batch.column(2))
            for a, b in _byte_slabs(np.diff(offsets)):
                group, langs, sources = _groups(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a))
                for names, term, of, n, held in term_counts(raw[offsets[a] : offsets[b]], offsets[a + 1 : b + 1] - offsets[a], group):
                    told = pa.array(names, pa.binary()).cast(pa.string())
                    columns = [langs.take(pa.array(of)), sources.take(pa.array(of)), told.take(pa.array(term)), pa.array(n), pa.array(held)]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(work, schema)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text starts and the last ends, and the bytes of all."""
    wide = pa.types.is_large_string(texts.type)
    _, offsets, raw = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint8)
    places = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return places, np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)


def _byte_slabs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > SLAB:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def _groups(lang: pa.Array, source: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """A number for each row's (lang, source), and the lang and the source of each number."""
    a, b = lang.dictionary_encode(), source.dictionary_encode()
    codes = a.indices.to_numpy().astype(np.int64) * len(b.dictionary) + b.indices.to_numpy()
    values, group = np.unique(codes, return_inverse=True)
    return group, a.dictionary.take(pa.array(values // len(b.dictionary))), b.dictionary.take(pa.array(values % len(b.dictionary)))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * kept)), exactly; null without kept terms."""
    top = (count + SMOOTH).cast("decimal(24,0)") * F.lit(SCALE).cast("decimal(10,0)")
    bottom = (total + SMOOTH * kept).cast("decimal(24,0)")
    return F.when(kept > 0, F.lit(1) + F.call_function("div", top, bottom)).cast("bigint")


def _distances(rows: DataFrame) -> DataFrame:
    """lang, a, b (numbers of sources, a < b) and the sum over terms of the difference of their shares.

    ``rows`` holds for each term of a language the shares of the sources that have it (entries: at, share) and
    the share of a source that has not (bare). Pairs are worked off in tiles; sums of a tile are kept in the task.
    """
    schema = spark_schema("lang string, a int, b int, value bigint")
    tiles = F.sequence(F.lit(0), F.floor((F.size("bare") - 1) / TILE).cast("int"))
    tiled = rows.withColumn("i", F.explode(tiles)).withColumn("j", F.explode(tiles)).where("i <= j")

    def told(sums: dict[tuple[str, int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
        for (lang, i, j), matrix in sums.items():
            a, b = np.indices(matrix.shape, dtype=np.int32).reshape(2, -1)
            a, b = a + np.int32(i * TILE), b + np.int32(j * TILE)
            of = a < b
            columns = [pa.array([lang] * int(of.sum()), pa.string()), pa.array(a[of]), pa.array(b[of]), pa.array(matrix.ravel()[of])]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int, int], np.ndarray] = {}
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            keys = list(zip(*(columns[n].to_pylist() for n in ("lang", "i", "j"))))
            places: dict[tuple, list[int]] = {}
            for n, key in enumerate(keys):
                places.setdefault(key, []).append(n)
            for (lang, i, j), found in places.items():
                bare = columns["bare"][found[0]].values.to_numpy()
                step = max(1, 2_000_000 // len(bare))
                for start in range(0, len(found), step):
                    of = columns["entries"].take(pa.array(found[start : start + step]))
                    sizes = np.diff(of.offsets.to_numpy())
                    at, value = (of.flatten().field(n).to_numpy() for n in range(2))
                    dense = np.tile(bare, (len(sizes), 1))
                    dense[np.repeat(np.arange(len(sizes)), sizes), at] = value
                    left, right = (dense[:, t * TILE : (t + 1) * TILE] for t in (i, j))
                    part = np.stack([np.abs(left[:, [x]] - right).sum(axis=0) for x in range(left.shape[1])])
                    sums[lang, i, j] = sums.get((lang, i, j), 0) + part
                if len(sums) > 64:
                    yield from told(sums)
                    sums = {}
        yield from told(sums)

    return tiled.select("lang", "i", "j", "entries", "bare").mapInArrow(work, schema).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank of every (lang, source) that occurs.

    Part ``pair``: each other source of the language, by the sum over kept terms of the difference of the two
    shares. Part ``term``: the ``top`` terms of which the source has a larger share than its language. Ranks
    are by value from the greatest, then by item in UTF-8.
    """
    named = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))])
    groups = stage(named.distinct(), "groups")
    counted = count_terms(docs, text, lang, source).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counted = stage(counted, "term-counts")
    kept = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("of_lang")).where(F.col("docs") >= min_docs).drop("docs")
    kept = stage(kept, "kept-terms")
    rows = stage(counted.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.sum("of_lang").alias("lang_total"), F.count(F.lit(1)).alias("kept"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "lang_total", "kept"])
    at = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sizes = stage(sizes.withColumn("at", at), "sizes")
    light = bounded(sizes, ["lang", "source"])

    def near(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if light else df

    shares = rows.join(near(sizes), ["lang", "source"])
    shares = shares.withColumn("share", share(F.col("n"), F.col("total"), F.col("kept")))
    over = shares.withColumn("value", F.col("share") - share(F.col("of_lang"), F.col("lang_total"), F.col("kept"))).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    terms = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    bare = F.transform(F.sort_array(F.collect_list(F.struct("at", share(F.lit(0), F.col("total"), F.col("kept")).alias("share")))), lambda x: x["share"])
    lanes = sizes.where("kept > 0").groupBy("lang").agg(bare.alias("bare"))
    entries = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("at", "share")).alias("entries"))
    apart = stage(_distances(entries.join(near(stage(lanes, "lanes")), "lang")), "distances")
    one, two = (sizes.select("lang", F.col("at").alias(n), F.col("source").alias(s)) for n, s in (("a", "source"), ("b", "item")))
    pairs = one.join(two, "lang").where("a != b")
    pairs = pairs.withColumn("low", F.least("a", "b")).withColumn("high", F.greatest("a", "b"))
    apart = apart.withColumnsRenamed({"a": "low", "b": "high"})
    pairs = pairs.join(apart, ["lang", "low", "high"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("bigint").alias("value"))
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)
