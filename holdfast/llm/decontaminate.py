"""Training texts that repeat benchmark passages, found by spaced seeds.

Words are runs of letters and digits, lower case. A mask names word offsets that count; the other
positions under it are free, so a substituted word does not hide a passage. Hashes of all masked
windows of the items are joined with those of the texts. A hit gives a diagonal (text position minus
item position), and the whole item is compared with the text along it. Everything is DataFrame work.

An item is repeated when at least ``share`` of its words stand at their places on one diagonal, or
when some stretch of the diagonal has ``long_run`` more equal words than three times its unequal ones.
Items with fewer words than a mask spans must be repeated exactly.

Defined results: null and empty texts and items match nothing; rows with one id count as one
document; rows of either side without an id are not reported; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import join_small, stage, text_or_empty, unused

#: Offsets that count, four of five to nine words each. However the words that differ lie, one of these masks fits
#: wherever an item of nine words or more stands at 70 % of its words on one diagonal: the most words of n that can be
#: equal without a fit are under 0.7 n for n from 9 to 17, and longer items are made of such pieces.
MASKS: tuple[tuple[int, ...], ...] = ((0, 1, 3, 7), (0, 2, 3, 4), (0, 3, 6, 8), (0, 4, 5, 7))


def word_hashes(text: str) -> Column:
    """Hashes of the words of a text, in order."""
    words = F.split(F.lower(text_or_empty(text)), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(words: str, masks: Sequence[tuple[int, ...]]) -> Column:
    """At position ``at`` of the hash array: one hash per mask that fits."""
    one = []
    for number, mask in enumerate(masks):
        parts = ", ".join(f"{words}[at + {o}]" for o in mask)
        one.append(f"IF(at + {mask[-1]} < size({words}), xxhash64({number}, {len(mask)}, {parts}), NULL)")
    return F.expr(f"array({', '.join(one)})")


def _windows(df: DataFrame, words: str, masks: Sequence[tuple[int, ...]], keep: Sequence[str], block: int = 256) -> DataFrame:
    """A row per position and mask that fits: the kept columns, at, mask and seed.

    Long word lists are first cut into overlapping blocks, so a row never carries more than a block.
    """
    span = max(m[-1] for m in masks) + 1
    cut = f"transform(sequence(0, size({words}) - 1, {block}), s -> struct(s AS base, slice({words}, s + 1, {block + span - 1}) AS part))"
    parts = df.where(F.size(words) > 0).select(*keep, F.explode(F.expr(cut)).alias("cut")).select(*keep, "cut.base", "cut.part")
    placed = parts.select(*keep, "base", "part", F.explode(F.expr(f"sequence(0, least({block}, size(part)) - 1)")).alias("at"))
    told = placed.select(*keep, (F.col("base") + F.col("at")).alias("at"), F.posexplode(_seeds("part", masks)).alias("mask", "seed"))
    return told.where(F.col("seed").isNotNull())


def _compared(hits: DataFrame, share: float, long_run: int, span: int) -> DataFrame:
    """Adds matched and run_score along the diagonal, and keeps the repeated items."""
    equal = "transform(sequence(0, size(item_words) - 1), k -> start + k >= 0 AND start + k < size(words) AND coalesce(words[IF(start + k >= 0 AND start + k < size(words), start + k, 0)] = item_words[k], false))"
    told = hits.withColumn("equal", F.expr(equal))
    told = told.withColumn("matched", F.expr("size(filter(equal, e -> e))"))
    best = "aggregate(equal, struct(0 AS now, 0 AS top), (a, e) -> struct(greatest(0, a.now + IF(e, 1, -3)) AS now, greatest(a.top, a.now + IF(e, 1, -3)) AS top), a -> a.top)"
    told = told.withColumn("run_score", F.expr(best)).withColumn("item_length", F.size("item_words"))
    whole = F.col("matched") >= F.when(F.col("item_length") < span, F.col("item_length")).otherwise(F.ceil(F.col("item_length") * share))
    return told.where(whole | (F.col("run_score") >= long_run))


def repeated_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    item_text: str = "text",
    masks: Sequence[tuple[int, ...]] = MASKS,
    share: float = 0.7,
    long_run: int = 13,
    broadcast_rows: int = 200_000,
) -> DataFrame:
    """doc_id, item_id, start (word position of the item in the text), matched, item_length, run_score:
    the best diagonal of each repeated item in each document.

    Seeds are narrow rows. Up to ``broadcast_rows`` seeds of items are broadcast, so those of the texts are
    looked up where they arise; beyond that they are shuffled. Only documents with hits are read again
    and compared with the items; the hits are broadcast to them up to the same bound.
    """
    span = max(m[-1] for m in masks) + 1
    left = items.select(F.col(f"`{item_id}`").alias("item_id"), word_hashes(item_text).alias("item_words"))
    left = left.where(F.col("item_id").isNotNull() & (F.size("item_words") > 0)).dropDuplicates()
    left = stage(left, "benchmark-words")
    short = [r[0] for r in left.where(F.size("item_words") < span).select(F.size("item_words")).distinct().collect()]
    # whole short items, as further masks that only items of just that length have
    every = list(masks) + [tuple(range(n)) for n in sorted(short)]
    seeds = _windows(left, "item_words", every, ["item_id", "item_words"])
    own = F.lit(False)
    for number, mask in enumerate(every):
        fits = F.size("item_words") >= span if number < len(masks) else F.size("item_words") == len(mask)
        own = own | ((F.col("mask") == number) & fits)
    seeds = stage(seeds.where(own).select("mask", "seed", "item_id", F.col("at").alias("item_at")).distinct(), "benchmark-seeds")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("body")).where(F.col("doc_id").isNotNull())

    windows = _windows(rows.select("doc_id", word_hashes("body").alias("words")), "words", every, ["doc_id"])
    hits = join_small(windows, seeds, ["mask", "seed"], "inner", broadcast_rows)
    hits = stage(hits.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("start")).distinct(), "benchmark-hits")
    met = join_small(rows, hits, "doc_id", "inner", broadcast_rows).withColumn("words", word_hashes("body")).drop("body")
    met = join_small(met, left, "item_id", "inner", broadcast_rows)
    best = F.struct("matched", "run_score", (-F.col("start")).alias("early"), F.col("item_length"))
    found = _compared(met, share, long_run, span).groupBy("doc_id", "item_id").agg(F.max(best).alias("best"))
    return found.select("doc_id", "item_id", (-F.col("best.early")).alias("start"), "best.matched", "best.item_length", "best.run_score")


def drop_repeating(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows, with their own columns, whose document repeats no item."""
    name = unused(docs, "_gone")
    gone = repeated_items(docs, items, doc_id=doc_id, text=text, **options).select(F.col("doc_id").alias(name)).distinct()
    gone = stage(gone, "repeating")
    return join_small(docs, gone, F.col(f"`{doc_id}`") == F.col(name), "left_anti", 500_000)
