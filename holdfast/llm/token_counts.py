"""Token counts by a compiled finite-state transducer.

A state knows the longest end of the text that may still grow into a piece, and for each border in
that end the last piece before it and how many pieces lie behind it. Reading a character moves to a
next state and emits by how much the count of pieces changes (it may fall, when pieces merge). States
are compiled when first reached. Wherever no piece holds two neighbouring characters the transducer is
back at its first state, so a chunk of text maps any state to: what its head (up to the first such
border) makes of that state, plus a number, ending in the state of its tail. These maps compose, and
long texts are counted in chunks whose maps are put together in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import pieces
from holdfast.llm.common import map_texts, text_or_empty

#: Compiled states and remembered words that a worker keeps at most; beyond, it starts afresh.
MAX_STATES, MAX_WORDS = 100_000, 800_000
#: Marks that are counted apart where no piece joins them to the character before.
MARKS = frozenset(",.!?;:")


class Transducer:
    """States are numbered; ``moves[state]`` maps a character to (next state, emitted count)."""

    def __init__(self, vocabulary: pieces.Pieces) -> None:
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        start = ("", ((0, "", 0),))
        self.states, self.numbers, self.moves = [start], {start: 0}, [{}]
        self.ends: dict[str, tuple[list[str], list[int]]] = {}

    def _end(self, grown: str) -> tuple[list[str], list[int]]:
        """The pieces that end a text, longest first, and the lengths of its ends that may still grow."""
        v = self.vocabulary
        tails = [grown[i:] for i in range(len(grown))]
        self.ends[grown] = out = ([t for t in tails if t in v.ids], [len(t) for t in tails if t in v.heads])
        return out

    def _compile(self, number: int, char: str) -> tuple[int, int]:
        end, borders = self.states[number]
        v = self.vocabulary
        if char not in v.ids:
            state, emitted = self.states[0], len(char.encode("utf-8", "surrogatepass"))
        else:
            grown = end + char
            candidates, open_ends = self.ends.get(grown) or self._end(grown)
            # a border: how far back it lies, the last piece before it, the pieces behind it
            at = {back + 1: (last, behind) for back, last, behind in borders}
            piece = next(p for p in candidates if len(p) in at and v.together(at[len(p)][0], p))
            emitted = at[len(piece)][1] + 1
            kept = ((back, at[back][0], at[back][1] - emitted) for back in reversed(open_ends) if back in at)
            state = (grown[len(grown) - open_ends[0] :] if open_ends else "", ((0, piece, 0), *kept))
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        self.moves[number][char] = out = (self.numbers[state], emitted)
        return out

    def run(self, text: str, state: int = 0) -> tuple[int, int]:
        """The state after the text and the pieces it adds."""
        total = 0
        moves = self.moves
        for char in text:
            step = moves[state].get(char)
            if step is None:
                step = self._compile(state, char)
            state = step[0]
            total += step[1]
        return state, total


class Counter:
    """Counts of whole texts and maps of chunks, with the counts of seen words kept."""

    def __init__(self, path: str) -> None:
        self.vocabulary = pieces.load(path)
        if not self.vocabulary.words_apart:
            raise ValueError("this vocabulary has pieces that go on over the start of a word")
        self.transducer = Transducer(self.vocabulary)
        self.words: dict[str, int] = {}

    def _learn(self, key: str) -> int:
        """Count one more word; a mark at its end that joins nothing is counted apart."""
        if len(key) > 1 and key[-1] in MARKS and key[-2:] not in self.vocabulary.pairs and key[-1] in self.vocabulary.ids:
            base = self.words.get(key[:-1])
            count = (self._learn(key[:-1]) if base is None else base) + 1
        else:
            if len(self.transducer.states) > MAX_STATES:
                self.transducer.clear()
            broken, text = pieces.spelled(key)
            count = self.transducer.run(text)[1] + len(broken)
        self.words[key] = count
        return count

    def counts(self, texts: list[str]) -> list[int]:
        """Pieces of each text, as the library counts them."""
        keys = [pieces.segments(t) for t in texts]
        seen = set().union(*keys)
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        words = self.words
        for key in seen:
            if key not in words:
                self._learn(key)
        at = words.__getitem__
        return [sum(map(at, k)) for k in keys]

    def chunk_map(self, chunk: str, first: bool) -> tuple[str, int | None, str]:
        """head, count and tail of a chunk; count is None where the chunk has no border inside."""
        text = (pieces.SPACE if first and chunk else "") + chunk.replace(" ", pieces.SPACE)
        parts = self.vocabulary.cuts(text) if text else [""]
        if len(parts) == 1:
            return parts[0], None, ""
        return parts[0], sum(self.transducer.run(p)[1] for p in parts[1:-1]), parts[-1]

    def compose(self, left: tuple[str, int | None, str], right: tuple[str, int | None, str]) -> tuple[str, int | None, str]:
        """The map of two chunks in order; associative, so maps may be put together in any grouping."""
        if left[1] is None and right[1] is None:
            return self._joined(left[0] + right[0])
        if left[1] is None:
            head = self._joined(left[0] + right[0])
            return (head[0], right[1], right[2]) if head[1] is None else (head[0], head[1] + self.total(head[2]) + right[1], right[2])
        end = left[2] + right[0]
        if right[1] is None:
            tail = self._joined(end)
            return (left[0], left[1], tail[0]) if tail[1] is None else (left[0], left[1] + self.total(tail[0]) + tail[1], tail[2])
        return left[0], left[1] + sum(self.total(p) for p in self.vocabulary.cuts(end)) + right[1], right[2]

    def _joined(self, text: str) -> tuple[str, int | None, str]:
        parts = self.vocabulary.cuts(text)
        if len(parts) == 1:
            return text, None, ""
        return parts[0], sum(self.total(p) for p in parts[1:-1]), parts[-1]

    def total(self, text: str) -> int:
        return self.transducer.run(text)[1]

    def finish(self, whole: tuple[str, int | None, str]) -> int:
        return self.total(whole[0]) + (whole[1] or 0) + self.total(whole[2])


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter for a vocabulary file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", limit: int = 4096, chunk: int = 1 << 18) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row.

    Texts up to ``chunk`` characters are counted where they lie. Longer ones are cut into chunks that
    are spread over tasks; only the maps of the chunks (their open ends and a number) are shuffled.

    Defined results: a null text is the empty text with no tokens; equal or null ids stay separate
    rows; extra columns are ignored.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(text).alias("body"))
    rows = rows.withColumn("n_bytes", F.octet_length("body").cast("long"))
    length = F.length("body")

    def whole(texts: list[str]) -> dict:
        return {"n_tokens": pa.array(counter(model).counts(texts), pa.int64())}

    short = map_texts(rows.where(length <= chunk), whole, "n_tokens bigint", text="body")

    long = rows.where(length > chunk).withColumn("row", F.monotonically_increasing_id())
    starts = F.expr(f"sequence(0, CAST((length(body) - 1) DIV {chunk} AS INT))")
    cut = long.select("doc_id", "row", "n_bytes", "body", F.explode(starts).alias("part"))
    cut = cut.select("doc_id", "row", "n_bytes", "part", F.expr(f"substring(body, part * {chunk} + 1, {chunk})").alias("body"))

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [counter(model).chunk_map(t, p == 0) for t, p in zip(batch["body"], batch["part"])]
            out = batch.drop(columns="body")
            out["head"], out["inner"], out["tail"] = [m[0] for m in made], pd.array([m[1] for m in made], dtype="Int64"), [m[2] for m in made]
            yield out

    kind = dict(rows.dtypes)["doc_id"]
    mapped = cut.repartition("row", "part").mapInPandas(maps, f"doc_id {kind}, row bigint, n_bytes bigint, part int, head string, inner bigint, tail string")

    def put_together(group: pd.DataFrame) -> pd.DataFrame:
        own = counter(model)
        group = group.sort_values("part")
        levels = [(h, None if pd.isna(n) else int(n), t) for h, n, t in zip(group["head"], group["inner"], group["tail"])]
        while len(levels) > 1:
            pairs = [own.compose(*levels[i : i + 2]) for i in range(0, len(levels) - 1, 2)]
            levels = pairs + levels[len(pairs) * 2 :]
        return group.iloc[:1][["doc_id", "n_bytes"]].assign(n_tokens=own.finish(levels[0]))

    joined = mapped.groupBy("row").applyInPandas(put_together, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    both = short.unionByName(joined)
    return both.withColumn("over_limit", F.col("n_tokens") > limit)
