"""Token ids in entropy-coded files: a static range asymmetric numeral system.

A segment holds whole documents in ascending id order. Its file (one binary value) is

    magic "RNS1", u32 length of the table, the table (zlib: symbols as u32 differences, counts as u32),
    u32 number of blocks, then per block (a checkpoint): u32 ids, u32 lanes, u32 words, u32 crc32 of the
    ids as little-endian u32, u64 offset of the body; then the bodies: one u64 state a lane, u32 words.

All integers are little-endian. The counts of a segment add up to 2^20 and are shared by its blocks.
Id k of a block belongs to lane k mod lanes; all lanes advance together, so a step is one array
operation. Blocks do not depend on each other and are decoded from their checkpoints in any order.
Memory in a task is bounded by a segment plus the longest document.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import slabs, spark_schema, stage, text_or_empty

MAGIC = b"RNS1"
PRECISION = np.uint64(20)
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
#: Ids in a block and in a segment (before the document that fills it ends), and most lanes of a block.
BLOCK_IDS, SEGMENT_IDS, LANES = 1 << 18, 1 << 21, 1024


class Table:
    """Counts of the symbols that occur, scaled to 2^20; each keeps one at least."""

    def __init__(self, symbols: np.ndarray, counts: np.ndarray) -> None:
        self.symbols, self.counts = symbols.astype(np.uint32), counts.astype(np.uint64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)[:-1]]).astype(np.uint64)

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        seen = np.bincount(ids)
        symbols = np.flatnonzero(seen)
        if len(symbols) > 1 << 19:
            raise ValueError("too many different ids for one table")
        room = (1 << 20) - len(symbols)
        counts = 1 + seen[symbols] * room // max(1, len(ids))
        counts[np.argmax(counts)] += (1 << 20) - counts.sum()
        return cls(symbols, counts)

    def pack(self) -> bytes:
        return zlib.compress(np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4").tobytes() + self.counts.astype("<u4").tobytes())

    @classmethod
    def unpack(cls, data: bytes) -> Table:
        both = np.frombuffer(zlib.decompress(data), "<u4").reshape(2, -1)
        return cls(np.cumsum(both[0]), both[1])


def encode_block(ranks: np.ndarray, table: Table) -> tuple[int, bytes, int]:
    """Lanes, body and number of words of a block of symbol ranks."""
    lanes = int(max(1, min(LANES, len(ranks) // 64)))
    state = np.full(lanes, LOW, np.uint64)
    limit = table.counts << np.uint64(43)
    words: list[np.ndarray] = []
    for start in range((len(ranks) - 1) // lanes * lanes, -1, -lanes):
        rank = ranks[start : start + lanes]
        x = state[: len(rank)]
        full = x >= limit[rank]
        words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        x = np.where(full, x >> WORD, x)
        count = table.counts[rank]
        whole = x // count
        state[: len(rank)] = (whole << PRECISION) + (x - whole * count) + table.starts[rank]
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    return lanes, state.astype("<u8").tobytes() + stream.tobytes(), len(stream)


def decode_block(body: bytes, size: int, lanes: int, table: Table, slots: np.ndarray) -> np.ndarray:
    """Symbol ranks of a block; ``slots`` gives the rank of each of the 2^20 slots."""
    state = np.frombuffer(body, "<u8", lanes).astype(np.uint64)
    words = np.frombuffer(body, "<u4", offset=8 * lanes).astype(np.uint64)
    out = np.empty(size, np.int64)
    at = 0
    for start in range(0, size, lanes):
        x = state[: size - start]
        slot = x & np.uint64((1 << 20) - 1)
        rank = slots[slot.astype(np.int64)]
        out[start : start + len(x)] = rank
        x = table.counts[rank] * (x >> PRECISION) + slot - table.starts[rank]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << WORD) | words[at : at + len(low)]
        at += len(low)
        state[: len(x)] = x
    return out


def pack(ids: np.ndarray) -> bytes:
    """The file of a segment."""
    if not len(ids):
        return MAGIC + struct.pack("<II", 0, 0)
    table = Table.of(ids)
    packed = table.pack()
    rank = np.zeros(int(ids.max()) + 1, np.int64)
    rank[table.symbols] = np.arange(len(table.symbols))
    heads, bodies, offset = [], [], 0
    for start in range(0, len(ids), BLOCK_IDS):
        block = ids[start : start + BLOCK_IDS]
        lanes, body, words = encode_block(rank[block], table)
        heads.append(struct.pack("<IIIIQ", len(block), lanes, words, zlib.crc32(block.astype("<u4").tobytes()), offset))
        bodies.append(body)
        offset += len(body)
    return b"".join([MAGIC, struct.pack("<I", len(packed)), packed, struct.pack("<I", len(heads)), *heads, *bodies])


def unpack(data: bytes, blocks: range | None = None) -> np.ndarray:
    """The ids of a segment, or of a range of its blocks; a block that fails its checksum raises."""
    if data[:4] != MAGIC:
        raise ValueError("not a segment")
    (size,) = struct.unpack_from("<I", data, 4)
    (count,) = struct.unpack_from("<I", data, 8 + size)
    if not count:
        return np.zeros(0, np.uint32)
    table = Table.unpack(data[8 : 8 + size])
    slots = np.repeat(np.arange(len(table.symbols)), table.counts.astype(np.int64))
    first = 12 + size + 24 * count
    out = []
    for number in blocks if blocks is not None else range(count):
        n, lanes, words, crc, offset = struct.unpack_from("<IIIIQ", data, 12 + size + 24 * number)
        body = data[first + offset : first + offset + 8 * lanes + 4 * words]
        ids = table.symbols[decode_block(body, n, lanes, table, slots)]
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError(f"block {number} does not match its checksum")
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


#: Latin letters that lower to one letter each, and ASCII marks behind them: two parts of their own.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
LATIN_WORD = rf"^(?P<bare>[{LETTERS}]+)(?P<mark>[!-/:-@\[-`{{-~]*)$"
BARE_WORD = rf"^[{LETTERS}]+$"


class WordIds:
    """Ids of texts by the tokenizers library, word by word, with the ids of seen words kept.

    The vocabulary drops white space before anything else looks at a text, so the parts between blanks
    and line breaks are encoded on their own. Latin words differ only in case from their lower form, and
    the marks behind one are a part of their own; such lower forms are one part and need no rules but the merges.
    """

    #: Words kept, words that the library gets at once, and characters that are handled at once.
    MAX_WORDS, AT_ONCE, SLAB = 500_000, 10_000, 2_000_000

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.model = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.model.model)
        self.merges.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        # the piece that ends a part says so
        suffix, vocabulary = self.model.model.end_of_word_suffix, self.model.get_vocab()
        self.ends = np.zeros(1 + max(vocabulary.values()), bool)
        if suffix:
            self.ends[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
        self.words: dict[str, bytes] = {"": b""}

    def _ids(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _keep(self, order: list[str], ids: np.ndarray, ends: list[int]) -> None:
        raw, start = ids.tobytes(), 0
        for word, end in zip(order, ends):
            self.words[word] = raw[4 * start : 4 * end]
            start = end

    def _learn_lower(self, order: list[str]) -> None:
        """Keep the ids of lower Latin words."""
        for first in range(0, len(order), self.AT_ONCE):
            part = order[first : first + self.AT_ONCE]
            ids = np.array(self.merges.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part):
                self._keep(part, ids, ends.tolist())
            else:
                self._learn(part)

    def _learn(self, order: list[str]) -> None:
        """Keep the ids of any words."""
        if not order:
            return
        told = self.model.encode(order, is_pretokenized=True, add_special_tokens=False)
        # special strings belong to no word: words that may hold one are encoded alone
        index = np.array([-1 if w is None else w for w in told.word_ids], np.int64)
        if (index < 0).any():
            for word in order:
                self.words[word] = self._ids(word)
        else:
            self._keep(order, np.array(told.ids, "<u4"), np.searchsorted(index, np.arange(len(order)), side="right").tolist())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian u32."""
        if not texts:
            return []
        parts = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = parts.flatten().dictionary_encode()
        latin = pc.extract_regex(coded.dictionary, LATIN_WORD)
        fits = latin.is_valid()
        words = pc.if_else(fits, pc.utf8_lower(pc.struct_field(latin, "bare")), coded.dictionary).dictionary_encode()
        marks = pc.if_else(fits, pc.struct_field(latin, "mark"), "").dictionary_encode()
        if len(self.words) > self.MAX_WORDS:
            self.words = {"": b""}
        names = words.dictionary.to_pylist() + marks.dictionary.to_pylist()
        made = list(map(self.words.get, names))
        missing = {n for n, ids in zip(names, made) if ids is None}
        if missing:
            order = list(missing)
            plain = pc.match_substring_regex(pa.array(order, pa.large_string()), BARE_WORD).to_pylist()
            self._learn_lower([n for n, p in zip(order, plain) if p])
            self._learn([n for n, p in zip(order, plain) if not p])
            made = list(map(self.words.__getitem__, names))
        # ids of the different names, then of the different parts (a word and its marks), then of all parts
        flat, upto = np.frombuffer(b"".join(made), "<u4"), np.concatenate([[0], np.cumsum(np.fromiter(map(len, made), np.int64, len(made)) // 4)])
        both = np.stack([words.indices.to_numpy(), marks.indices.to_numpy() + len(words.dictionary)], axis=1)
        flat, ends = _gathered(flat, upto, both.ravel())
        flat, upto = _gathered(flat, ends[::2], coded.indices.to_numpy())
        raw = flat.tobytes()
        at = (4 * upto[parts.offsets.to_numpy() - parts.offsets[0].as_py()]).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]


def _gathered(flat: np.ndarray, upto: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat``, whose borders are ``upto``, in the order of codes, and the borders of what comes out."""
    sizes = np.diff(upto)[codes]
    borders = np.concatenate([[0], np.cumsum(sizes)])
    return flat[np.repeat(upto[codes] - borders[:-1], sizes) + np.arange(borders[-1])], borders


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def write_ids(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode all texts and write segments in ascending document order below ``folder``.

    Rows: part, segment (both ascending with the ids of documents), doc_ids, lengths, n_ids and file.
    Texts are dealt out by ranges of ids, so parts are in order and of like size. A null text counts as
    empty; rows with equal ids follow each other by text; null ids come first; extra columns are ignored.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(text).alias("body"))
    kind = dict(rows.dtypes)["doc_id"]
    schema = spark_schema(f"part int, segment int, doc_ids array<{kind}>, lengths array<bigint>, n_ids bigint, file binary")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "body")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        own, tail = word_ids(vocabulary), np.array([end_id], "<u4").tobytes()
        names: list = []
        kept: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(kept), "<u4")
            columns = [[part], [number], [names], [[len(k) // 4 for k in kept]], [len(ids)], [pack(ids)]]
            types = [pa.int32(), pa.int32(), pa.list_(id_type), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column(0).type
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slabs(texts, own.SLAB):
                for name, encoded in zip(ids[a:b], own.encode(texts[a:b])):
                    names.append(name)
                    kept.append(encoded + tail)
                    size += len(encoded) // 4 + 1
                    if size >= SEGMENT_IDS:
                        yield close()
                        names, kept, size, number = [], [], 0, number + 1
        if names:
            yield close()
        # the worker goes on to other tasks; what this one took goes back
        pa.default_memory_pool().release_unused()

    ordered.mapInArrow(work, schema).write.mode("overwrite").parquet(folder)


def read_ids(spark, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and ids (u32, little-endian) from the files."""
    files = spark.read.parquet(folder)
    # one row a part, then one window a part: neither grows with the ids of a part
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "segment", "n_ids").withColumn("_in", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
    starts = stage(starts.join(parts, "part").select("part", "segment", (F.col("_in") + F.col("part_start")).alias("base")), "id-starts")
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    schema = spark_schema(f"part int, segment int, doc_id {kind}, offset bigint, n_tokens bigint, ids_crc32 bigint, ids binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = unpack(row["file"]).astype("<u4").tobytes()
                ends = np.cumsum(row["lengths"])
                offsets = (ends - row["lengths"]).tolist()
                texts = [raw[4 * a : 4 * b] for a, b in zip(offsets, ends.tolist())]
                n = len(texts)
                columns = [[row["part"]] * n, [row["segment"]] * n, row["doc_ids"], offsets, row["lengths"], [zlib.crc32(t) for t in texts], texts]
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, columns)), schema=to_arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    to_arrow = to_arrow_schema(schema)
    read = files.select("part", "segment", "doc_ids", "lengths", "file").mapInArrow(work, schema)
    told = read.join(F.broadcast(starts) if starts.limit(100_001).count() <= 100_000 else starts, ["part", "segment"])
    return told.select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "ids")
