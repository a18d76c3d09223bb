"""Encoding texts into pieces and back, by a batched lattice search.

Words that have not been seen are grouped by length and advance together, one character a step. At
each step the hashes of all substrings that end there probe the sorted hashes of the vocabulary, and
each substring that is a piece is tried behind the best piece of its own start. The library's merges
leave exactly one piece that fits there (see ``pieces``), so the score of an arc is 0 where the two
pieces may be neighbours and minus infinity elsewhere, and the maximum over arcs is stored as a
backpointer. Words are then read back along the backpointers, all at once.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import pieces
from holdfast.llm.common import SLAB, map_texts, text_or_empty

#: Words that a worker remembers, and words that advance together.
MAX_WORDS, BATCH = 250_000, 20_000
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MARKS = frozenset(",.!?;:")
#: Bits of the table of decided neighbours and of the table of piece hashes.
PAIR_BITS, FILTER_BITS = 20, 22


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1).astype(np.uint64)


class Lattice:
    def __init__(self, path: str) -> None:
        v = self.vocabulary = pieces.load(path)
        if not v.words_apart:
            raise ValueError("this vocabulary has pieces that go on over the start of a word")
        self.names = {i: name for name, i in v.ids.items()}
        self.border = len(v.bytes)
        self.names[self.border] = ""
        self.powers = np.array([pow(int(BASE), k, 1 << 64) for k in range(v.longest + 1)], np.uint64)
        keys = np.array([self._prefixes(_codes([n]))[0, -1] for n in v.ids], np.uint64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces have one hash")
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(list(v.ids.values()), np.int32)[order]
        self.may_be = np.zeros(1 << FILTER_BITS, bool)
        self.may_be[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.pair_keys = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_fits = np.zeros(1 << PAIR_BITS, bool)
        self.words: dict[str, bytes] = {}
        self.lengths = np.array([len(b) for b in v.bytes], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.spelling = np.frombuffer(b"".join(v.bytes), np.uint8)

    @staticmethod
    def _prefixes(codes: np.ndarray) -> np.ndarray:
        out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
        for i in range(codes.shape[1]):
            out[:, i + 1] = out[:, i] * BASE + codes[:, i] + np.uint64(1)
        return out

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each right piece may follow its left one; what is not yet decided is decided once."""
        key = left.astype(np.int64) * (self.border + 1) + right
        slot = ((key.astype(np.uint64) * BASE) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        open_ = np.flatnonzero(self.pair_keys[slot] != key)
        fits = self.pair_fits[slot]
        if len(open_):
            todo, back = np.unique(key[open_], return_inverse=True)
            names, together = self.names, self.vocabulary.together
            told = np.array([together(names[k // (self.border + 1)], names[k % (self.border + 1)]) for k in todo.tolist()], bool)
            fits[open_] = told[back]
            slots = slot[open_]
            self.pair_keys[slots], self.pair_fits[slots] = key[open_], fits[open_]
        return fits

    def search(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Last piece and its length at every border of words of one length."""
        codes = _codes(words)
        n, size = codes.shape
        prefix = self._prefixes(codes)
        last = np.full((n, size + 1), self.border, np.int32)
        back = np.zeros((n, size + 1), np.int16)
        for i in range(1, size + 1):
            for k in range(1, min(i, self.vocabulary.longest) + 1):
                key = prefix[:, i] - prefix[:, i - k] * self.powers[k]
                rows = np.flatnonzero(self.may_be[(key >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
                if not len(rows):
                    continue
                at = np.searchsorted(self.keys, key[rows])
                hit = (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == key[rows])
                rows, piece = rows[hit], self.key_ids[at[hit]]
                fits = self._fit(last[rows, i - k], piece)
                rows, piece = rows[fits], piece[fits]
                last[rows, i], back[rows, i] = piece, k
        # a character outside the vocabulary is spelled in bytes and is a border to both sides
        back[:, 1:][back[:, 1:] == 0] = 1
        return last, back

    def _encode_equal(self, words: list[str]) -> list[bytes]:
        """Ids of words of one length, as little-endian 32-bit integers."""
        last, back = self.search(words)
        n, size = last.shape[0], last.shape[1] - 1
        found = np.full((n, size), -1, np.int32)
        at, rows = np.full(n, size), np.arange(n)
        for slot in range(size - 1, -1, -1):
            live = at > 0
            if not live.any():
                break
            piece = last[rows, at]
            found[:, slot] = np.where(live, piece, -1)
            at = np.where(live, at - back[rows, at], 0)
        whole = found >= 0
        ends = np.cumsum(whole.sum(axis=1))
        flat = found[whole].astype("<i4")
        odd = set(np.flatnonzero((found == self.border).any(axis=1)).tolist())
        raw, out, start = flat.tobytes(), [], 0
        for row, end in enumerate(ends.tolist()):
            out.append(self._spelled(words[row], flat[start:end], back[row]) if row in odd else raw[4 * start : 4 * end])
            start = end
        return out

    def _spelled(self, word: str, ids: np.ndarray, back: np.ndarray) -> bytes:
        out, at = [], len(word)
        for piece in ids[::-1].tolist():
            step = int(back[at])
            if piece == self.border:
                out[:0] = [self.vocabulary.byte_ids[b] for b in word[at - step : at].encode("utf-8", "surrogatepass")]
            else:
                out.insert(0, piece)
            at -= step
        return np.array(out, "<i4").tobytes()

    def _learn(self, keys: list[str]) -> None:
        v, words = self.vocabulary, self.words
        marked = [k for k in keys if len(k) > 1 and k[-1] in MARKS and k[-1] in v.ids and k[-2:] not in v.pairs and k[-2] not in MARKS]
        split = set(marked)
        bare = {k for k in keys if k not in split} | {k[:-1] for k in marked if k[:-1] not in words}
        by_size: dict[int, list[tuple[str, str, str]]] = {}
        for key in bare:
            broken, text = pieces.spelled(key)
            if text:
                by_size.setdefault(len(text), []).append((key, broken, text))
            else:
                words[key] = self._break()
        for group in by_size.values():
            for i in range(0, len(group), BATCH):
                part = group[i : i + BATCH]
                for (key, broken, _), ids in zip(part, self._encode_equal([t for _, _, t in part])):
                    words[key] = self._break() + ids if broken else ids
        for key in marked:
            words[key] = words[key[:-1]] + np.int32(v.ids[key[-1]]).astype("<i4").tobytes()

    def _break(self) -> bytes:
        return np.int32(self.vocabulary.byte_ids[10]).astype("<i4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as the library gives them."""
        keys = [pieces.segments(t) for t in texts]
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        self._learn([k for k in set().union(*keys) if k not in self.words])
        at = self.words.__getitem__
        return [b"".join(map(at, k)) for k in keys]

    def decode(self, encoded: list[bytes]) -> list[str]:
        """Texts of ids: pieces spelled out, space marks as spaces, without the one in front."""
        ids = np.frombuffer(b"".join(encoded), "<i4")
        size = self.lengths[ids]
        ends = np.cumsum(size)
        gather = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - size), size)
        raw = self.spelling[gather].tobytes()
        borders = np.concatenate([[0], ends])[np.cumsum([0] + [len(e) // 4 for e in encoded])].tolist()
        return [raw[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(borders, borders[1:])]


_LATTICES: dict[str, Lattice] = {}


def lattice(path: str) -> Lattice:
    """The worker's lattice for a vocabulary file."""
    if path not in _LATTICES:
        _LATTICES[path] = Lattice(path)
    return _LATTICES[path]


def _lists(encoded: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0] + [len(e) // 4 for e in encoded]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), "<i4")))


def encode_documents(docs: DataFrame, model: str, text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """All rows and columns, with the ids of the text in a column ``ids``.

    Defined results: a null text has no ids, as the empty one; a space mark in a text is read as a
    space, as the library reads it. A column named ``ids`` is replaced.
    """

    def work(texts: list[str]) -> dict:
        return {ids: _lists(lattice(model).encode(texts))}

    rows = docs.select(*[F.col(f"`{c}`").cast("string").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c != ids])
    return map_texts(rows, work, f"`{ids}` array<int>", text=text, keep=True, limit=SLAB // 4)


def decode_documents(encoded: DataFrame, model: str, ids: str = "piece_ids", text: str = "text") -> DataFrame:
    """All other columns, with the text of the ids in a column ``text``; null ids give the empty text."""

    def work(lists: list) -> dict:
        own = lattice(model)
        return {text: pa.array(own.decode([np.asarray(x if x is not None else [], "<i4").tobytes() for x in lists]), pa.string())}

    return map_texts(encoded.select(*[c for c in encoded.columns if c != text]), work, f"`{text}` string", text=ids)


def round_trip(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of the ids as little-endian 32-bit integers), restored and piece_ids.

    Each text is encoded and its ids decoded again; restored tells whether that gives the text back.
    """

    def work(texts: list[str]) -> dict:
        own = lattice(model)
        encoded = own.encode(texts)
        back = own.decode(encoded)
        return {
            "n_pieces": pa.array([len(e) // 4 for e in encoded], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(e) for e in encoded], pa.int64()),
            "restored": pa.array([a == b.replace(pieces.SPACE, " ") for a, b in zip(back, texts)], pa.bool_()),
            "piece_ids": _lists(encoded),
        }

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(text).alias("body"))
    return map_texts(rows, work, "n_pieces bigint, ids_crc32 bigint, restored boolean, piece_ids array<int>", text="body")
