import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from holdfast.llm import rans


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=400), st.integers(1, 40))
def test_pack_round_trip(ids, times):
    ids = np.array(ids * times, np.uint32)
    assert (rans.unpack(rans.pack(ids)) == ids).all()


def test_blocks_are_independent_and_checked(monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_IDS", 1000)
    ids = np.random.default_rng(1).geometric(0.01, 5500).astype(np.uint32)
    data = rans.pack(ids)
    assert (rans.unpack(data, range(2, 4)) == ids[2000:4000]).all()
    broken = bytearray(data)
    broken[-5] ^= 1
    with pytest.raises(ValueError):
        rans.unpack(bytes(broken))


def test_one_symbol_and_skew():
    for ids in ([5] * 10_000, [0] * 9_999 + [49_407], []):
        ids = np.array(ids, np.uint32)
        assert (rans.unpack(rans.pack(ids)) == ids).all()


def test_words_equal_the_library(words_model):
    own, library = rans.WordIds(words_model), Tokenizer.from_file(words_model)
    parts = list("aeiouthens  \n.,'\"0123▁é漢字😀\t́Σσ") + ["ing", "the ", "<|endoftext|>", "<|startoftext|>", " 's", "İ", "\u0085", "\xa0", "\x1c", "ANT"]

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.sampled_from(parts), max_size=30).map("".join))
    def check(text):
        assert list(memoryview(own.encode([text])[0]).cast("I")) == library.encode(text, add_special_tokens=False).ids

    check()


def test_latin_words_with_marks_need_only_the_merges(words_model, monkeypatch):
    letters = [chr(c) for c in range(0x21, 0x250)]
    marks = ["", ",", "%%%", ",!!", "'", "'s", "_.", "<|", "1"]
    text = " ".join(f"{a}{b}{m}" for a in letters for b in ("", "x", "É") for m in marks)
    own, library = rans.WordIds(words_model), Tokenizer.from_file(words_model)
    assert list(memoryview(own.encode([text])[0]).cast("I")) == library.encode(text, add_special_tokens=False).ids
    # each lower form is encoded once, whatever its case and marks, and only the marks by the library's rules
    slow, fast = [], []
    own = rans.WordIds(words_model)
    learn, learn_lower = own._learn, own._learn_lower
    monkeypatch.setattr(own, "_learn", lambda order: (slow.extend(order), learn(order)))
    monkeypatch.setattr(own, "_learn_lower", lambda order: (fast.extend(order), learn_lower(order)))
    own.encode(["Éclair éclair%%% ÉCLAIR, word.", "Word\n%%%"])
    assert sorted(fast) == ["word", "éclair"] and sorted(slow) == ["%%%", ",", "."]


def test_files(spark, documents, odd, words_model, tmp_path, monkeypatch):
    library = Tokenizer.from_file(words_model)
    rows = odd + [(i, f"text number {i}, " * (i % 7)) for i in range(100, 160)]
    rans.write_ids(documents(rows), words_model, str(tmp_path / "ids"))
    got = rans.read_ids(spark, str(tmp_path / "ids")).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for row, (name, text) in zip(got, order, strict=True):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (name, start, len(ids) // 4, zlib.crc32(ids))
        assert bytes(row["ids"]) == ids
        start += len(ids) // 4


def test_empty_table(spark, documents, words_model, tmp_path):
    rans.write_ids(documents([]), words_model, str(tmp_path / "ids"))
    assert rans.read_ids(spark, str(tmp_path / "ids")).count() == 0
