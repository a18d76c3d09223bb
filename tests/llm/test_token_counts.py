import functools

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from holdfast.llm import pieces, sentencepieces, token_counts

TEXT = st.lists(st.sampled_from(list("aeiouthens  \n.,'\"0123▁é漢字😀\t́Ω") + ["    ", "ing", "the ", " \n"]), max_size=40).map("".join)


@pytest.fixture(scope="module")
def library(pieces_model):
    return sentencepiece.SentencePieceProcessor(model_file=pieces_model)


def test_counts_and_ids_equal_the_library(pieces_model, library):
    counter, lattice = token_counts.counter(pieces_model), sentencepieces.lattice(pieces_model)

    @settings(max_examples=400, deadline=None)
    @given(TEXT, st.integers(1, 7))
    def check(text, size):
        ids = library.encode(text)
        assert counter.counts([text]) == [len(ids)]
        encoded = lattice.encode([text])
        assert list(memoryview(encoded[0]).cast("i")) == ids
        assert lattice.decode(encoded) == [library.decode(ids)]
        if text:
            maps = [counter.chunk_map(text[i : i + size], i == 0) for i in range(0, len(text), size)]
            assert counter.finish(functools.reduce(counter.compose, maps)) == len(ids)
            assert counter.finish(functools.reduce(lambda a, b: counter.compose(b, a), maps[::-1])) == len(ids)

    check()


def test_states_start_afresh(pieces_model, library, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 20)
    monkeypatch.setattr(token_counts, "MAX_WORDS", 5)
    own = token_counts.Counter(pieces_model)
    texts = ["some quite different words here", "and a few more of them, of course"]
    assert [own.counts([t])[0] for t in texts] == [len(library.encode(t)) for t in texts]


@pytest.mark.parametrize("chunk", [1 << 18, 7])
def test_frame(documents, odd, pieces_model, library, chunk):
    rows = [(i, t if chunk > 100 or t is None else t[:200]) for i, t in odd]
    got = token_counts.count_tokens(documents(rows), pieces_model, limit=3, chunk=chunk).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 3) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table(documents, pieces_model):
    assert token_counts.count_tokens(documents([]), pieces_model).count() == 0


def test_segments_cover_the_text():
    for text in ("", " ", "a", "  a b  ", "\n", "a \n b\n\nc ", "▁a"):
        spelled = "".join("".join(pieces.spelled(k)) for k in pieces.segments(text))
        assert spelled == (("▁" + text.replace(" ", "▁")) if text else "")
