import random
import re
from collections import Counter

import numpy as np
import pytest

from conftest import EXTRA
from holdfast.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
WORDS = ["the", "The", "oF", "harbour", "eightlet", "ninelette", "sixteenlettersxx", "seventeenletterss", "Seventeenletterst", "été", "ÉTÉ", "漢字", "😀", "straße" * 4, "a", "x" * 40, "ſ", " "]


def terms(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [t.translate(lower) for t in TERM.findall(text or "")]


def brute(rows, least, top=50):
    """Rows of (lang, source, part, item, value, rank) by plain counting."""
    counts, held, groups = {}, {}, set()
    for lang, source, text in rows:
        lang, source, found = lang or "", source or "", terms(text)
        groups.add((lang, source))
        counts.setdefault((lang, source), Counter()).update(found)
        held.setdefault(lang, Counter()).update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= least]
        sources = [s for g, s in groups if g == lang]

        def shares(of):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 5) // (total + 5 * len(kept)) for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        own = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(own[s][t] - own[o][t]) for t in kept)) for o in sources if o != s]
            over = [(t, own[s][t] - whole[t]) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", over, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def frame(spark, rows):
    clash = [c for c in dict.fromkeys([*EXTRA, "term", "n", "docs", "share", "kept", "total", "lanes", "bare", "item", "value", "rank", "a", "b"])]
    schema = "lang string, source string, text string, " + ", ".join(f"`{c}` string" for c in clash)
    return spark.createDataFrame([(*r, *["x"] * len(clash)) for r in rows], schema)


def sample(rnd, n, sources, langs=("en", "de", None, "")):
    return [(rnd.choice(langs), rnd.choice(sources), rnd.choice([None, "", "1 2 3", *[" ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(1, 30))) for _ in range(6)]])) for _ in range(n)]


@pytest.mark.parametrize("tile", [256, 3])
def test_equals_plain_counting(spark, monkeypatch, tile):
    monkeypatch.setattr(dv, "TILE", tile)
    rnd = random.Random(tile)
    rows = sample(rnd, 300, ["a", "B", "é", None, "z", "zz", "y", "😀"])
    # a group without terms, a language without kept terms, a language of one source, a long text
    rows += [("en", "bare", "123"), ("fr", "a", "seul"), ("fr", "b", "seul"), ("it", "a", "uno " * 9), ("en", "a", "Harbour, the " * 20_000)]
    got = dv.audit(frame(spark, rows), min_docs=4, top=5).select("lang", "source", "part", "item", "value", "rank")
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 4, 5)


def test_empty_tables(spark):
    assert dv.audit(frame(spark, [])).count() == 0
    assert sorted(tuple(r) for r in dv.audit(frame(spark, [(None, None, None), ("", "b", "")])).collect()) == brute([(None, None, None), ("", "b", "")], 30)


def test_packing_tells_all_terms_apart():
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("aAbZ zé😀1\n") for _ in range(rnd.randrange(0, 60))) for _ in range(200)] + ["", "a", "b" * 8, "b" * 9, "b" * 16, "b" * 17, "b" * 18]
    raw = [t.encode() for t in texts]
    group = np.array([i % 3 for i in range(len(texts))])
    got = Counter()
    held = Counter()
    for names, term, of, n, docs in dv.term_counts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw]), group):
        assert len(set(names)) == len(names)
        for t, g, k, d in zip(term, of, n, docs):
            assert (names[t], g) not in got
            got[names[t], g], held[names[t], g] = k, d
    want, docs = Counter(), Counter()
    for text, g in zip(texts, group):
        found = [t.encode() for t in terms(text)]
        want.update((t, g) for t in found)
        docs.update((t, g) for t in set(found))
    assert got == want and held == docs


def test_radix_order_is_stable():
    rnd = np.random.default_rng(1)
    high, low = rnd.integers(0, 2**64, 500, dtype=np.uint64) % np.uint64(7), rnd.integers(0, 2**63, 500, dtype=np.uint64) >> np.uint64(58)
    order = dv.radix_order([high, low])
    assert order.tolist() == sorted(range(500), key=lambda i: (high[i], low[i], i))


def test_shares_are_exact(spark):
    rows = [(10**15, 10**18, 10**9), (0, 3, 7), (9, 10, 1)]
    df = spark.createDataFrame(rows, "n long, total long, kept long")
    from pyspark.sql import functions as F

    got = [r[0] for r in df.select(dv.share(F.col("n"), F.col("total"), F.col("kept"))).collect()]
    assert got == [1 + 10**9 * (n + 5) // (t + 5 * k) for n, t, k in rows]
