import random
import re

import numpy as np

from holdfast.llm import near_text
from holdfast.llm.graph import components


def bare(text):
    return [w.strip(near_text.MARKS).lower() or w for w in (text or "").split()]


def shingles(text):
    w = bare(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes(rows):
    """Least id of the component of each id, by all pairs."""
    rows = [(i, t) for i, t in rows if i is not None]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and len(a & b) >= 0.8 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in parent}


def corpus():
    rnd = random.Random(4)
    vocabulary = [f"word{k}" for k in range(3000)]
    rows = []
    for n in range(40):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randrange(60, 200))]
        for _ in range(rnd.choice([1, 1, 2, 30 if n == 3 else 3])):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1])):
                copy[rnd.randrange(len(copy))] = "changed"
            rows.append((len(rows), " ".join(copy)))
    # a chain: each text is near the next one, the ends are far apart
    chain = [rnd.choice(vocabulary) for _ in range(100)]
    for n in range(12):
        chain = chain[3:] + [f"new{n}_{k}" for k in range(3)]
        rows.append((len(rows), " ".join(chain)))
    rnd.shuffle(rows)
    return rows


def test_classes_equal_brute_force(documents, odd):
    rows = corpus() + [(1000 + i, t) for i, t in odd if i is not None] + [(None, "no id"), (2001, "Few words"), (2002, "few, WORDS!"), (2003, "few others")]
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_text.near_copies(documents(rows)).collect()}
    want = classes(rows)
    assert {k: v[0] for k, v in got.items()} == want
    assert all(kept == (k == c) for k, (c, kept) in got.items())


def test_drop_keeps_one_of_each_class(documents):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (2, "other words altogether here now"), (4, None), (5, ""), (None, "a b c d e f g")]
    frame = documents(rows)
    left = near_text.drop_near_copies(frame)
    assert left.columns == frame.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted([1, 2, 4, 5, None], key=str)


def test_empty_table(documents):
    assert near_text.near_copies(documents([])).count() == 0
    assert near_text.drop_near_copies(documents([])).count() == 0


def test_registers_estimate_probability_jaccard():
    rnd = random.Random(9)
    names = [f"x{k} y{k} z{k} u{k} v{k}" for k in range(3000)]
    estimates, wanted = [], []
    for _ in range(20):
        a = " ".join(rnd.choice(names) for _ in range(150))
        b = a + " " + " ".join(rnd.choice(names) for _ in range(50))
        owner, run, count = near_text.runs(*near_text.word_hashes([a, b]))
        won = near_text.signatures(owner, run, count, 2)
        estimates.append((won[0] == won[1]).mean())
        one, two = ({int(r): 1 + np.log(c) for o, r, c in zip(owner, run, count) if o == k} for k in (0, 1))
        every = one.keys() | two.keys()
        total = 0.0
        for d in one.keys() & two.keys():
            total += 1 / sum(max(one.get(e, 0) / one[d], two.get(e, 0) / two[d]) for e in every)
        wanted.append(total)
    assert abs(np.mean(estimates) - np.mean(wanted)) < 0.02


def test_components(spark):
    rnd = random.Random(6)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)] + [(1000 + k, 1001 + k) for k in range(40)] + [(7, 7), (2000, 7), (2000, 7)]
    parent = {x: x for e in links for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["component"] for r in got} == {x: root(x) for x in linked}
    assert len(got) == len(linked)


def test_words_are_bare():
    assert re.match(r"\w", "a") and bare('The, "END!" ...') == ["the", "end", "..."]


def test_copies_in_which_a_passage_recurs(documents):
    rnd = random.Random(12)
    rows = []
    for times in (2, 3, 10, 100):
        for _ in range(25):
            base = [f"word{rnd.randrange(3000)}" for _ in range(120)]
            other = list(base)
            for at in rnd.sample(range(5, 120, 10), 2):
                other[at] = "changed"
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(other[:60] * times + other[60:]))]
    want = classes(rows)
    assert all(want[i + 1] == i for i in range(0, len(rows), 2))
    got = {r["doc_id"]: r["class_id"] for r in near_text.near_copies(documents(rows)).collect()}
    assert got == want


def test_bands_of_texts_with_and_without_repeats():
    once, twice = "a b c d e f g h", "p q r s t p q r s t p q r s t u"
    made = near_text.sketch(["", once, twice, once])["bands"].to_pylist()
    assert len(made[1]) == near_text.BANDS and made[1] == made[3]
    assert near_text.BANDS < len(made[2]) <= 2 * near_text.BANDS and len(set(made[2])) == len(made[2])
    # the plain set is that of a text in which each of these runs comes once
    owner, run, count = near_text.runs(*near_text.word_hashes([twice]))
    plain = near_text.bands(near_text.signatures(owner, run, np.ones(len(run)), 1))[0].tolist()
    assert set(plain) <= set(made[2])


def test_one_short_text_a_partition(spark):
    rows = [(1, "hello there"), (2, "one"), (3, "one two three"), (4, "Hello, there!"), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    for n in range(1, 5):
        near_text.sketch(["word " * n])
    got = {r["doc_id"]: r["class_id"] for r in near_text.near_copies(df).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 1, 5: 5}


def test_a_bucket_of_unlike_texts_takes_few_rounds(spark, documents, monkeypatch):
    # texts that share a passage meet in many buckets, but are linked only where they are alike
    rnd = random.Random(8)
    vocabulary = [f"w{k}" for k in range(4000)]
    passage = [rnd.choice(vocabulary) for _ in range(100)]
    rows = [(n, " ".join(passage + [rnd.choice(vocabulary) for _ in range(rnd.choice([12, 15, 30, 45]))])) for n in range(150)]
    rounds = []
    components_of = near_text.stage
    monkeypatch.setattr(near_text, "PAIRS", 0)
    monkeypatch.setattr(near_text, "stage", lambda df, label: rounds.append(label) or components_of(df, label))
    got = {r["doc_id"]: r["class_id"] for r in near_text.near_copies(documents(rows)).collect()}
    assert got == classes(rows)
    assert rounds.count("pairs") <= 5
