import itertools
import random
import zlib

import numpy as np
import pytest

from holdfast.llm import toxicity


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    words = [f"plain{k}" for k in range(600)]
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        body = [rnd.choice(words) for _ in range(rnd.randrange(20, 90))]
        if toxic:
            for _ in range(rnd.randrange(1, 4)):
                body.insert(rnd.randrange(len(body)), rnd.choice(["Vileman", "rotten,", f"scurvy{rnd.randrange(99)}"]))
        rows.append((i, " ".join(body), int(toxic)))
    return rows


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    emission, transition = rng.normal(size=11), rng.normal(size=(2, 2))
    starts, sizes = np.array([0, 4, 9]), np.array([4, 5, 2])
    got, pairs = toxicity.marginals(emission, transition, starts, sizes)
    want, both = np.zeros(11), np.zeros((2, 2))
    for start, size in zip(starts, sizes):
        total, here, joint = 0.0, np.zeros(size), np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=int(size)):
            p = np.exp(sum(emission[start + k] for k, t in enumerate(tags) if t) + sum(transition[a, b] for a, b in zip(tags, tags[1:])))
            total += p
            here += p * np.array(tags)
            for a, b in zip(tags, tags[1:]):
                joint[a, b] += p
        want[start : start + size] = here / total
        both += joint / total
    assert np.allclose(got, want) and np.allclose(pairs, both)


def test_chains_cover_every_word():
    lengths = np.array([0, 5, toxicity.CHAIN, 0, toxicity.CHAIN * 2 + 1])
    starts, sizes = toxicity.chains(lengths)
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(starts, sizes)])
    assert (covered == np.arange(lengths.sum())).all() and sizes.max() <= toxicity.CHAIN


def test_held_out_accuracy_and_spans(spark, documents):
    rows = corpus()
    labels = spark.createDataFrame([(i, None, t) for i, _, t in rows], "doc_id long, quality int, toxic int")
    docs = documents([(i, t) for i, t, _ in rows])
    model = toxicity.train(docs, labels)
    scored = toxicity.score_documents(docs.select("doc_id", "text"), model).withColumn("held_out", toxicity.held_out()).collect()
    truth = {i: t for i, _, t in rows}
    for row in scored:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1
    held = [(r["score"] >= toxicity.THRESHOLD, bool(truth[r["doc_id"]])) for r in scored if r["held_out"]]
    assert len(held) > 60 and sum(a == b for a, b in held) >= 0.97 * len(held)
    marked = [r["text"][s["start"] : s["end"]] for r in scored for s in r["spans"]]
    assert marked and np.mean([m.startswith(("Vileman", "rotten", "scurvy")) for m in marked]) > 0.9


def test_labels_of_held_out_rows_are_not_read(spark, documents):
    rows = corpus(120)
    docs = documents([(i, t) for i, t, _ in rows])
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    one = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    two = spark.createDataFrame([(i, 1 - t if i in held else t) for i, _, t in rows], "doc_id long, toxic int")
    assert toxicity.train(docs, one).key == toxicity.train(docs, two).key


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(1, 0), (3, 0)], 0.0), ([(1, 1), (3, 1)], 1.0), ([(1, None), (None, 1)], 0.0)])
def test_one_sided_labels(spark, documents, labels, score):
    docs = documents([(1, "some text"), (3, "more text"), (4, None)])
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score_documents(docs, model).collect()} == {score}


def test_odd_rows(spark, documents, odd):
    rows = corpus(200)
    model = toxicity.fit([t for _, t, _ in rows], [t for _, _, t in rows])
    frame = documents(odd)
    scored = toxicity.score_documents(frame, model)
    assert scored.count() == len(odd)
    left = toxicity.drop_toxic(frame, model)
    assert left.columns == frame.columns and left.count() == len(odd)
    assert toxicity.drop_toxic(documents([]), model).count() == 0


def test_copies_in_the_sample_count_once():
    text = " ".join(f"w{k}" for k in range(60))
    assert toxicity.distinct_texts([text, text, text + " more", "something else entirely", ""]) [:2] == [0, 3]


def test_training_reads_long_texts_whole(spark, documents):
    rnd = random.Random(8)
    clean = lambda n: [f"plain{rnd.randrange(600)}" for _ in range(n)]
    rows = []
    for i in range(240):
        body = clean(1600 if i % 3 == 0 else 60)
        if i % 4 == 0:  # toxic words come after character 10,000 in long texts
            body[-3:-3] = ["vileman", "rotten"]
        rows.append((i, " ".join(body), int(i % 4 == 0)))
    assert all(len(t) > 10_000 and t.find("vileman") > 10_000 for i, t, toxic in rows if toxic and i % 3 == 0)
    docs = documents([r[:2] for r in rows])
    labels = spark.createDataFrame([(i, 0, toxic) for i, _, toxic in rows], "doc_id long, quality int, toxic int")
    texts, _, _ = toxicity.training_sample(docs, labels, "doc_id", "text", "toxic", 1200)
    assert sorted(texts) == sorted(t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2)
    model = toxicity.train(docs, labels)
    scored = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    assert all((scored[i] >= toxicity.THRESHOLD) == bool(toxic) for i, _, toxic in rows)
