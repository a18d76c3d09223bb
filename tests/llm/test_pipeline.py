import random

import sentencepiece
import test_near_text
import test_secrets

import corpus_pipeline
from holdfast.llm import decontaminate, toxicity
from holdfast.llm.common import stage


def world(spark, folder):
    """Tables with toxic texts, near copies, benchmark passages and secrets."""
    rnd = random.Random(7)
    words = [f"plain{k}" for k in range(900)]
    rows, labels = [], []
    for i in range(240):
        body = [rnd.choice(words) for _ in range(rnd.randrange(40, 90))]
        toxic = i % 4 == 0
        if toxic:
            body.insert(5, rnd.choice(["vileman", "rotten", "scurvy"]))
            body.insert(9, rnd.choice(["vileman", "rotten", "scurvy"]))
        rows.append([i, " ".join(body)])
        labels.append((i, 1, int(toxic)))
    items = [(k, " ".join(rnd.choice(words) for _ in range(25))) for k in range(4)]
    rows[1][1] += " " + items[0][1]
    rows[2][1] += " token=abcdefghijklmnop"
    rows += [[300, rows[3][1]], [301, rows[3][1] + " tail"], [302, None], [303, ""], [None, rows[3][1]]]
    docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_run_equals_a_plain_restatement(spark, tmp_path, pieces_model):
    folder = str(tmp_path / "data")
    world(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    frames, frame = {}, docs
    for name, work in corpus_pipeline.STAGES:
        frame = frames[name] = stage(work(spark, frame, folder), name)
    rows = {name: {r["doc_id"]: r["text"] for r in f.collect()} for name, f in frames.items()}
    assert all(frames[n].columns == docs.columns for n, _ in corpus_pipeline.STAGES[:-1])

    model = toxicity.train(docs.select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    civil = {r["doc_id"]: r["text"] for r in docs.collect() if scores[r["doc_id"]] < toxicity.THRESHOLD}
    assert rows["toxicity"] == civil
    assert {i for i in scores if i is not None and i < 240} - set(civil) == set(range(0, 240, 4))

    classes = test_near_text.classes(list(civil.items()))
    distinct = {i: t for i, t in civil.items() if i is None or classes[i] == i}
    assert rows["near_copies"] == distinct and not {300, 301} & set(distinct) and {302, 303, None} <= set(distinct)

    unseen = {i: t for i, t in distinct.items() if i != 1}
    assert rows["benchmark_overlap"] == unseen
    masked = dict(unseen)
    for i, t in unseen.items():
        for _, a, b in test_secrets.brute(t)[::-1]:
            masked[i] = t[:a] + "[SECRET]" + t[b:]
    assert rows["secrets"] == masked and masked[2].endswith(" [SECRET]")
    assert all(r["n_chars"] == len(r["text"]) for r in frames["secrets"].collect() if r["text"] is not None)

    library = sentencepiece.SentencePieceProcessor(model_file=pieces_model)
    last = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"]: (r["text"], list(r["piece_ids"])) for r in last} == {i: (t, library.encode(t or "")) for i, t in masked.items()}


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path / "data")
    for name, schema in {"documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
    assert decontaminate.MASKS
