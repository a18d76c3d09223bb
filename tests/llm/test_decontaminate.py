import random
import re

import pytest

from holdfast.llm import decontaminate


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(docs, items, share=0.7, long_run=13, span=9):
    out = set()
    for d, text in docs:
        for i, item in items:
            a, b = words(text), words(item)
            if d is None or i is None or not a or not b:
                continue
            need = len(b) if len(b) < span else -(-len(b) * 7 // 10)
            for start in range(-len(b) + 1, len(a)):
                equal = [0 <= start + k < len(a) and a[start + k] == b[k] for k in range(len(b))]
                now = top = 0
                for e in equal:
                    now = max(0, now + (1 if e else -3))
                    top = max(top, now)
                if sum(equal) >= need or top >= long_run:
                    out.add((d, i))
    return out


@pytest.fixture(scope="module")
def case(spark):
    rnd = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(14, 40)))) for i in range(12)]
    items += [(90, "short item here"), (91, "one"), (92, ""), (93, None), (None, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"), (94, items[0][1])]
    docs = []
    for d in range(80):
        body = [rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 120))]
        if d % 2:
            item = words(items[d % 12][1])
            for at in rnd.sample(range(len(item)), len(item) // 10 if d % 4 == 1 else 0):
                item[at] = "other"
            at = rnd.randrange(len(body) + 1)
            body[at:at] = [w.upper() if d % 3 else w for w in item]
        docs.append((d, (", " if d % 5 else " ").join(body)))
    docs += [(200, None), (201, ""), (None, items[3][1]), (202, "Short, ITEM: here!"), (203, "short item there"), (204, "x " * 3000 + items[2][1] + " y" * 3000), (205, items[4][1]), (205, items[4][1])]
    return docs, items


@pytest.mark.parametrize("bound", [200_000, 0])
def test_equal_to_brute_force(spark, documents, case, bound):
    docs, items = case
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.repeated_items(documents(docs), frame, broadcast_rows=bound)
    rows = got.collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == brute(docs, items)
    assert len(rows) == len({(r["doc_id"], r["item_id"]) for r in rows})
    by = {(r["doc_id"], r["item_id"]): r for r in rows}
    assert by[204, 2]["start"] == 3000 and by[204, 2]["matched"] == by[204, 2]["item_length"]


def test_substitutions_are_found(spark, documents):
    rnd = random.Random(2)
    items = [(i, " ".join(f"q{i}x{k}" for k in range(30))) for i in range(150)]
    docs = []
    for i, text in items:
        body = text.split()
        for at in rnd.sample(range(30), 5):
            body[at] = "zz"
        docs.append((i, " ".join(["pre"] * 20 + body + ["post"] * 20)))
    got = decontaminate.repeated_items(documents(docs), spark.createDataFrame(items, "item_id long, text string")).count()
    assert got >= 148


def test_drop_keeps_rows_without_id(spark, documents, case):
    docs, items = case
    frame = documents(docs)
    items = spark.createDataFrame(items, "item_id long, text string")
    left = decontaminate.drop_repeating(frame, items)
    assert left.columns == frame.columns
    bad = {d for d, _ in brute(docs, [(r["item_id"], r["text"]) for r in items.collect()])}
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted((d for d, _ in docs if d not in bad), key=str)


def test_empty_tables(spark, documents, case):
    docs, items = case
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.repeated_items(documents(docs), none).count() == 0
    assert decontaminate.repeated_items(documents([]), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_a_mask_fits_every_repeated_item():
    bits = [sum(1 << o for o in m) for m in decontaminate.MASKS]
    for n in range(9, 18):  # longer items are made of such pieces
        for equal in range(1 << n):
            if 10 * equal.bit_count() >= 7 * n:
                assert any(equal >> at & b == b for b in bits for at in range(n - b.bit_length() + 1)), (n, bin(equal))


def test_replacements_equal_brute_force(spark, documents):
    rnd = random.Random(21)
    items, docs = [], []
    for n in [*range(9, 22), 26, 33, 40]:
        lost = [[k for k in range(n) if k % every == phase] for every in (4, 5, 7) for phase in range(every)]
        lost += [rnd.sample(range(n), n * share // 100) for share in (10, 20, 25, 30, 30, 30, 40)]
        items.append((n, " ".join(f"q{n}x{k}" for k in range(n))))
        for gone in lost:
            body = [f"q{n}x{k}" if k not in gone else "other" for k in range(n)]
            docs.append((len(docs), " ".join(["pre"] * rnd.randrange(3) + body + ["post"] * rnd.randrange(3))))
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.repeated_items(documents(docs), frame).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute(docs, items)
