import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import fingerprints as fp

WORDS = "the of and harbour lantern winter copper meadow river engine velvet quiet été straße 漢字 😀".split()


def text_of(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def plain(text):
    """The fingerprint, bucket by bucket."""
    raw = text.encode()
    counts = [0] * fp.BUCKETS
    for i in range(len(raw) - 2):
        number = raw[i] + raw[i + 1] * 256 + raw[i + 2] * 65536
        counts[(number * 0x9E3779B1 % 2**32) // (2**32 // fp.BUCKETS)] += 1
    ranked = sorted(counts)
    borders = [ranked[fp.BUCKETS * q // 4 - 1] for q in (1, 2, 3)]
    codes = [sum(c > b for b in borders) for c in counts]
    out = [min(255, round(8 * np.log2(1.0 + len(raw))))]
    for i in range(0, fp.BUCKETS, 4):
        a, b, c, d = codes[i : i + 4]
        out.append(a * 64 + b * 16 + c * 4 + d)
    return bytes(out).hex()


def plain_likeness(left, right):
    a, b = bytes.fromhex(left), bytes.fromhex(right)
    pairs = [(x >> s & 3, y >> s & 3) for x, y in zip(a[1:], b[1:]) for s in (6, 4, 2, 0)]
    most = min(sum(map(max, pairs)), fp.UNRELATED * fp.BUCKETS)
    apart = sum(abs(x - y) for x, y in pairs) / max(most, 1)
    return 1 - min(1, apart + min(abs(a[0] - b[0]), fp.LENGTH_STEPS) / fp.LENGTH_STEPS * fp.LENGTH_SHARE)


def brute(spark, rows):
    hashes = spark.createDataFrame([(t or "",) for _, t in rows], "t string").select("t", F.xxhash64("t")).distinct().collect()
    hashes = {r[0]: r[1] for r in hashes}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    out = []
    for (i, own), (_, following) in zip(order, order[1:] + order[:1]):
        cut = len(own) // 3
        edited = own[: len(own) - cut] + following[:cut]
        mark, changed, other = plain(own), plain(edited), plain(following)
        out.append((i, len(own), hashlib.sha256(edited.encode()).hexdigest(), mark, changed, round(plain_likeness(mark, changed), 12), round(plain_likeness(mark, other), 12)))
    return sorted(out, key=str)


def told(df):
    rows = [tuple(r) for r in df.collect()]
    return sorted([(*r[:5], round(r[5], 12), round(r[6], 12)) for r in rows], key=str)


@pytest.mark.parametrize("size", [10**9, 3_000, 40])
def test_equals_plain_version(spark, documents, odd, monkeypatch, size):
    # small blocks: the last row of each needs the first of the next
    monkeypatch.setattr(fp, "BLOCK_BYTES", size)
    rnd = random.Random(4)
    rows = [(rnd.randrange(10**6), text_of(rnd, rnd.randrange(0, 60))) for _ in range(150)]
    rows += [(i, t if t is None or len(t) < 10_000 else t[:7_000]) for i, t in odd] + [(77, "the same row")] * 40 + [(77, "another text")] * 3
    rnd.shuffle(rows)
    assert told(fp.edited_documents(documents(rows))) == brute(spark, rows)


def test_one_row_and_none(documents):
    got = fp.edited_documents(documents([(5, "abcdef")])).collect()
    assert [(r["doc_id"], r["edited_sha256"], r["near_next"]) for r in got] == [(5, hashlib.sha256(b"abcdab").hexdigest(), 1.0)]
    assert fp.edited_documents(documents([])).count() == 0
    assert fp.fingerprint_documents(documents([])).count() == 0


def test_likeness_is_bounded_and_tells_edits_from_others(documents):
    rnd = random.Random(9)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(2, 9))) for _ in range(3000)]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(300)) for _ in range(40)]
    edited = [" ".join(t.split()[:270] + [rnd.choice(vocabulary) for _ in range(30)]) for t in texts]
    a, b = (fp.fingerprints([t.encode() for t in x]) for x in (texts, edited))
    near, far = fp.likeness(a, b), fp.likeness(a, np.roll(a, 1, axis=0))
    assert near.min() > far.max() and near.max() <= 1 and far.min() >= 0
    assert (fp.likeness(a, a) == 1).all()
    assert fp.likeness(*(fp.fingerprints([t]) for t in (b"", b"a text of some length")))[0] < 0.5


def test_documents_and_pairs_of_fingerprints(spark, documents, odd):
    got = fp.fingerprint_documents(documents(odd))
    assert sorted(((r["doc_id"], r["n_chars"]) for r in got.collect()), key=str) == sorted(((i, len(t or "")) for i, t in odd), key=str)
    marks = [plain("some words here"), plain("some words there")]
    rows = [(1, marks[0], marks[1]), (2, marks[0], marks[0]), (3, None, marks[0])]
    pairs = fp.compare(spark.createDataFrame(rows, "k long, a string, b string"), "a", "b").orderBy("k").collect()
    assert [r["likeness"] for r in pairs] == [pytest.approx(plain_likeness(*marks)), 1.0, None]
