import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import EXTRA
from holdfast.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(value):
    if value is None:
        return "-"
    text = str(value)
    return f"{len(text.encode())}:{text}"


def climb(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def siblings(levels, place):
    out = []
    for level in levels[:-1]:
        first = place // 3 * 3
        out.append((level[first:place], level[place + 1 : first + 3]))
        place //= 3
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, digest of siblings, folded root) of rows (doc_id, source, lang, n_chars, text, held)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0], h(*map(coded, r[:5])), h(*map(coded, (*r[:4], r[5])))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[1] for x in sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for s in order}
    top = climb([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for at, (name, leaf, held) in enumerate(sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            path = siblings(trees[s], at) + siblings(top, place)
            node = held
            for left, right in path:
                node = h(*left, node, *right)
            out.append((name, leaf, trees[s][-1][0], top[-1][0], h(*(x for pair in path for side in pair for x in side)), node))
    return out


def frame(spark, rows):
    clash = [c for c in EXTRA if c not in ("text",)] + ["grouped", "name", "digest", "held", "tree", "n", "place", "block", "_seq", "_at"]
    schema = "doc_id long, source string, lang string, n_chars long, text string, other string, " + ", ".join(f"`{c}` string" for c in dict.fromkeys(clash))
    return spark.createDataFrame([(*r, *["x"] * len(dict.fromkeys(clash))) for r in rows], schema)


def audited(spark, rows):
    made = merkle.manifest(frame(spark, rows), held={"text": F.col("other")})
    got = merkle.audit(made).collect()
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in got)
    return made, sorted([(r["name"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in got], key=str)


def rows_of(n, source, rnd, start=0):
    return [(start + i, source, rnd.choice(["en", None]), i, f"text {i}", f"text {i}" if i % 3 else f"other {i}") for i in range(n)]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 700}, {"a": 82, "b": 1, None: 3, "": 2, "é": 4, "z" * 300: 5, "A": 244}])
def test_equals_plain_trees(spark, sizes):
    rnd, rows = random.Random(3), []
    for source, n in sizes.items():
        rows += rows_of(n, source, rnd, len(rows))
    rnd.shuffle(rows)
    assert audited(spark, rows)[1] == sorted(brute(rows), key=str)


def test_many_groups(spark):
    rows = [(i, f"s{i:04d}", "en", 1, "t", "t") for i in range(300)]
    assert audited(spark, rows)[1] == sorted(brute(rows), key=str)


def test_odd_rows(spark, odd):
    rows = [(i, None if i == 1 else "s", None, None, t, t and t.replace("\n", "")) for i, t in odd]
    rows += [(4, "s", "en", 4, "one", "one")] * 100 + [(None, None, None, None, None, None)] * 3
    made, got = audited(spark, rows)
    assert got == sorted(brute(rows), key=str)
    assert audited(spark, [])[1] == []


def test_asks_for_the_fewest_nodes():
    rnd = np.random.default_rng(0)
    for n in (1, 2, 3, 4, 10, 81, 100, 500):
        for asked in (1, 2, 5, n):
            places = np.unique(rnd.integers(0, n, asked))
            got = {(level, int(p)) for level, rows, at in merkle.missing(np.zeros(len(places), np.int64), places, np.array([n])) for p in at}
            want, known, level, width = set(), set(places.tolist()), 0, n
            while width > 1:
                parents = {p // 3 for p in known}
                want |= {(level, c) for q in parents for c in range(3 * q, min(3 * q + 3, width)) if c not in known}
                known, width, level = parents, -(-width // 3), level + 1
            assert got == want


def test_proofs_of_some_leaves_fetch_each_node_once(spark):
    rows = rows_of(500, "a", random.Random(1)) + rows_of(90, "b", random.Random(2), 500)
    made, _ = audited(spark, rows)
    names = [0, 3, 4, 250, 499, 500, 589]
    blocks = merkle.subset(made, spark.createDataFrame([(i,) for i in names], "doc_id long"))
    fetched = merkle._fetched(made, blocks).collect()
    for row in fetched:
        places = [(f["level"], f["place"]) for f in row["fetched"] or []]
        assert len(places) == len(set(places)) > 0
    root = {r["tree"]: r["digest"].hex() for r in made.nodes.where(f"tree >= 0 AND place = 0 AND level = {merkle.height(500)}").collect()}[0]
    got = {r["name"]: r for r in merkle.prove(made, blocks).collect()}
    assert sorted(got) == names and got[250]["root"] == root
    for r in got.values():
        assert merkle.fold(r["leaf"], [(s["left"], s["right"]) for s in r["proof"]]) == r["root"]
        assert merkle.fold(merkle.digest("other"), [(s["left"], s["right"]) for s in r["proof"]]) != r["root"]


def test_a_changed_node_breaks_the_proofs_below(spark):
    rows = rows_of(200, "a", random.Random(1))
    made, _ = audited(spark, rows)
    bad = F.when((F.col("level") == 4) & (F.col("place") == 0), F.unhex(F.lit("00" * 32))).otherwise(F.col("digest"))
    forged = merkle.Manifest(made.blocks, made.nodes.withColumn("digest", bad), made.trees, made.top_blocks)
    got = {r["name"]: r["verified"] for r in merkle.audit(forged).collect()}
    # the first block derives that node itself; the others fetch it, and no longer reach the root
    assert not any(got[i] for i in range(81, 200))
    assert any(got[i] for i in range(81))
