"""Neighbour search against brute force, and properties of the resamplers."""

import numpy as np
import pytest

from holdfast.operators import resample
from holdfast.operators.neighbours import nearest_neighbours


def frame(spark, vecs, labels):
    rows = [(i, [float(x) for x in v], int(y)) for i, (v, y) in enumerate(zip(vecs, labels))]
    return spark.createDataFrame(rows, "id bigint, vec array<double>, label int")


def brute(vecs, k):
    v = np.asarray(vecs, dtype=float)
    distance = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    out = {}
    for i in range(len(v)):
        order = sorted((distance[i, j], j) for j in range(len(v)) if j != i)[:k]
        out[i] = order
    return out


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(7)
    v = np.concatenate([rng.normal(size=(220, 3)), np.tile([0.5, 0.5, 0.5], (120, 1)), rng.normal(5, 0.1, (60, 3))])
    return v.round(2), (np.arange(len(v)) % 4 == 0).astype(int)


@pytest.mark.parametrize("box_rows,query_rows", [(5000, 20000), (25, 10)])
def test_same_as_brute_force(spark, cloud, box_rows, query_rows):
    vecs, labels = cloud
    df = frame(spark, vecs, labels)
    got = {}
    for r in nearest_neighbours(df, df, 4, box_rows, query_rows).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["distance"], r["neighbour"], r["nlabel"]))
    want = brute(vecs, 4)
    assert set(got) == set(want)
    for i, found in got.items():
        found.sort()
        assert [n for _, _, n, _ in found] == [j for _, j in want[i]]
        assert np.allclose([d for _, d, _, _ in found], [d for d, _ in want[i]])
        assert all(labels[n] == y for _, _, n, y in found)


def test_fewer_points_than_k(spark):
    df = frame(spark, [[0, 0], [1, 0], [5, 5]], [0, 1, 1])
    got = nearest_neighbours(df, df, 10, 2, 1).collect()
    assert sorted((r["id"], r["rank"], r["neighbour"]) for r in got) == [
        (0, 1, 1), (0, 2, 2), (1, 1, 0), (1, 2, 2), (2, 1, 1), (2, 2, 0)
    ]


def test_no_points(spark):
    df = frame(spark, [], [])
    assert nearest_neighbours(df, df, 3).count() == 0


def test_smote_reaches_parity_between_neighbours(spark, cloud):
    vecs, labels = cloud
    df = frame(spark, vecs, labels)
    out = resample.smote(df)
    again = {(r["id"], tuple(r["vec"])) for r in resample.smote(df).collect()}
    rows = out.collect()
    assert {(r["id"], tuple(r["vec"])) for r in rows} == again
    assert sum(r["label"] == 1 for r in rows) == sum(r["label"] == 0 for r in rows)
    assert len({r["id"] for r in rows}) == len(rows)
    minority = np.asarray(vecs)[labels == 1]
    low, high = minority.min(0) - 1e-9, minority.max(0) + 1e-9
    for r in rows:
        if r["id"] < 0:
            assert (np.array(r["vec"]) >= low).all() and (np.array(r["vec"]) <= high).all()


def test_smote_needs_two_classes_and_enough_rows(spark):
    with pytest.raises(resample.ResampleError):
        resample.smote(frame(spark, [[0.0], [1.0]], [1, 1]))
    with pytest.raises(resample.ResampleError):
        resample.smote(frame(spark, [[float(i)] for i in range(12)], [1] * 3 + [0] * 9))
    with pytest.raises(ValueError):
        resample.strategy("borderline")


def test_adasyn_prefers_hard_rows(spark):
    rng = np.random.default_rng(3)
    majority = rng.normal(0, 1, (80, 2))
    easy, hard = rng.normal(50, 0.1, (12, 2)), rng.normal(0, 1, (12, 2))
    df = frame(spark, np.concatenate([majority, easy, hard]), [0] * 80 + [1] * 24)
    made = [r["vec"] for r in resample.adasyn(df).where("id < 0").collect()]
    assert 30 <= len(made) <= 80
    # easy rows have only minority neighbours, so nothing is drawn from them
    assert all(abs(v[0]) < 40 for v in made)


def test_tomek_links_and_edited_neighbours(spark):
    xs = [[0.0], [0.1], [5.0], [5.05], [5.5], [9.0], [9.2], [9.4], [9.5]]
    ys = [0, 1, 0, 0, 0, 1, 1, 1, 0]
    df = frame(spark, xs, ys)
    # 0-1 are mutual and opposite; 8's nearest is 7 and 7's is 8
    assert sorted(r["id"] for r in resample.tomek_links(df).collect()) == [0, 1, 7, 8]
    near = brute(xs, 3)
    want = [i for i in range(len(xs)) if all(ys[j] == ys[i] for _, j in near[i])]
    assert sorted(r["id"] for r in resample.edited(df).collect()) == want


def test_large_boxes_compare_a_small_share_of_their_points(spark):
    """A task's work grows with its queries, not with queries times points; far from zero and with ties, too."""
    from holdfast.operators import neighbours

    rng = np.random.default_rng(5)
    vecs = np.concatenate([rng.normal(size=(6000, 3)), rng.normal(size=(6000, 3)).round(1)]) + 1e6
    tree, compared = neighbours._Tree(vecs), 0
    for start, end, rows in tree.groups(vecs):
        limit = neighbours._kth_within(vecs[rows], tree.sorted[start:end], 4)
        _, leaf = neighbours._reached(vecs[rows], limit, tree.lo, tree.hi)
        compared += int(np.diff(tree.leaves, axis=1)[leaf].sum())
    assert compared < 0.1 * len(vecs) ** 2
    df = frame(spark, vecs, np.arange(len(vecs)) % 2)
    got = {}
    for r in nearest_neighbours(df.where("id % 60 = 0"), df, 4, 3000, 50, vectors=False).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbour"]))
    assert len(got) == len(vecs) // 60
    for i, found in got.items():
        distance = np.sqrt(((vecs - vecs[i]) ** 2).sum(axis=1))
        distance[i] = np.inf
        assert [j for _, j in sorted(found)] == np.lexsort((np.arange(len(vecs)), distance))[:4].tolist()


def test_points_at_no_finite_place_are_left_out(spark):
    df = frame(spark, [[0.0], [1.0], [float("nan")], [float("inf")], [3.0]], [0, 1, 0, 1, 0])
    got = nearest_neighbours(df, df, 5, 2, 1).collect()
    assert sorted((r["id"], r["rank"], r["neighbour"]) for r in got) == [
        (0, 1, 1), (0, 2, 4), (1, 1, 0), (1, 2, 4), (4, 1, 1), (4, 2, 0)
    ]
