import numpy as np

from holdfast.llm import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, point long, size int, code string"


def case():
    rng = np.random.default_rng(8)
    rows = []
    for c in range(60):
        centre = rng.normal(size=32)
        for _ in range(int(rng.integers(1, 7))):
            rows.append((len(rows), (centre + rng.normal(size=32) * rng.choice([0.0, 0.1, 0.3])).astype(np.float32).tolist(), c % 3))
    rows += [(len(rows) + k, rows[5][1], rows[5][2]) for k in range(40)]
    rows += [(900, None, 1), (901, [0.0] * 32, 1), (902, [], 1), (903, [None] * 32, 1), (904, [float("nan")] * 32, 1), (905, [float("inf")] + [1.0] * 31, 1)]
    rows += [(906, rows[5][1], None), (907, rows[5][1][:16], rows[5][2]), (908, [1e-30 * x for x in rows[5][1]], rows[5][2]), (909, [1e30 * x for x in rows[5][1]], rows[5][2])]
    rows += [(None, rows[5][1], rows[5][2]), rows[7]]
    return rows


def brute(rows):
    rows = list({r[0]: r for r in rows if r[0] is not None}.values())
    n = len(rows)
    links = np.zeros((n, n), bool)
    units = []
    for _, v, label in rows:
        good = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        a = np.array(np.float32(v), float) if good else None
        if good:
            a /= np.abs(a).max()
            a /= np.linalg.norm(a)
        units.append(a)
    for i in range(n):
        for j in range(n):
            if i != j and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]):
                links[i, j] = units[i] @ units[j] >= 0.93
    reach = links | np.eye(n, dtype=bool)
    for _ in range(8):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    ids = np.array([r[0] for r in rows])
    return {int(ids[i]): (int(links[i].sum()), int(ids[reach[i]].min())) for i in range(n)}


def test_links_equal_brute_force(spark):
    rows = case()
    got = near_vectors.near_vectors(spark.createDataFrame([(*r, 1, 1, "x") for r in rows], SCHEMA)).collect()
    want = brute(rows)
    assert len(got) == len(want)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}
    total, hit = sum(w[0] for w in want.values()), sum(f[0] for f in found.values())
    assert 0.99 * total <= hit <= total
    assert sum(found[k] != want[k] for k in want) <= 0.01 * len(want)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert all(found[k] == (0, k) for k in (900, 901, 902, 903, 904, 905, 906, 907))


def test_links_are_never_below_the_threshold(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=8).tolist(), 1) for k in range(300)]
    points = spark.createDataFrame(rows, "point long, vector array<double>, label int")
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    pairs = {(r["a"], r["b"]) for r in near_vectors.linked_points(points).collect()}
    want = {(a, b) for a in range(300) for b in range(a + 1, 300) if x[a] @ x[b] >= 0.93}
    assert pairs <= want and len(pairs) >= 0.9 * len(want)


def test_codes_are_balanced():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 16)) * np.linspace(3, 0.2, 16) + 1
    x /= np.linalg.norm(x, axis=1)[:, None]
    centre, turn = near_vectors.learn_rotation(x)
    share = ((x - centre) @ turn > 0).mean(axis=0)
    assert (np.abs(share - 0.5) < 0.15).all()


def test_empty_table(spark):
    assert near_vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0], 3, 1, 1, "x")], SCHEMA)
    assert [tuple(r) for r in near_vectors.near_vectors(one).collect()] == [(1, 0, 1, True)]


def test_sketches_never_understate_a_cosine():
    rng = np.random.default_rng(4)
    for size in (3, 16, 40):
        x = rng.normal(size=(400, size)) * np.linspace(3, 0.1, size) + 0.3
        x /= np.linalg.norm(x, axis=1)[:, None]
        basis = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, : near_vectors.COORDINATES]
        told = near_vectors._sketches(x, basis).astype(float) / near_vectors.STEPS
        assert (told @ told.T >= x @ x.T - near_vectors.SLACK).all()


def test_exploded_codes_are_not_gathered_in_the_driver(spark, monkeypatch):
    plans, kept = [], near_vectors.stage

    def stage(df, label):
        if label == "vector-pairs":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, label)

    monkeypatch.setattr(near_vectors, "stage", stage)
    rng = np.random.default_rng(3)
    points = spark.createDataFrame([(k, rng.normal(size=8).tolist(), 1) for k in range(50)], "point long, vector array<double>, label int")
    near_vectors.linked_points(points).count()
    assert len(plans) == 1 and "BroadcastExchange" not in plans[0]
