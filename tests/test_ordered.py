"""Bucketed running sums, quantiles, ranks and row numbers against pandas and numpy."""

import numpy as np
import pandas as pd
import pytest

from holdfast.functions import ordered
from holdfast.session import materialise


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    n = 400
    key = np.where(rng.random(n) < 0.6, "hot", rng.choice(list("abc"), n))
    return pd.DataFrame(
        {"k": key, "t": rng.integers(0, 60, n).astype(float), "i": np.arange(n), "v": rng.integers(-5, 9, n)}
    )


def test_running_sums_keep_every_row(spark, rows):
    got = ordered.running_sums(spark.createDataFrame(rows), ["k"], ["t", "i"], ["v"]).toPandas()
    want = rows.sort_values(["k", "t", "i"])
    want["cum_v"] = want.groupby("k")["v"].cumsum()
    got = got.sort_values(["k", "t", "i"])
    assert got["cum_v"].tolist() == want["cum_v"].tolist()


def test_previous_value_crosses_buckets(spark, rows):
    got = ordered.previous_value(spark.createDataFrame(rows), ["k"], ["t", "i"], "v", "before").toPandas()
    want = rows.sort_values(["k", "t", "i"])
    want["before"] = want.groupby("k")["v"].shift()
    got = got.sort_values(["k", "t", "i"])
    assert got["before"].fillna(-99).tolist() == want["before"].fillna(-99).tolist()


def test_running_totals_with_null_keys_and_no_keys(spark):
    df = spark.createDataFrame([(None, 1.0, 2), (None, 2.0, 3), ("a", 1.0, 5), ("a", 1.0, 1)], "k string, x double, n bigint")
    got = {(r["k"], r["x"]): r["cum_n"] for r in ordered.running_totals(df, ["k"], "x", ["n"]).collect()}
    assert got == {(None, 1.0): 2, (None, 2.0): 5, ("a", 1.0): 6}
    free = {r["x"]: r["cum_n"] for r in ordered.running_totals(df, [], "x", ["n"]).collect()}
    assert free == {1.0: 8, 2.0: 11}


def test_quantiles_like_numpy(spark, rows):
    got = ordered.exact_quantiles(spark.createDataFrame(rows), ["k"], "t", {"p50": 0.5, "p99": 0.99}).collect()
    for r in got:
        values = rows.loc[rows["k"] == r["k"], "t"]
        assert r["p50"] == pytest.approx(np.quantile(values, 0.5))
        assert r["p99"] == pytest.approx(np.quantile(values, 0.99))


def test_quantile_of_one_row_and_of_nothing(spark):
    one = spark.createDataFrame([(3.0,), (None,)], "v double")
    assert ordered.exact_quantiles(one, [], "v", {"m": 0.5}).first()["m"] == 3.0
    assert ordered.exact_quantiles(one.where("v is null"), [], "v", {"m": 0.5}).first()["m"] is None


def test_average_ranks_like_pandas(spark, rows):
    got = {r["t"]: r["rank"] for r in ordered.average_ranks(spark.createDataFrame(rows), [], "t").collect()}
    ranks = rows["t"].rank()
    assert all(got[t] == r for t, r in zip(rows["t"], ranks))


def test_dense_index_is_a_numbering(spark):
    fixed = materialise(spark.range(0, 1000, 1, 7).where("id % 3 <> 0"))
    got = ordered.dense_index(fixed).toPandas()
    assert sorted(got["row_index"]) == list(range(len(got)))
    again = ordered.dense_index(fixed).toPandas()
    assert dict(zip(got["id"], got["row_index"])) == dict(zip(again["id"], again["row_index"]))


def test_running_last_cuts_a_key_into_blocks(spark):
    rows = [(None if i % 7 == 0 else 1, (i * 37) % 2000, i, i if i % 9 == 0 else None) for i in range(4000)]
    df = spark.createDataFrame(rows, "k bigint, t bigint, seq bigint, v bigint")
    got = ordered.running_last(df, ["k"], ["t", "seq"], "v", "last").collect()
    want, held = {}, {}
    for k, t, seq, v in sorted(rows, key=lambda r: (r[1], r[2])):
        held[k] = v if v is not None else held.get(k)
        want[seq] = held[k]
    assert {r["seq"]: r["last"] for r in got} == want and len(got) == len(rows)
    placed, by = ordered._with_buckets(df, ["k"], "t", ["v"])
    assert max(r["count"] for r in placed.groupBy(*by, "_bucket").count().collect()) < len(rows) / 2
