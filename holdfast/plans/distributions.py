"""Queries: drift between two frames, and feature reduction statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import drift, reduce
from holdfast.plans.registry import query, table

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "shifted"]


def _measured(lines):
    """Measures of line items, one of them shifted from 1998 on."""
    early = F.col("l_shipdate") < "1998-01-01"
    shifted = F.when(early, F.col("l_quantity")).otherwise(F.col("l_quantity") * 1.4 + 11)
    return lines.withColumn("shifted", shifted).select(
        *FEATURES,
        F.lit(1.5).alias("steady"),
        (F.col("l_returnflag") == "R").cast("int").alias("target"),
        (F.col("l_linestatus") == "F").cast("int").alias("predicted_class"),
        "l_shipdate",
    )


def serving_half(lines):
    return _measured(lines).where(F.col("l_shipdate") >= "1998-01-01").drop("l_shipdate", "target")


def halves(spark, sf):
    """Line items shipped before 1998 (training) and after (serving)."""
    lines = table(spark, sf, "lineitem")
    train = _measured(lines).where(F.col("l_shipdate") < "1998-01-01").drop("l_shipdate", "predicted_class")
    return train, serving_half(lines)


_COLUMNS = [*FEATURES, "steady"]
LONG_SQL = """
    base as (
        select l_quantity, l_extendedprice, l_discount, l_tax,
               case when l_shipdate < timestamp '1998-01-01' then l_quantity else l_quantity * 1.4 + 11 end as shifted,
               1.5::double as steady, l_shipdate < timestamp '1998-01-01' as train,
               (l_returnflag = 'R')::int as target, (l_linestatus = 'F')::int as predicted
        from lineitem
    ),
    long as (
""" + " union all ".join(f"select '{c}' as feature, {c} as v, train from base" for c in _COLUMNS) + ")"
HIST_SQL = LONG_SQL + """,
    bounds as (
        select feature, case when min(v) = max(v) then min(v) - 0.5 else min(v) end as lo,
               case when min(v) = max(v) then max(v) + 0.5 else max(v) end as hi,
               count(*) filter (train) as n, count(*) filter (not train) as m,
               avg(v) filter (train) as mean_train, avg(v) filter (not train) as mean_serve,
               stddev_samp(v) filter (train) as std_train, stddev_samp(v) filter (not train) as std_serve
        from long group by 1
    ),
    hist as (
        select l.feature, least(floor((v - lo) / ((hi - lo) / 50)), 49)::int as bin,
               count(*) filter (train) as train, count(*) filter (not train) as serve
        from long l join bounds b on l.feature = b.feature group by 1, 2
    ),
    grid as (
        select b.feature, k.bin, (hi - lo) / 50 as w, n, m, coalesce(h.train, 0) as train, coalesce(h.serve, 0) as serve
        from bounds b cross join (select unnest(range(50))::int as bin) k
        left join hist h on h.feature = b.feature and h.bin = k.bin
    ),
    dens as (
        select feature, train / (n * w) + 1e-10 as p, serve / (m * w) + 1e-10 as q from grid
    ),
    norm as (
        select feature, p / sum(p) over (partition by feature) as p, q / sum(q) over (partition by feature) as q from dens
    ),
    js as (
        select feature, 0.5 * sum(p * ln(p / ((p + q) / 2))) + 0.5 * sum(q * ln(q / ((p + q) / 2))) as js
        from norm group by 1
    )
"""
DRIFT_SQL = HIST_SQL + """,
    report as (
        select b.feature, round(js, 6) as js_divergence, js > 0.1 as drifted,
               round(mean_train, 4) as train_mean, round(mean_serve, 4) as serve_mean,
               round(std_train, 4) as train_std, round(std_serve, 4) as serve_std
        from js join bounds b on js.feature = b.feature
    ),
    classes as (
        select coalesce(a.k, b.k) as k, coalesce(a.p, 0) as p, coalesce(b.q, 0) as q
        from (select target as k, count(*) / (select count(*) from base where train) as p from base where train group by 1) a
        full join (select predicted as k, count(*) / (select count(*) from base where not train) as q
                   from base where not train group by 1) b on a.k = b.k
    ),
    class_norm as (
        select (p + 1e-10) / sum(p + 1e-10) over () as p, (q + 1e-10) / sum(q + 1e-10) over () as q from classes
    ),
    class_js as (
        select 0.5 * sum(p * ln(p / ((p + q) / 2))) + 0.5 * sum(q * ln(q / ((p + q) / 2))) as js from class_norm
    )
"""


@query("hist_two_sample", "with " + HIST_SQL + " select feature, bin, train, serve from hist")
def hist_two_sample(spark, sf):
    return drift.histogram(*halves(spark, sf), _COLUMNS)


@query("js_continuous", "with " + DRIFT_SQL + " select feature, js_divergence from report")
def js_continuous(spark, sf):
    return drift.feature_drift(*halves(spark, sf), ignore=["target"]).select("feature", "js_divergence")


@query(
    "js_discrete",
    """
    with a as (select event_type as k, count(*) / (select count(*) from events where ts < timestamp '2024-01-10') as p
               from events where ts < timestamp '2024-01-10' group by 1),
    b as (select case when event_type = 'signup' then 'view' else event_type end as k,
                 count(*) / (select count(*) from events where ts >= timestamp '2024-01-10') as q
          from events where ts >= timestamp '2024-01-10' group by 1),
    u as (select coalesce(p, 0) + 1e-10 as p, coalesce(q, 0) + 1e-10 as q from a full join b on a.k = b.k),
    n as (select p / sum(p) over () as p, q / sum(q) over () as q from u)
    select round(0.5 * sum(p * ln(p / ((p + q) / 2))) + 0.5 * sum(q * ln(q / ((p + q) / 2))), 6) as js from n
    """,
)
def js_discrete(spark, sf):
    from holdfast.operators.quality import value_shares

    events = table(spark, sf, "events")
    early = value_shares(events.where("ts < '2024-01-10'"), "event_type")
    late = events.where("ts >= '2024-01-10'").withColumn(
        "event_type", F.when(F.col("event_type") == "signup", "view").otherwise(F.col("event_type"))
    )
    return drift.discrete_divergence(early, value_shares(late, "event_type")).select(F.round("js", 6).alias("js"))


@query("drift_report", "with " + DRIFT_SQL + " select * from report")
def drift_report(spark, sf):
    return drift.feature_drift(*halves(spark, sf), ignore=["target"])


@query(
    "prediction_drift",
    "with " + DRIFT_SQL + " select round(js, 6) as js_divergence, js > 0.1 as drifted from class_js",
)
def prediction_drift(spark, sf):
    train, serve = halves(spark, sf)
    return drift.prediction_drift(train, serve, "target")


@query(
    "alert_decision",
    "with " + DRIFT_SQL + """
    select count(*) as features_analyzed, count(*) filter (drifted) as drifted_features,
           (select js > 0.1 from class_js) as prediction_drifted,
           count(*) filter (drifted) > 0 or (select js > 0.1 from class_js) as alert_triggered
    from report
    """,
)
def alert_decision(spark, sf):
    train, serve = halves(spark, sf)
    return drift.alert(
        drift.feature_drift(train, serve, ignore=["target"]), drift.prediction_drift(train, serve, "target")
    )


@query(
    "ks_statistic",
    "with " + LONG_SQL + """,
    counts as (
        select feature, v, count(*) filter (train) as a, count(*) filter (not train) as b from long group by 1, 2
    ),
    cdf as (
        select feature, sum(a) over w / sum(a) over (partition by feature) as f,
               sum(b) over w / sum(b) over (partition by feature) as g,
               sum(a) over (partition by feature) as n, sum(b) over (partition by feature) as m
        from counts window w as (partition by feature order by v)
    ),
    stat as (
        select feature, max(abs(f - g)) as ks, max(n)::double as n, max(m)::double as m from cdf group by 1
    ),
    z as (select *, sqrt(n * m / (n + m)) * ks as z from stat)
    select feature, round(ks, 6) as ks_statistic,
           round(case when z < 0.2 then 1.0 else greatest(0.0, least(1.0, 2 *
               list_sum([(-1.0) ** (k - 1) * exp(-2.0 * k * k * z * z) for k in range(1, 101)]))) end, 6) as ks_pvalue,
           ks > 0.1 as skewed
    from z
    """,
)
def ks_statistic(spark, sf):
    return drift.distribution_skew(*halves(spark, sf), ignore=["target"])


NUMBERS = ["l_quantity", "price", "discount", "mix", "steady"]


def numbers(spark, sf):
    """Measures with nulls, a mixture that correlates with two of them, and a constant."""
    return table(spark, sf, "lineitem").selectExpr(
        "l_quantity",
        "l_extendedprice / 1000 as price",
        "nullif(l_discount, 0.05) as discount",
        "l_quantity * 2 + l_linenumber + l_tax * 100 as mix",
        "cast(1.5 as double) as steady",
        "cast(l_returnflag = 'R' as int) as target",
        "l_linenumber",
    )


NUMBERS_SQL = """
    t as (select l_quantity, l_extendedprice / 1000 as price, nullif(l_discount, 0.05) as discount,
                 l_quantity * 2 + l_linenumber + l_tax * 100 as mix, 1.5::double as steady,
                 (l_returnflag = 'R')::int as target, l_linenumber
          from lineitem)
"""


def _rounded(df):
    return df.withColumn("correlation", F.round("correlation", 6))


def _corr(a, b):
    return f"case when isnan(corr({a}, {b})) then null else round(corr({a}, {b}), 6) end"


@query(
    "target_correlation",
    f"with {NUMBERS_SQL} "
    + " union all ".join(f"select '{c}' as feature, {_corr(c, 'target')} as correlation from t" for c in NUMBERS),
)
def target_correlation(spark, sf):
    return _rounded(reduce.target_correlations(numbers(spark, sf), NUMBERS, "target"))


def _rank_corr(a, b):
    ranked = (
        f"select rank() over (order by {a}) + (count(*) over (partition by {a}) - 1) / 2.0 as x, "
        f"rank() over (order by {b}) + (count(*) over (partition by {b}) - 1) / 2.0 as y "
        f"from t where {a} is not null and {b} is not null"
    )
    return f"select '{a}' as feature, {_corr('x', 'y')} as correlation from ({ranked})"


@query(
    "spearman_correlation",
    f"with {NUMBERS_SQL} " + " union all ".join(_rank_corr(c, "l_linenumber") for c in NUMBERS),
)
def spearman_correlation(spark, sf):
    return _rounded(reduce.target_correlations(numbers(spark, sf), NUMBERS, "l_linenumber", "spearman"))


def _tau(c):
    return f"""
        select '{c}' as feature, round((2 * u - p * n) / nullif(sqrt((total * (total - 1) / 2 - ties) * p * n), 0), 6) as correlation
        from (
            select sum(hi * (below + lo / 2.0)) as u, sum(hi)::double as p, sum(lo)::double as n,
                   sum(hi + lo)::double as total, sum((hi + lo) * (hi + lo - 1) / 2)::double as ties
            from (
                select hi, lo, coalesce(sum(lo) over (order by x rows between unbounded preceding and 1 preceding), 0) as below
                from (select {c} as x, count(*) filter (target = 1) as hi, count(*) filter (target = 0) as lo
                      from t where {c} is not null group by 1)
            )
        )"""


@query(
    "kendall_correlation",
    f"with {NUMBERS_SQL} " + " union all ".join(_tau(c) for c in NUMBERS),
)
def kendall_correlation(spark, sf):
    return _rounded(reduce.target_correlations(numbers(spark, sf), NUMBERS, "target", "kendall"))


def _tau_lines(c):
    """Inverted pairs from running counts of each line number below a value."""
    numbers_ = range(1, 8)
    inverted = " + ".join(f"c{y} * (" + " + ".join(f"b{z}" for z in numbers_ if z > y) + ")" for y in numbers_ if y < 7)
    twos = lambda n: f"sum({n} * ({n} - 1) / 2)"
    return f"""
        select '{c}' as feature,
               round((every - tx - ty + txy - 2 * inverted) / nullif(sqrt((every - tx) * (every - ty)), 0), 6) as correlation
        from (
            select sum({inverted})::double as inverted, {twos("n")}::double as tx, sum(n)::double * (sum(n) - 1) / 2 as every,
                   ({" + ".join(f"sum(c{y}) * (sum(c{y}) - 1) / 2" for y in numbers_)})::double as ty,
                   ({" + ".join(twos(f"c{y}") for y in numbers_)})::double as txy
            from (
                select *, {", ".join(f"coalesce(sum(c{y}) over w, 0) as b{y}" for y in numbers_)}
                from (select {c} as x, count(*) as n,
                             {", ".join(f"count(*) filter (l_linenumber = {y}) as c{y}" for y in numbers_)}
                      from t where {c} is not null group by 1)
                window w as (order by x rows between unbounded preceding and 1 preceding)
            )
        )"""


@query(
    "kendall_many_values",
    f"with {NUMBERS_SQL} " + " union all ".join(_tau_lines(c) for c in NUMBERS),
)
def kendall_many_values(spark, sf):
    """Tau-b of each measure against the line number, which has seven values."""
    return _rounded(reduce.target_correlations(numbers(spark, sf), NUMBERS, "l_linenumber", "kendall"))


@query(
    "correlation_matrix",
    f"with {NUMBERS_SQL} "
    + " union all ".join(
        f"select '{a}' as feature_a, '{b}' as feature_b, {_corr(a, b)} as correlation from t"
        for i, a in enumerate(NUMBERS)
        for b in NUMBERS[i + 1 :]
    ),
)
def correlation_matrix(spark, sf):
    return _rounded(reduce.correlation_matrix(numbers(spark, sf), NUMBERS))


def _vif_sql():
    """Two predictors without intercept: R2 from the 2 x 2 normal equations."""
    def one(target, a, b):
        return f"""
            select '{target}' as feature, round(yy / (yy - (ay * (ay * bb - bey * ab) + bey * (bey * aa - ay * ab))
                / (aa * bb - ab * ab)), 4) as vif
            from (select sum({target} * {target}) as yy, sum({a} * {a}) as aa, sum({b} * {b}) as bb,
                         sum({a} * {b}) as ab, sum({a} * {target}) as ay, sum({b} * {target}) as bey
                  from t where price is not null and mix is not null and discount is not null)"""

    names = ("price", "mix", "discount")
    return f"with {NUMBERS_SQL} " + " union all ".join(
        one(c, *[x for x in names if x != c]) for c in names
    )


@query("vif", _vif_sql())
def vif(spark, sf):
    out = reduce.variance_inflation(numbers(spark, sf), ["price", "mix", "discount"])
    return out.withColumn("vif", F.round("vif", 4))


@query(
    "pair_cull",
    f"""
    with {NUMBERS_SQL},
    s as (
        select abs(corr(l_quantity, price)) > 0.85 as ab, abs(corr(l_quantity, mix)) > 0.85 as ac,
               abs(corr(price, mix)) > 0.85 as bc, count(distinct l_quantity) as a, count(distinct price) as b,
               count(distinct mix) as c
        from t
    ),
    first as (
        -- the first feature against the second, then the third, each unless dropped before
        select *, ab and a <= b as a1, ab and a > b as b1 from s
    ),
    second as (
        select *, a1 or (ac and a <= c) as a2, ac and a > c as c2 from first
    ),
    third as (
        select a2, b1 or (not b1 and not c2 and bc and b <= c) as b3, c2 or (not b1 and not c2 and bc and b > c) as c3
        from second
    )
    select 'l_quantity' as feature, {_corr("l_quantity", "target")} as correlation from t where not (select a2 from third) having count(*) > 0
    union all
    select 'price', {_corr("price", "target")} from t where not (select b3 from third) having count(*) > 0
    union all
    select 'mix', {_corr("mix", "target")} from t where not (select c3 from third) having count(*) > 0
    """,
)
def pair_cull(spark, sf):
    """Features left after the redundant-pair cull, with their target correlation."""
    frame = numbers(spark, sf)
    features = ["l_quantity", "price", "mix"]
    dropped = reduce.redundant_features(frame, features, 0.85)
    return _rounded(reduce.target_correlations(frame, [c for c in features if c not in dropped], "target"))


@query("reduce_dimensions")
def reduce_dimensions(spark, sf):
    frame = numbers(spark, sf).withColumn("collinear", F.col("l_quantity") + F.col("price"))
    reduced, report = reduce.reduce_dimensions(frame, "target", "none", correlation_threshold=0.98)
    kept = reduced.agg(*[F.round(F.avg(c), 6).alias(c) for c in reduced.columns]).select(F.to_json(F.struct("*")).alias("means"))
    return report.withColumn("means", kept.scalar())
