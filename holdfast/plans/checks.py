"""Queries: profiles, nulls, ranges, dates, balance, anomaly roll-up, leakage."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import quality
from holdfast.plans.registry import query, table

RANGES = {"l_quantity": (3.0, 48.0), "l_discount": (0.01, 0.09), "l_tax": (0.0, 0.07)}
AS_OF = "2000-01-01"


def checked_lines(spark, sf):
    """Line items with provoked nulls."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.expr("nullif(l_linenumber, 7)").alias("l_linenumber"),
        "l_quantity",
        "l_extendedprice",
        F.expr("nullif(l_discount, 0.05)").alias("l_discount"),
        "l_tax",
        F.expr("nullif(l_returnflag, 'A')").alias("l_returnflag"),
        (F.col("l_linestatus") == "F").alias("filled"),
        F.col("l_shipdate").alias("ship_date"),
    )


LINES_SQL = """
    select l_orderkey, l_partkey, l_suppkey, nullif(l_linenumber, 7) as l_linenumber, l_quantity,
           l_extendedprice, nullif(l_discount, 0.05) as l_discount, l_tax,
           nullif(l_returnflag, 'A') as l_returnflag, l_linestatus = 'F' as filled, l_shipdate as ship_date
    from lineitem
"""


def _profile_sql():
    def one(column, dtype, number):
        measure = {
            None: "cast(null as double) as min, cast(null as double) as max, "
            "cast(null as double) as mean, cast(null as double) as std"
        }.get(
            number,
            f"min({number})::double as min, max({number})::double as max, "
            f"round(avg({number}), 4) as mean, round(stddev_samp({number}), 4) as std",
        )
        return (
            f"select '{column}' as \"column\", '{dtype}' as dtype, count(*) - count({column}) as null_count, "
            f"round((count(*) - count({column})) / count(*), 4) as null_pct, "
            f"{measure}, count(distinct {column}) as distinct_count from t"
        )

    parts = [
        one("l_linenumber", "int", "l_linenumber"),
        one("l_quantity", "double", "l_quantity"),
        one("l_discount", "double", "l_discount"),
        one("l_returnflag", "string", None),
        one("filled", "boolean", "filled::int"),
        one("l_suppkey", "bigint", "l_suppkey"),
    ]
    return f"with t as ({LINES_SQL}) " + " union all ".join(parts)


@query("column_profile", _profile_sql())
def column_profile(spark, sf):
    return quality.column_profile(
        checked_lines(spark, sf), ["l_linenumber", "l_quantity", "l_discount", "l_returnflag", "filled", "l_suppkey"]
    )


@query(
    "null_report",
    f"""
    with t as ({LINES_SQL}),
    c as (
        select 'l_linenumber' as "column", count(*) - count(l_linenumber) as null_count, count(*) as n from t
        union all select 'l_discount', count(*) - count(l_discount), count(*) from t
        union all select 'l_returnflag', count(*) - count(l_returnflag), count(*) from t
        union all select 'l_tax', count(*) - count(l_tax), count(*) from t
    )
    select "column", null_count, round(null_count / n, 4) as null_pct from c where null_count > 0
    """,
)
def null_report(spark, sf):
    return quality.null_report(checked_lines(spark, sf))


@query(
    "range_violations",
    f"""
    with t as ({LINES_SQL})
    select 'l_quantity' as "column", 3.0::double as low, 48.0::double as high,
           count(*) filter (l_quantity < 3 or l_quantity > 48) as violations from t
    union all select 'l_discount', 0.01, 0.09, count(*) filter (l_discount < 0.01 or l_discount > 0.09) from t
    union all select 'l_tax', 0.0, 0.07, count(*) filter (l_tax < 0 or l_tax > 0.07) from t
    """,
)
def range_violations(spark, sf):
    return quality.range_violations(checked_lines(spark, sf), RANGES)


@query(
    "range_examples",
    f"""
    with t as ({LINES_SQL}),
    bad as (
        select *, 'l_quantity' as "column", l_quantity as example from t where l_quantity < 3 or l_quantity > 48
        union all select *, 'l_discount', l_discount from t where l_discount < 0.01 or l_discount > 0.09
        union all select *, 'l_tax', l_tax from t where l_tax < 0 or l_tax > 0.07
    ),
    placed as (
        select "column", example, row_number() over (partition by "column"
            order by l_orderkey, l_partkey, l_suppkey, ship_date, example) as position
        from bad
    )
    select "column", position::int as position, example from placed where position <= 5
    """,
)
def range_examples(spark, sf):
    return quality.range_examples(
        checked_lines(spark, sf), RANGES, ["l_orderkey", "l_partkey", "l_suppkey", "ship_date"]
    )


@query(
    "future_dates",
    f"""
    select 'ship_date' as "column", count(*) filter (ship_date > timestamp '{AS_OF}') as future_count
    from ({LINES_SQL})
    """,
)
def future_dates(spark, sf):
    return quality.future_dates(checked_lines(spark, sf), F.lit(AS_OF))


@query(
    "value_shares",
    f"""
    select l_returnflag as value, count(*) as n,
           round(count(*) / (select count(l_returnflag) from ({LINES_SQL})), 6) as share
    from ({LINES_SQL}) where l_returnflag is not null group by 1
    """,
)
def value_shares(spark, sf):
    return quality.value_shares(checked_lines(spark, sf), "l_returnflag").withColumn("share", F.round("share", 6))


@query(
    "class_balance",
    """
    with c as (select toxic, count(*) as n from labels where toxic is not null group by 1)
    select count(*) as n_classes,
           round(case when count(*) > 1 then min(n) / sum(n) else 0.0 end, 6) as minority_share,
           case when count(*) > 1 then min(n) / sum(n) else 0.0 end < 0.10 as imbalanced
    from c
    """,
)
def class_balance(spark, sf):
    return quality.class_balance(table(spark, sf, "labels"), "toxic").withColumn(
        "minority_share", F.round("minority_share", 6)
    )


_ANOMALIES_SQL = f"""
    with t as ({LINES_SQL}),
    nulls as (
        select 'l_linenumber' as "column", count(*) - count(l_linenumber) as k, count(*) as n from t
        union all select 'l_discount', count(*) - count(l_discount), count(*) from t
        union all select 'l_returnflag', count(*) - count(l_returnflag), count(*) from t
    ),
    ranges as (
        select 'l_quantity' as "column", count(*) filter (l_quantity < 3 or l_quantity > 48) as k from t
        union all select 'l_discount', count(*) filter (l_discount < 0.01 or l_discount > 0.09) from t
        union all select 'l_tax', count(*) filter (l_tax < 0 or l_tax > 0.07) from t
    ),
    classes as (select filled, count(*) as n from t group by 1),
    found as (
        select 'null_values' as type, "column",
               case when round(k / n, 4) < 0.05 then 'WARNING' else 'ERROR' end as severity, k as count
        from nulls where k > 0
        union all select 'out_of_range', "column", 'ERROR', k from ranges where k > 0
        union all select 'future_date', 'ship_date', 'ERROR', count(*) from t where ship_date > timestamp '{AS_OF}'
        union all select 'class_imbalance', 'filled', 'WARNING', count(*) from classes
                  having case when count(*) > 1 then min(n) / sum(n) else 0 end < 0.6
    )
"""


def _findings(spark, sf):
    return quality.anomalies(checked_lines(spark, sf), RANGES, F.lit(AS_OF), "filled", floor=0.6)


@query("anomaly_findings", _ANOMALIES_SQL + "select * from found")
def anomaly_findings(spark, sf):
    return _findings(spark, sf)


@query(
    "anomaly_rollup",
    _ANOMALIES_SQL
    + """
    select count(*) as anomaly_count, count(*) filter (severity = 'ERROR') as error_count,
           count(*) filter (severity = 'WARNING') as warning_count
    from found
    """,
)
def anomaly_rollup(spark, sf):
    return quality.anomaly_summary(_findings(spark, sf))


@query(
    "quality_rates",
    """
    select round(avg((l_returnflag <> 'N')::int) filter (l_linestatus = 'F'), 6) as kept_rate,
           round(avg((l_discount = 0)::int), 6) as zero_discount_rate,
           round(avg((l_quantity < 3 or l_quantity > 48)::int), 6) as bad_quantity_rate
    from lineitem
    """,
)
def quality_rates(spark, sf):
    rates = quality.quality_rates(
        table(spark, sf, "lineitem"),
        {
            "kept_rate": (F.col("l_linestatus") == "F", F.col("l_returnflag") != "N"),
            "zero_discount_rate": (None, F.col("l_discount") == 0),
            "bad_quantity_rate": (None, (F.col("l_quantity") < 3) | (F.col("l_quantity") > 48)),
        },
    )
    return rates.select(*[F.round(c, 6).alias(c) for c in rates.columns])


@query(
    "leakage_check",
    """
    with t as (select (l_returnflag = 'R')::int as target, l_quantity, l_discount,
                      (l_returnflag = 'R')::int::double * 3 + l_tax / 1000 as shifted,
                      (l_returnflag = 'R')::int as twin from lineitem),
    r as (
        select 'l_quantity' as feature, corr(l_quantity, target) as c, bool_and(l_quantity = target) as e from t
        union all select 'l_discount', corr(l_discount, target), bool_and(l_discount = target) from t
        union all select 'shifted', corr(shifted, target), bool_and(shifted = target) from t
        union all select 'twin', corr(twin, target), bool_and(twin = target) from t
    )
    select feature, round(c, 6) as correlation, e as identical, abs(c) > 0.99 or e as leaks from r
    """,
)
def leakage_check(spark, sf):
    returned = (F.col("l_returnflag") == "R").cast("int")
    frame = table(spark, sf, "lineitem").select(
        returned.alias("target"),
        "l_quantity",
        "l_discount",
        (returned.cast("double") * 3 + F.col("l_tax") / 1000).alias("shifted"),
        returned.alias("twin"),
    )
    return quality.leakage(frame, "target").withColumn("correlation", F.round("correlation", 6))

