"""Queries: harmonise, clean and encode, derived features, export."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import prep
from holdfast.plans.registry import query, table

RAW_TYPES = {
    "orderkey": "string",
    "flag": "string",
    "returned": "boolean",
    "quantity": "double",
    "tax": "double",
    "line": "bigint",
}


def raw_lines(spark, sf):
    """Line items as untyped text with bad values, nulls and exact duplicates."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("orderkey"),
        F.expr("case when l_returnflag = 'A' then 'nan' when l_returnflag = 'N' then 'None' else l_returnflag end").alias("flag"),
        F.expr("case when l_linenumber = 1 then null when l_linenumber = 2 then 'maybe' "
               "else cast(l_returnflag = 'R' as string) end").alias("returned"),
        F.expr("case when l_linenumber = 3 then 'n/a' else cast(cast(l_quantity as int) as string) end").alias("quantity"),
        F.expr("nullif(l_tax, 0.0)").alias("tax"),
        F.expr("case when l_linenumber = 4 then null else cast(l_linenumber as string) end").alias("line"),
        F.expr("nullif(l_linestatus, 'F')").alias("extra"),
    )
    return lines.unionAll(lines.where("line = '5'"))


RAW_SQL = """
    select l_orderkey::varchar as orderkey,
           case when l_returnflag = 'A' then 'nan' when l_returnflag = 'N' then 'None' else l_returnflag end as flag,
           case when l_linenumber = 1 then null when l_linenumber = 2 then 'maybe'
                else (l_returnflag = 'R')::varchar end as returned,
           case when l_linenumber = 3 then 'n/a' else l_quantity::int::varchar end as quantity,
           nullif(l_tax, 0.0) as tax,
           case when l_linenumber = 4 then null else l_linenumber::varchar end as line,
           nullif(l_linestatus, 'F') as extra
    from lineitem
"""
RAW_SQL = f"select * from ({RAW_SQL}) union all select * from ({RAW_SQL}) where line = '5'"
TYPED_SQL = f"""
    select orderkey, case when flag in ('nan', 'None') then null else flag end as flag,
           try_cast(returned as boolean) as returned, try_cast(quantity as double) as quantity, tax,
           try_cast(line as bigint) as line, extra
    from (select distinct * from ({RAW_SQL}))
"""


@query(
    "harmonize_cast_fill",
    f"""
    select orderkey, coalesce(flag, 'unknown') as flag, coalesce(returned, false) as returned,
           coalesce(quantity, -1.0) as quantity, coalesce(tax, -1.0) as tax, coalesce(line, -1) as line,
           coalesce(extra, 'unknown') as extra
    from ({TYPED_SQL})
    """,
)
def harmonize_cast_fill(spark, sf):
    return prep.harmonise(raw_lines(spark, sf), RAW_TYPES)


@query(
    "harmonize_report",
    f"""
    with raw as ({RAW_SQL}), typed as ({TYPED_SQL})
    select (select count(*) from raw) as initial_rows,
           (select count(*) from raw) - count(*) as duplicates_removed,
           6::int as columns_coerced,
           (count(*) > count(orderkey))::int + (count(*) > count(flag))::int + (count(*) > count(returned))::int
             + (count(*) > count(quantity))::int + (count(*) > count(tax))::int + (count(*) > count(line))::int
             + (count(*) > count(extra))::int as nulls_filled,
           count(*) as output_rows, 7::int as output_columns
    from typed
    """,
)
def harmonize_report(spark, sf):
    return prep.harmonise_report(raw_lines(spark, sf), RAW_TYPES)


@query("dedup_full", f"select distinct * from ({RAW_SQL})")
def dedup_full(spark, sf):
    return prep.unique_columns(raw_lines(spark, sf)).distinct()


def coded_parts(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("partkey"),
        F.col("p_type").alias("type"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("name"),
        (F.col("p_size") > 25).alias("large"),
        F.lit("same").alias("fixed"),
        F.col("p_retailprice").alias("price"),
    )


@query(
    "one_hot",
    """
    select p_partkey as partkey, (p_type = 'ECONOMY')::int as type_ECONOMY,
           (p_type = 'STANDARD')::int as type_STANDARD, (p_type = 'PROMO')::int as type_PROMO,
           (p_type = 'MEDIUM')::int as type_MEDIUM, (p_type = 'LARGE')::int as type_LARGE,
           (p_type = 'SMALL')::int as type_SMALL
    from part
    """,
)
def one_hot(spark, sf):
    frame = coded_parts(spark, sf).select("partkey", "type")
    return prep.one_hot(frame, prep.categories(frame, ["type"]))


@query(
    "clean_frame",
    """
    select p_partkey as partkey, p_retailprice as price, (p_size > 25)::int as large,
           (p_type = 'ECONOMY')::int as type_ECONOMY,
           (p_type = 'STANDARD')::int as type_STANDARD, (p_type = 'PROMO')::int as type_PROMO,
           (p_type = 'MEDIUM')::int as type_MEDIUM, (p_type = 'LARGE')::int as type_LARGE,
           (p_type = 'SMALL')::int as type_SMALL
    from part
    """,
)
def clean_frame(spark, sf):
    """Constants dropped, small categories encoded, wide text dropped, flags as 0/1."""
    cleaned, _ = prep.clean(coded_parts(spark, sf), target="price", entity="partkey", max_categories=10)
    return cleaned


@query(
    "drop_constants",
    """
    select l_orderkey as orderkey, l_quantity as quantity, l_linestatus as status from lineitem
    """,
)
def drop_constants(spark, sf):
    frame = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_linestatus").alias("status"),
        F.when(F.col("l_quantity") < 0, 1.0).alias("empty"),
        F.when(F.col("l_linenumber") > 2, "x").alias("single"),
    )
    return frame.drop(*prep.constant_columns(frame, [c for c in frame.columns if c != "orderkey"]))


# Line items in the role of the grade, credit and aid measures.
ROLES = {
    "cumulative_gpa": "l_quantity / 10 - 0.5",
    "hs_gpa": "cast(l_linenumber as double)",
    "term_gpa": "l_discount * 40",
    "credits_earned": "l_quantity - 10",
    "credits_attempted": "cast(l_linenumber as double) * 5 - 10",
    "efc": "l_extendedprice - 5000",
    "total_aid_amount": "l_tax * 1000000",
    "loan_amount": "l_discount * 1000",
    "campus_distance_miles": "case when l_linenumber = 7 then null else l_quantity * l_linenumber * 2.5 - 25 end",
    "sat_score": "400 + l_quantity * 25",
    "act_score": "cast(l_linenumber as double) * 6",
    "cohort_year": "year(l_shipdate)",
}


def measures(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.selectExpr(
        "l_orderkey as student_id", "l_linenumber as line", "l_partkey as part", "l_suppkey as supp",
        *[f"{e} as {name}" for name, e in ROLES.items()],
    )


MEASURES_SQL = (
    "select l_orderkey as student_id, l_linenumber as line, l_partkey as part, l_suppkey as supp, "
    + ", ".join(f"{e} as {name}" for name, e in ROLES.items())
    + " from lineitem"
)
FEATURES_SQL = f"""
    select *,
        cumulative_gpa - hs_gpa as gpa_change,
        (cumulative_gpa - hs_gpa > 0)::int as gpa_improved,
        case when cumulative_gpa > 0 then term_gpa / cumulative_gpa else 1.0 end as gpa_momentum,
        case when credits_attempted > 0 then credits_earned / credits_attempted else 0.0 end as credit_ratio,
        credits_attempted - credits_earned as credit_deficit,
        greatest(0.0, least(50.0, case when efc > 0 then total_aid_amount / efc else 0.0 end)) as aid_coverage_ratio,
        case when total_aid_amount > 0 then loan_amount / total_aid_amount else 0.0 end as loan_dependency,
        case when campus_distance_miles is null or campus_distance_miles < 0 then -1
             when campus_distance_miles <= 25 then 0 when campus_distance_miles <= 50 then 1
             when campus_distance_miles <= 100 then 2 when campus_distance_miles <= 250 then 3
             when campus_distance_miles <= 500 then 4 else 5 end as distance_bin,
        greatest(0.0, least(1.0, ((sat_score - 400) / 1200 + (act_score - 1) / 35) / 2)) as test_score_composite,
        cohort_year - (select min(year(l_shipdate)) from lineitem) as cohort_recency
    from ({MEASURES_SQL})
"""


def _features(spark, sf):
    frame = measures(spark, sf)
    return prep.engineer_features(frame.withColumn("cohort_year", F.col("cohort_year").cast("bigint")))


def _keys():
    return ["student_id", "line", "part", "supp"]


@query(
    "guarded_ratios",
    f"""
    select student_id, line, part, supp, round(gpa_change, 6) as gpa_change, gpa_improved,
           round(gpa_momentum, 6) as gpa_momentum, round(credit_ratio, 6) as credit_ratio,
           round(credit_deficit, 6) as credit_deficit, round(aid_coverage_ratio, 6) as aid_coverage_ratio,
           round(loan_dependency, 6) as loan_dependency
    from ({FEATURES_SQL})
    """,
)
def guarded_ratios(spark, sf):
    ratios = ["gpa_change", "gpa_momentum", "credit_ratio", "credit_deficit", "aid_coverage_ratio", "loan_dependency"]
    return _features(spark, sf).select(*_keys(), "gpa_improved", *[F.round(c, 6).alias(c) for c in ratios])


@query("distance_bins", f"select distance_bin, count(*) as n from ({FEATURES_SQL}) group by 1")
def distance_bins(spark, sf):
    return _features(spark, sf).groupBy("distance_bin").agg(F.count(F.lit(1)).alias("n"))


@query(
    "score_composite",
    f"select student_id, line, part, supp, round(test_score_composite, 6) as composite from ({FEATURES_SQL})",
)
def score_composite(spark, sf):
    return _features(spark, sf).select(*_keys(), F.round("test_score_composite", 6).alias("composite"))


@query("recency", f"select cohort_recency::bigint as cohort_recency, count(*) as n from ({FEATURES_SQL}) group by 1")
def recency(spark, sf):
    return _features(spark, sf).groupBy("cohort_recency").agg(F.count(F.lit(1)).alias("n"))


@query(
    "feature_export",
    f"""
    with f as (select student_id, round(hs_gpa, 6) as hs_gpa, round(credit_ratio, 6) as credit_ratio, distance_bin,
                      part, supp, line from ({FEATURES_SQL}))
    select student_id, hs_gpa, credit_ratio, distance_bin from f
    qualify row_number() over (partition by student_id order by line, part, supp, hs_gpa, credit_ratio, distance_bin) = 1
    """,
)
def feature_export(spark, sf):
    features = _features(spark, sf).select(
        *_keys(), F.round("hs_gpa", 6).alias("hs_gpa"), F.round("credit_ratio", 6).alias("credit_ratio"), "distance_bin"
    )
    wanted = ["hs_gpa", "credit_ratio", "distance_bin", "not_there"]
    return prep.export_features(
        features, "student_id", wanted, ["line", "part", "supp", "hs_gpa", "credit_ratio", "distance_bin"]
    )


@query(
    "dedup_entity",
    """
    select l_orderkey as orderkey, l_partkey as part, l_quantity as quantity from lineitem
    qualify row_number() over (partition by l_orderkey order by l_partkey, l_quantity) = 1
    """,
)
def dedup_entity(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity")
    )
    return prep.export_features(lines, "orderkey", ["part", "quantity"])


@query(
    "date_gap",
    """
    select o_custkey as custkey,
           date_diff('day', max(o_orderdate) filter (o_orderstatus = 'F'),
                            max(o_orderdate) filter (o_orderstatus = 'O'))::int as gap_days
    from orders group by 1
    """,
)
def date_gap(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "custkey")
    return prep.latest_date_gap(orders, "custkey", "o_orderstatus", "o_orderdate", "F", "O")


@query(
    "running_average",
    """
    select user_id, event_id, round(avg(value) over w, 10) as average,
           case when round(avg(value) over w, 10) < 15 then 'suspension'
                when round(avg(value) over w, 10) < 30 then 'probation' else 'good' end as standing
    from events
    window w as (partition by user_id order by ts, event_id rows unbounded preceding)
    """,
)
def running_average(spark, sf):
    """Cumulative mean per entity in time order, and the standing derived from it."""
    return prep.running_standing(
        table(spark, sf, "events"), "user_id", ["ts", "event_id"], "value", {"suspension": 15, "probation": 30}, "good", 10
    ).select("user_id", "event_id", "average", "standing")


@query(
    "change_flag",
    """
    select user_id, event_id,
           coalesce(event_type <> lag(event_type) over (partition by user_id order by ts, event_id), false) as changed
    from events
    """,
)
def change_flag(spark, sf):
    return prep.changed_from_previous(table(spark, sf, "events"), "user_id", ["ts", "event_id"], "event_type").select(
        "user_id", "event_id", "changed"
    )
