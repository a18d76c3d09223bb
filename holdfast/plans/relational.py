"""Queries: merging, latest values per key, suffix renames, key checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import quality, relate
from holdfast.plans.registry import query, table

LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def line_history(spark, sf):
    """Line items as a history per order, with nulls in two of the measures."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        "l_shipdate",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        F.expr("nullif(l_discount, 0.0)").alias("discount"),
        F.expr("nullif(l_linenumber % 3, 0)").alias("part_no"),
        "l_returnflag",
    )


HISTORY_SQL = """
    select l_orderkey as orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity,
           nullif(l_discount, 0.0) as discount, nullif(l_linenumber % 3, 0) as part_no, l_returnflag
    from lineitem
"""
AT_SQL = "row(l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity)"


@query(
    "ingest_merge",
    f"""
    with history as ({HISTORY_SQL}),
    latest as (
        select orderkey, arg_max(l_quantity, {AT_SQL}) as quantity_last,
               arg_max(discount, {AT_SQL}) as discount,
               arg_max(part_no, {AT_SQL}) as part_no,
               arg_max(l_returnflag, {AT_SQL}) as flag
        from history group by orderkey
    ),
    payer as (
        select o_orderkey as orderkey, c_acctbal as acctbal, c_mktsegment as segment
        from orders left join customer on o_custkey = c_custkey
    )
    select e.l_orderkey as orderkey, e.l_linenumber as line, e.l_partkey as part, e.l_suppkey as supp,
           e.l_returnflag as flag, e.l_discount as discount,
           o.o_totalprice as totalprice, o.o_orderstatus as status,
           p.acctbal, p.segment,
           a.quantity_last, a.discount as discount_acad, a.part_no, a.flag as flag_acad
    from lineitem e
    left join orders o on e.l_orderkey = o.o_orderkey
    left join payer p on e.l_orderkey = p.orderkey
    left join latest a on e.l_orderkey = a.orderkey
    where e.l_returnflag = 'R'
    """,
)
def ingest_merge(spark, sf):
    """Returned lines (the events) with their order, its payer and the latest line values."""
    events = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_discount").alias("discount"),
    )
    orders = table(spark, sf, "orders")
    profile = orders.select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_totalprice").alias("totalprice"),
        F.col("o_orderstatus").alias("status"),
    )
    customer = table(spark, sf, "customer")
    payer = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    latest = relate.latest_values(
        line_history(spark, sf), "orderkey", LINE_ORDER, ["l_quantity", "discount", "part_no", "l_returnflag"]
    ).withColumnsRenamed({"l_quantity": "quantity_last", "l_returnflag": "flag"})
    return relate.merge_tables(
        events,
        "orderkey",
        [(profile, "_demo"), (payer, "_fin"), (latest, "_acad")],
        keep=F.col("flag") == "R",
    )


@query(
    "latest_nonnull_per_key",
    f"""
    select orderkey, arg_max(l_quantity, {AT_SQL}) as quantity, arg_max(discount, {AT_SQL}) as discount,
           arg_max(part_no, {AT_SQL}) as part_no
    from ({HISTORY_SQL}) group by orderkey
    """,
)
def latest_nonnull_per_key(spark, sf):
    return relate.latest_values(
        line_history(spark, sf), "orderkey", LINE_ORDER, ["l_quantity", "discount", "part_no"]
    ).withColumnRenamed("l_quantity", "quantity")


@query(
    "latest_row_per_key",
    f"""
    select orderkey, l_quantity as quantity, discount, part_no, l_returnflag as flag
    from ({HISTORY_SQL})
    qualify row_number() over (partition by orderkey order by l_shipdate desc, l_linenumber desc,
        l_partkey desc, l_suppkey desc, l_quantity desc) = 1
    """,
)
def latest_row_per_key(spark, sf):
    return relate.latest_row(line_history(spark, sf), "orderkey", LINE_ORDER).select(
        "orderkey", F.col("l_quantity").alias("quantity"), "discount", "part_no", F.col("l_returnflag").alias("flag")
    )


@query(
    "first_row_per_key",
    """
    select o_custkey as custkey, o_orderkey as orderkey, o_totalprice as totalprice
    from orders
    qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1
    """,
)
def first_row_per_key(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_totalprice").alias("totalprice"),
        "o_orderdate",
    )
    return relate.first_row(orders, "custkey", ["o_orderdate", "orderkey"]).drop("o_orderdate")


@query(
    "suffix_join",
    """
    select c.c_custkey as custkey, c.c_nationkey as nationkey, c.c_name as name, c.c_acctbal as acctbal,
           n.n_name as name_nation
    from customer c left join nation n on c.c_nationkey = n.n_nationkey
    """,
)
def suffix_join(spark, sf):
    left = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"),
    )
    right = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("name")
    )
    return relate.merge_tables(left, "nationkey", [(right, "_nation")])


@query(
    "key_integrity",
    """
    select 'lineitem.orderkey' as reference, count(distinct l_orderkey) as orphan_keys
    from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')
    union all
    select 'orders.custkey', count(distinct o_custkey)
    from orders where o_custkey not in (select c_custkey from customer)
    union all
    select 'customer.orders', count(distinct c_custkey)
    from customer where c_custkey not in (select o_custkey from orders)
    """,
)
def key_integrity(spark, sf):
    lines, orders, customers = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    settled = orders.where(F.col("o_orderstatus") != "P")
    checks = {
        "lineitem.orderkey": relate.orphans(lines, "l_orderkey", settled, "o_orderkey"),
        "orders.custkey": relate.orphans(orders, "o_custkey", customers, "c_custkey"),
        "customer.orders": relate.orphans(customers, "c_custkey", orders, "o_custkey"),
    }
    out = None
    for name, missing in checks.items():
        row = missing.agg(F.count(F.lit(1)).alias("orphan_keys")).select(F.lit(name).alias("reference"), "orphan_keys")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "duplicate_keys",
    """
    select l_orderkey as orderkey, count(*) as copies from lineitem group by 1 having count(*) > 1
    """,
)
def duplicate_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"))
    return relate.duplicate_keys(lines, "orderkey")


@query(
    "domain_check",
    """
    select 'l_returnflag' as "column", l_returnflag as value, count(*) as n
    from lineitem where l_returnflag not in ('A', 'N') group by 2
    union all
    select 'l_linestatus', l_linestatus, count(*) from lineitem where l_linestatus not in ('F') group by 2
    """,
)
def domain_check(spark, sf):
    return quality.domain_violations(
        table(spark, sf, "lineitem"), {"l_returnflag": ["A", "N"], "l_linestatus": ["F"]}
    )


@query(
    "align_distributions",
    """
    with a as (select l_quantity as value, count(*) * 1.0::double / (select count(*) from lineitem where l_returnflag = 'R') as p
               from lineitem where l_returnflag = 'R' group by 1),
         b as (select l_linenumber::double as value, count(*) * 1.0::double / (select count(*) from lineitem) as q
               from lineitem group by 1)
    select coalesce(a.value, b.value) as value, round(coalesce(p, 0.0), 6) as p, round(coalesce(q, 0.0), 6) as q
    from a full join b on a.value = b.value
    """,
)
def align_distributions(spark, sf):
    lines = table(spark, sf, "lineitem")
    a = quality.value_shares(lines.where("l_returnflag = 'R'"), "l_quantity")
    b = quality.value_shares(lines.select(F.col("l_linenumber").cast("double").alias("line")), "line")
    return relate.align_distributions(a, b, "value", "share").select(
        "value", F.round("p", 6).alias("p"), F.round("q", 6).alias("q")
    )
