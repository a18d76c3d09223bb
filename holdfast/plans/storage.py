"""Queries: sources and sinks as round trips over the given tables."""

from __future__ import annotations

import uuid

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from holdfast.operators import learn, models, serve
from holdfast.plans import learning
from holdfast.plans.registry import query, table
from holdfast.session import fresh_path
from holdfast.sources import schemas, tables
from holdfast.streaming import jobs, windows

CUSTOMER = "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double"
CUSTOMER_SQL = "select c_custkey, c_name, c_mktsegment, c_acctbal from customer"


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


def _table_name(label):
    return f"holdfast_{label}_{uuid.uuid4().hex[:12]}"


@query("csv_round_trip", CUSTOMER_SQL)
def csv_round_trip(spark, sf):
    """Written as CSV, read with a schema."""
    path = fresh_path(spark, "customers-csv")
    tables.write_csv(_customers(spark, sf), path)
    return tables.read_csv(spark, path, schemas.schema_of(CUSTOMER))


@query("csv_fallback", CUSTOMER_SQL)
def csv_fallback(spark, sf):
    """Source tables in a folder that holds only CSV."""
    folder = fresh_path(spark, "source")
    tables.write_csv(_customers(spark, sf), f"{folder}/customer.csv")
    return tables.read_source_tables(spark, folder, {"customer": CUSTOMER, "absent": CUSTOMER})["customer"]


@query(
    "catalog_round_trip",
    "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as ordered from orders",
)
def catalog_round_trip(spark, sf):
    """Saved as a table with a date column, read back with timestamps."""
    name = _table_name("orders")
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("ordered"))
    tables.load_table(orders, name)
    return tables.read_table(spark, name).select("o_orderkey", F.date_format("ordered", "yyyy-MM-dd HH:mm:ss").alias("ordered"))


@query("sql_to_frame", "select c_mktsegment, count(*) as n, round(sum(c_acctbal), 2) as balance from customer group by 1")
def sql_to_frame(spark, sf):
    text = "select c_mktsegment, count(*) as n, round(sum(c_acctbal), 2) as balance from {customer} group by 1"
    return tables.run_sql(spark, text, customer=table(spark, sf, "customer"))


@query("table_info", "select 4 as num_columns, count(*) as num_rows from customer")
def table_info(spark, sf):
    name = _table_name("customer")
    tables.load_table(_customers(spark, sf), name)
    return tables.table_info(spark, name).select("num_columns", "num_rows")


@query(
    "load_dispositions",
    """
    select 'truncate' as step, count(*) as n from customer union all select 'append', 2 * count(*) from customer
    union all select 'truncate again', count(*) from customer union all select 'refused', count(*) from customer
    """,
)
def load_dispositions(spark, sf):
    """Rows after each write; a write that needs an empty table is refused and changes nothing."""
    name, rows = _table_name("customer"), _customers(spark, sf)
    counts = [(step, tables.load_table(rows, name, mode)) for step, mode in (("truncate", "truncate"), ("append", "append"), ("truncate again", "truncate"))]
    try:
        tables.load_table(rows, name, "empty")
    except ValueError:
        counts.append(("refused", tables.table_info(spark, name).first()["num_rows"]))
    return spark.createDataFrame(counts, "step string, n bigint")


@query(
    "multi_table_load",
    "select 'nation' as name, count(*) as n from nation union all select 'customer', count(*) from customer union all select 'orders', count(*) from orders",
)
def multi_table_load(spark, sf):
    names = {_table_name(n): n for n in ("nation", "customer", "orders")}
    loaded = tables.load_tables(spark, sf, {n: t for t, n in names.items()})
    known = spark.createDataFrame(list(names.items()), "table string, name string")
    return loaded.join(known, "table").select("name", F.col("rows").alias("n"))


@query("json_report", "select c_mktsegment, count(*) as n from customer group by 1")
def json_report(spark, sf):
    path = fresh_path(spark, "report")
    tables.write_json_report(table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.schema("c_mktsegment string, n bigint").json(path)


@query(
    "clustered_layout",
    "select o_orderkey, o_custkey, floor(o_custkey / 100)::bigint * 100 as bucket from orders",
)
def clustered_layout(spark, sf):
    """Orders in folders by customer range, read back with the folder's value."""
    path = fresh_path(spark, "clustered")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    tables.write_clustered(orders, path, "bucket", tables.range_bucket("o_custkey", 100), ["o_custkey"])
    return spark.read.schema(f"{orders.schema.toDDL()}, bucket bigint").parquet(path)


def bucketed_lines(spark, sf):
    """Orders and lines in tables bucketed by order, joined and summed by order."""
    orders, lines = _table_name("orders"), _table_name("lines")
    tables.write_bucketed(table(spark, sf, "orders").selectExpr("o_orderkey as orderkey", "o_custkey"), orders, "orderkey", 16)
    measures = table(spark, sf, "lineitem").selectExpr("l_orderkey as orderkey", "l_quantity")
    tables.write_bucketed(measures, lines, "orderkey", 16)
    joined = spark.read.table(orders).hint("merge").join(spark.read.table(lines), "orderkey", "left")
    return joined.groupBy("orderkey", "o_custkey").agg(
        F.count("l_quantity").alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    "bucketed_merge",
    """
    select o_orderkey as orderkey, o_custkey, count(l_quantity) as lines, round(sum(l_quantity), 2) as quantity
    from orders left join lineitem on o_orderkey = l_orderkey group by 1, 2
    """,
)
def bucketed_merge(spark, sf):
    return bucketed_lines(spark, sf)


@query("declared_schemas", "select c_custkey, c_name, c_mktsegment, c_acctbal from customer where c_custkey is not null")
def declared_schemas(spark, sf):
    """A schema given as text, applied to a Parquet read."""
    return tables.read_parquet(spark, f"{sf}/customer.parquet", schemas.schema_of(CUSTOMER))


@query("first_rows", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 50")
def first_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return serve.first_rows(orders, [F.col("o_totalprice").desc(), "o_orderkey"], 50)


@query(
    "model_round_trip",
    "with " + learning.LABELS_SQL.strip() + " select count(*) as rows, count(*) as equal_scores from labels_",
)
def model_round_trip(spark, sf):
    """A model saved and loaded scores every row as before."""
    frame = learning.order_examples(spark, sf)
    _, fitted, split = learn.train(frame, ["logistic_regression"], ["none"])
    model, path = fitted["logistic_regression_none"], fresh_path(spark, "model")
    models.save_model(model, path)
    again = learn.scored(models.load_model(LogisticRegressionModel, path), split).select("id", F.col("predicted_probability").alias("again"))
    both = learn.scored(model, split).select("id", "predicted_probability").join(again, "id")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("again") == F.col("predicted_probability")).alias("equal_scores"))


def _event_stream(spark, sf):
    events = table(spark, sf, "events")
    return jobs.file_stream(spark, f"{sf}/events*.parquet", events.schema).withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "stream_prediction_log",
    """
    select cast(user_id as varchar) as student_id, strftime(ts, '%Y-%m-%d') as day, 'v1' as model_version,
           (value > 50)::bigint as predicted_class, round_even(value / 700, 4) as predicted_probability,
           value / 10 as latency_ms, event_type = 'purchase' as served_from_cache
    from events
    """,
)
def stream_prediction_log(spark, sf):
    """Events scored as a stream into the prediction log, which is read back."""
    log = fresh_path(spark, "prediction-log")

    def score(batch):
        return batch.select(
            "*",
            (F.col("value") > 50).cast("int").alias("predicted_class"),
            (F.col("value") / 700).alias("predicted_probability"),
            (F.col("value") / 10).alias("latency_ms"),
            (F.col("event_type") == "purchase").alias("served_from_cache"),
        ).transform(lambda scored: jobs.prediction_log(scored, "user_id", ["value", "event_id"], "v1", "ts"))

    jobs.score_stream(_event_stream(spark, sf), score, log, fresh_path(spark, "prediction-log-checkpoint"))
    shown = ["student_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "model_version", "predicted_class", "predicted_probability", "latency_ms", "served_from_cache"]
    return spark.read.parquet(log).select(*shown)


@query(
    "stream_cache_hit_mean",
    """
    select strftime(time_bucket(interval '60 seconds', ts), '%Y-%m-%d %H:%M:%S') as window_start,
           round(avg((event_type = 'purchase')::int), 6) as mean
    from events group by 1
    """,
)
def stream_cache_hit_mean(spark, sf):
    """Share of cache hits per minute, as a stream."""
    hits = _event_stream(spark, sf).withColumn("hit", (F.col("event_type") == "purchase").cast("double"))
    found = jobs.drain_updates(windows.window_mean(hits, "ts", [], "hit", windows.ONE_MINUTE, delay="1 hour"), ["window_start", "window_end"], "hit-mean")
    return found.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), F.round("mean", 6).alias("mean"))

