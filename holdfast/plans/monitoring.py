"""Queries: alert messages, tumbling-window metrics, threshold alerts; batch and streaming forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.operators import sketches
from holdfast.plans import distributions
from holdfast.plans.registry import query, table
from holdfast.session import fresh_path
from holdfast.sources.messages import encode
from holdfast.streaming import alerts, breaches, jobs, windows


def _sent(events):
    """Every event as an alert message; some without a body, some with missing fields."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    body = F.struct(
        F.when(k % 7 != 0, k % 10).alias("drifted_features"),
        F.when(k % 5 != 0, F.struct((k % 11 == 0).alias("drifted"))).alias("prediction_drift"),
    )
    return events.select(
        F.col("event_id").alias("message_id"),
        "ts",
        F.when(F.col("event_type") != "error", encode(body)).alias("data"),
    )


def messages(spark, sf):
    return _sent(table(spark, sf, "events")).drop("ts")


MESSAGES_SQL = """
    m as (
        select event_id as message_id, event_type, (props->>'$.k')::bigint as k from events
    ),
    decoded as (
        select message_id, case when k % 7 <> 0 then k % 10 else 0 end as drifted_features,
               k % 5 <> 0 and k % 11 = 0 as prediction_drifted
        from m where event_type <> 'error'
    )
"""


@query("alert_decode", f"with {MESSAGES_SQL} select * from decoded")
def alert_decode(spark, sf):
    return alerts.decode_alerts(messages(spark, sf))


@query(
    "retrain_decision",
    f"""
    with {MESSAGES_SQL}
    select *, case when drifted_features > 3 or prediction_drifted then 'retrain' else 'monitor' end as action
    from decoded
    """,
)
def retrain_decision(spark, sf):
    return alerts.retrain_decisions(alerts.decode_alerts(messages(spark, sf)))


@query(
    "retrain_requests",
    """
    select event_id as message_id,
           case when event_type = 'error' or event_type = 'view' then 'manual' else event_type end as reason,
           case when event_type in ('click', 'signup') then 'weekly' else 'retention-pipeline' end as pipeline_name,
           case when event_type in ('error', 'view') then '{}'
                when event_type in ('click', 'signup') then '{"reason":"' || event_type || '","pipeline_name":"weekly"}'
                else '{"reason":"' || event_type || '"}' end as config
    from events
    """,
)
def retrain_requests(spark, sf):
    kind = F.col("event_type")
    body = F.struct(
        F.when(kind != "view", kind).alias("reason"),
        F.when(kind.isin("click", "signup"), "weekly").alias("pipeline_name"),
    )
    sent = table(spark, sf, "events").select(
        F.col("event_id").alias("message_id"), F.when(kind != "error", encode(body)).alias("data")
    )
    return alerts.decode_retrain_requests(sent)


def points(spark, sf):
    return table(spark, sf, "events").select("ts", F.col("event_type").alias("series"), "value")


def _shown(df):
    """Window bounds as text, measures rounded."""
    out = df.drop("window_end").withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))
    doubles = [c for c, t in out.dtypes if t == "double"]
    return out.withColumns({c: F.round(c, 6) for c in doubles}) if doubles else out


def _bucket(seconds):
    return f"strftime(time_bucket(interval '{seconds} seconds', ts), '%Y-%m-%d %H:%M:%S') as window_start"


MEAN_SQL = f"""
    select {_bucket(300)}, event_type as series, round(avg(value), 6) as mean from events group by all
"""


@query("window_mean", MEAN_SQL)
def window_mean(spark, sf):
    return _shown(windows.window_mean(points(spark, sf), "ts", ["series"], "value"))


@query(
    "window_p99",
    f"""
    select {_bucket(3600)}, event_type as series, round(quantile_cont(value, 0.5), 6) as p50,
           round(quantile_cont(value, 0.99), 6) as p99
    from events group by all
    """,
)
def window_p99(spark, sf):
    return _shown(windows.window_percentiles_exact(points(spark, sf), "ts", ["series"], "value", 3600))


def _p99_sql(seconds):
    return f"""
    select {_bucket(seconds)}, event_type as series, round(quantile_cont(value, 0.5), 6) as p50,
           round(quantile_cont(value, 0.99), 6) as p99
    from events group by all
    """


@query("window_p99_5min", _p99_sql(300))
def window_p99_5min(spark, sf):
    return _shown(windows.window_percentiles_exact(points(spark, sf), "ts", ["series"], "value", 300))


@query("window_p99_1min", _p99_sql(60))
def window_p99_1min(spark, sf):
    return _shown(windows.window_percentiles_exact(points(spark, sf), "ts", ["series"], "value", 60))


@query(
    "sketched_percentiles",
    """
    select to_timestamp(floor(epoch(ts) / 86400) * 86400)::timestamp::varchar as day, event_type as series,
           count(*) as points, round(quantile_disc(value, 0.5), 6) as p50, round(quantile_disc(value, 0.99), 6) as p99
    from events group by all
    """,
)
def sketched_percentiles(spark, sf):
    """Sketches of each minute, stored by day and merged to days; exact while a day has up to 1,024 values."""
    folder = fresh_path(spark, "sketches")
    seen = table(spark, sf, "events").select("ts", F.col("event_type").alias("series"), "value", "user_id")
    minutes = sketches.sketched(seen, "ts", ["series"], "value", "user_id")
    sketches.store(minutes, folder)
    days = sketches.merged(sketches.read(spark, folder), ["series"], 86400, {"p50": 0.5, "p99": 0.99})
    return days.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("day"), "series", "points",
        F.round("p50", 6).alias("p50"), F.round("p99", 6).alias("p99"),
    )


@query(
    "window_sum",
    f"""
    select {_bucket(300)}, event_type as series, round(sum(value), 6) as total from events group by all
    """,
)
def window_sum(spark, sf):
    return _shown(windows.window_sum(points(spark, sf), "ts", ["series"], "value"))


RATE_SQL = """
    rates as (
        select {bucket}, count(*) as requests, count(*) filter (event_type = 'error') as errors,
               round(count(*) / {s}, 6) as requests_per_s,
               round(count(*) filter (event_type = 'error') / {s}, 6) as errors_per_s,
               round(count(*) filter (event_type = 'error') / count(*), 6) as error_share
        from events group by all
    )
"""


@query("window_rate", "with " + RATE_SQL.format(bucket=_bucket(60), s=60) + " select * from rates")
def window_rate(spark, sf):
    return _shown(windows.window_rate(points(spark, sf), "ts", [], F.col("series") == "error"))


@query(
    "threshold_alert",
    "with " + RATE_SQL.format(bucket=_bucket(3600), s=3600) + " select * from rates where error_share > 0.25",
)
def threshold_alert(spark, sf):
    rates = windows.window_rate(points(spark, sf), "ts", [], F.col("series") == "error", 3600)
    return _shown(windows.threshold_alerts(rates, "error_share", 0.25))


@query(
    "sustained_alert",
    """
    with m as (
        select time_bucket(interval '3600 seconds', ts) as w, event_type as series, avg(value) as mean
        from events group by all
    ),
    r as (
        select *, sum((mean > 45)::int) over (partition by series order by w
            range between interval 2 hours preceding and current row) as k
        from m
    )
    select strftime(w, '%Y-%m-%d %H:%M:%S') as window_start, series, round(mean, 6) as mean,
           k::bigint as breaching_windows
    from r where k >= 3
    """,
)
def sustained_alert(spark, sf):
    """Hourly means above 45 for three hours on end."""
    means = windows.window_mean(points(spark, sf), "ts", ["series"], "value", 3600)
    return _shown(windows.sustained_alerts(means, ["series"], "mean", 45, 3600, 3 * 3600))


def _event_stream(spark, sf):
    return jobs.file_stream(spark, f"{sf}/events*.parquet", table(spark, sf, "events").schema)


@query("stream_window_mean", MEAN_SQL)
def stream_window_mean(spark, sf):
    """The tumbling mean as a stream run to its end."""
    stream = _event_stream(spark, sf).select("ts", F.col("event_type").alias("series"), "value")
    means = windows.window_mean(stream, "ts", ["series"], "value", delay="1 hour")
    return _shown(jobs.drain_updates(means, ["window_start", "window_end", "series"], "window-mean"))


@query(
    "stream_sustained_alert",
    """
    with m as (
        select time_bucket(interval '3600 seconds', ts) as w, event_type as series, avg(value) as mean
        from events group by all
    ),
    r as (
        select *, sum((mean > 45)::int) over (partition by series order by w
            range between interval 2 hours preceding and current row) as k
        from m
    )
    select strftime(w, '%Y-%m-%d %H:%M:%S') as window_start, series, round(mean, 6) as mean,
           k::bigint as breaching_windows
    from r where k >= 3 and w + interval 2 hours <= (select max(ts) from events)
    """,
)
def stream_sustained_alert(spark, sf):
    """Hourly means above 45 for three hours on end, told as windows close an hour behind the newest event."""
    stream = _event_stream(spark, sf).select("ts", F.col("event_type").alias("series"), "value")
    means = windows.window_mean(stream, "ts", ["series"], "value", 3600, delay="1 hour")
    told = breaches.sustained_alert_stream(means, ["series"], "mean", 45, 3600, 3 * 3600)
    return _shown(jobs.with_state_store(spark, lambda: jobs.drain_rows(told, "sustained-alerts")))


@query(
    "stream_retrain_decision",
    f"""
    with {MESSAGES_SQL}
    select message_id, case when drifted_features > 3 or prediction_drifted then 'retrain' else 'monitor' end as action
    from decoded
    """,
)
def stream_retrain_decision(spark, sf):
    """Redelivered messages dropped, then decoded and decided, as a stream run to its end."""
    sent = _sent(_event_stream(spark, sf)).withColumn("publish_time", F.col("ts").cast("timestamp"))
    # every message is delivered twice
    sent = sent.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    once = alerts.deduplicate(sent.drop("delivery", "ts"))
    decided = alerts.retrain_decisions(alerts.decode_alerts(once)).select("message_id", "action")
    return jobs.drain_rows(decided, "retrain-decision")


@query(
    "stream_drift_check",
    "with " + distributions.DRIFT_SQL + """
    select count(*) filter (drifted) as drifted_features, (select js > 0.1 from class_js) as prediction_drifted,
           case when count(*) filter (drifted) > 3 or (select js > 0.1 from class_js) then 'retrain' else 'monitor' end as action
    from report
    """,
)
def stream_drift_check(spark, sf):
    """Serving rows as a stream: every micro-batch is compared with the training profile, its alert is
    sent as a message, and the message is decoded and decided."""
    profile, _ = distributions.halves(spark, sf)
    lines = table(spark, sf, "lineitem")
    stream = jobs.file_stream(spark, f"{sf}/lineitem*.parquet", lines.schema)
    sent, checkpoint = fresh_path(spark, "drift-alerts"), fresh_path(spark, "drift-checkpoint")
    jobs.check_batches(distributions.serving_half(stream), profile, "target", sent, checkpoint)
    arrived = spark.read.parquet(sent).select("data")
    return alerts.retrain_decisions(alerts.decode_alerts(arrived))


@query(
    "stream_cache_lookup",
    """
    with e as (
        select event_id, user_id as entity, ts, event_type = 'purchase' as answer, (value > 50)::int as class from events
    ),
    held as (
        select *, last_value(case when answer then ts end ignore nulls) over w as stored,
               last_value(case when answer then class end ignore nulls) over w as held_class
        from e window w as (partition by entity order by ts, event_id rows unbounded preceding)
    )
    select entity, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, coalesce(ts - stored < interval 6 hours, false) as hit,
           case when ts - stored < interval 6 hours then held_class end as predicted_class
    from held where not answer
    """,
)
def stream_cache_lookup(spark, sf):
    """Purchases store an answer for their user, every other event asks for it; answers live six hours."""
    bought = F.col("event_type") == "purchase"
    rows = _event_stream(spark, sf).select(
        F.col("user_id").alias("entity"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").cast("bigint").alias("seq"),
        F.when(bought, (F.col("value") > 50).cast("int")).alias("predicted_class"),
        F.when(bought, F.col("value") / 500).alias("probability"),
    )
    looked = jobs.looked_up(rows, 21600)
    return looked.select("entity", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "hit", "predicted_class")
