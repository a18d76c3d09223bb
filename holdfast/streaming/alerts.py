"""Alert messages: decoding, retrain decision, retrain requests.  Works on batch and stream frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.sources.messages import DRIFT_ALERT, RETRAIN_REQUEST, decode

RETRAIN_ABOVE = 3
DEFAULT_PIPELINE = "retention-pipeline"


def decode_alerts(messages: DataFrame) -> DataFrame:
    """Decoded drift alerts; messages without data are dropped, missing fields get 0 and false."""
    body = decode(F.col("data"), DRIFT_ALERT)
    return messages.where("data is not null").withColumn("_b", body).select(
        *[c for c in messages.columns if c != "data"],
        F.coalesce("_b.drifted_features", F.lit(0)).alias("drifted_features"),
        F.coalesce("_b.prediction_drift.drifted", F.lit(False)).alias("prediction_drifted"),
    )


def retrain_decisions(alerts: DataFrame, above: int = RETRAIN_ABOVE) -> DataFrame:
    """``retrain`` with more than ``above`` drifted features or drifted predictions, else ``monitor``."""
    act = (F.col("drifted_features") > above) | F.col("prediction_drifted")
    return alerts.withColumn("action", F.when(act, "retrain").otherwise("monitor"))


def decode_retrain_requests(messages: DataFrame, pipeline: str = DEFAULT_PIPELINE) -> DataFrame:
    """Retrain requests with their defaults; a message without data is a request with all defaults."""
    body = decode(F.col("data"), RETRAIN_REQUEST)
    return messages.withColumn("_b", body).select(
        *[c for c in messages.columns if c != "data"],
        F.coalesce("_b.reason", F.lit("manual")).alias("reason"),
        F.coalesce("_b.pipeline_name", F.lit(pipeline)).alias("pipeline_name"),
        F.substring(F.coalesce(F.to_json("_b"), F.lit("{}")), 1, 200).alias("config"),
    )


def deduplicate(stream: DataFrame, message_id: str = "message_id", ts: str = "publish_time", delay: str = "7 days") -> DataFrame:
    """Drop redelivered messages seen within the retention period."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([message_id])
