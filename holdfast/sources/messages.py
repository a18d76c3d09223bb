"""Message envelopes: base64 of a JSON document, as delivered by a message bus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Payload fields.
DRIFT_ALERT = "drifted_features bigint, prediction_drift struct<drifted: boolean>"
RETRAIN_REQUEST = "reason string, pipeline_name string"

ENVELOPE = "message_id string, publish_time timestamp, data string"


def encode(payload: Column) -> Column:
    return F.base64(F.encode(F.to_json(payload), "utf-8"))


def decode(data: Column, schema: str) -> Column:
    return F.from_json(F.decode(F.unbase64(data), "utf-8"), schema)


def message_stream(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes arriving as JSON files; a Kafka reader yielding the same columns works as well."""
    return spark.readStream.schema(ENVELOPE).json(path)
