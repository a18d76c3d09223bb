"""Running streaming queries: files in, whole results out, drift checks, scoring and keyed answers.

Every query keeps its checkpoint in the shared folder, so a lost driver or executor resumes from the
last finished batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from holdfast.functions.ordered import running_last
from holdfast.operators import drift
from holdfast.operators.serve import validate_requests
from holdfast.session import fresh_path
from holdfast.sources.messages import encode


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream; ``path`` is a folder or a pattern."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", write: Callable | None = None) -> None:
    """Process everything available and stop.  Each batch goes to its own folder under ``path``, so a
    batch repeated after a failure replaces its own output."""

    def default_write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write or default_write)
        .start()
    )
    query.awaitTermination()


def collect_latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The last update of each key over the batch folders of an update-mode query."""
    frame = spark.read.schema(schema).option("recursiveFileLookup", False).parquet(path)
    rest = [c for c in frame.columns if c not in (*keys, "batch")]
    last = F.max_by(F.struct(*rest), "batch").alias("_r")
    return frame.groupBy(*keys).agg(last).select(*keys, "_r.*")


def drain_updates(stream: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Run an aggregating stream to its end and return its final state as a frame."""
    spark = stream.sparkSession
    out, checkpoint = fresh_path(spark, label), fresh_path(spark, f"{label}-checkpoint")
    drain(stream, out, checkpoint, "update")
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    return collect_latest(spark, out, schema, keys)


def drain_rows(stream: DataFrame, label: str) -> DataFrame:
    """Run an append-only stream to its end and return the rows it wrote."""
    spark = stream.sparkSession
    out, checkpoint = fresh_path(spark, label), fresh_path(spark, f"{label}-checkpoint")
    drain(stream, out, checkpoint, "append")
    return spark.read.schema(stream.schema).parquet(out).select(*stream.columns)


def check_batches(
    predictions: DataFrame, profile: DataFrame, target: str, alerts_path: str, checkpoint: str, threshold: float = 0.1
) -> None:
    """Compare every micro-batch of predictions with the training data; write one alert row each.

    The training data is counted once, before the stream starts; a batch reads only that profile.
    """
    known = drift.training_profile(profile, target, ["predicted_class"])

    def check(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            features = drift.drift_from_profile(known, batch, threshold, ["predicted_class"])
            classes = drift.prediction_drift_from_profile(known, batch, threshold=threshold)
            decision = drift.alert(features, classes)
            message = encode(
                F.struct(
                    "drifted_features", F.struct(F.col("prediction_drifted").alias("drifted")).alias("prediction_drift")
                )
            )
            decision.withColumn("data", message).write.mode("overwrite").parquet(f"{alerts_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    drain(predictions, alerts_path, checkpoint, "append", check)


def prediction_log(scored: DataFrame, entity: str, features: Sequence[str], version: str, ts: str | None = None) -> DataFrame:
    """Scored rows in the shape of the prediction log.

    ``prediction_id`` is a hash of the request, so a repeated batch writes the same ids. ``latency_ms``
    and ``served_from_cache`` are taken from columns of those names where the rows carry them.
    """
    stamp = F.col(ts) if ts else F.current_timestamp()
    body = F.to_json(F.struct(*features))
    return scored.select(
        F.sha2(F.concat_ws("|", F.col(entity).cast("string"), stamp.cast("string"), body), 256).alias("prediction_id"),
        F.col(entity).cast("string").alias("student_id"),
        stamp.cast("timestamp").alias("prediction_timestamp"),
        F.lit(version).alias("model_version"),
        F.col("predicted_class").cast("bigint").alias("predicted_class"),
        F.bround("predicted_probability", 4).alias("predicted_probability"),
        body.alias("features_json"),
        (F.col("latency_ms") if "latency_ms" in scored.columns else F.lit(None)).cast("double").alias("latency_ms"),
        (F.col("served_from_cache") if "served_from_cache" in scored.columns else F.lit(False)).cast("boolean").alias("served_from_cache"),
    )


def score_stream(requests: DataFrame, score: Callable[[DataFrame], DataFrame], log_path: str, checkpoint: str) -> None:
    """Score a stream of valid requests into the prediction log, partitioned by day."""

    def write(batch: DataFrame, batch_id: int) -> None:
        logged = score(batch).withColumn("day", F.to_date("prediction_timestamp"))
        logged.write.mode("overwrite").partitionBy("day").parquet(f"{log_path}/batch={batch_id}")

    drain(requests, log_path, checkpoint, "append", write)


class AnswerCache(StatefulProcessor):
    """Last answer per entity, forgotten after its time to live; requests get a hit or a miss.

    Input rows: entity, ts, seq, predicted_class, probability; rows without a class are requests, and
    seq orders rows of one time. The rows of an entity in a batch are put in order once, in memory, however many
    chunks they come in; ``cache_lookups`` has no such bound. State is read and written once a batch; an event-time timer clears an answer that can no longer be used.
    """

    def __init__(self, ttl_seconds: int):
        self.ttl = ttl_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.answer = handle.getValueState("answer", "predicted_class int, probability double, stored bigint, seq bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        chunk = pd.concat(list(rows), ignore_index=True)
        at = chunk["ts"].to_numpy("datetime64[us]").astype(np.int64)
        seq = chunk["seq"].to_numpy(np.int64)
        label = chunk["predicted_class"].to_numpy(float, na_value=np.nan)
        chance = chunk["probability"].to_numpy(float, na_value=np.nan)
        held = self.answer.get() if self.answer.exists() else None
        if held is not None:  # the held answer takes its place among the rows
            at, seq = np.append(at, held[2]), np.append(seq, held[3])
            label, chance = np.append(label, held[0]), np.append(chance, held[1])
        order = np.lexsort((seq, at))
        answers = ~np.isnan(label[order])
        last = np.maximum.accumulate(np.where(answers, np.arange(len(order)), -1))
        if answers.any():
            newest = order[last[-1]]
            if newest < len(chunk):
                self.answer.update((int(label[newest]), float(chance[newest]), int(at[newest]), int(seq[newest])))
                self.handle.registerTimer(int(at[newest] + self.ttl) // 1000 + 1)
        asked = np.flatnonzero(~answers)
        source = order[last[asked]]
        fresh = (last[asked] >= 0) & (at[order[asked]] - at[source] < self.ttl)
        found = pd.DataFrame({"entity": key[0], "ts": chunk["ts"].to_numpy()[order[asked]], "hit": fresh})
        found["predicted_class"] = pd.array(np.where(fresh, label[source], np.nan), dtype="Int32")
        found["probability"] = pd.array(np.where(fresh, chance[source], np.nan), dtype="Float64")
        yield found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.answer.exists() and self.answer.get()[2] + self.ttl <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
            self.answer.clear()
        return iter([])

    def close(self) -> None:
        pass


LOOKUPS = "entity bigint, ts timestamp, hit boolean, predicted_class int, probability double"


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state_store(spark: SparkSession, run: Callable):
    """Run with the state store that keyed state needs, then put the session's own choice back."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return run()
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def cache_stream(rows: DataFrame, ttl_seconds: int = 3600, delay: str = "10 minutes") -> DataFrame:
    """Answer the requests of a mixed stream of answers and requests from keyed state.

    A whole-number column ``seq``, if there is one, orders rows of one time. Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    if "seq" not in rows.columns:
        rows = rows.withColumn("seq", F.lit(0).cast("bigint"))
    return (
        rows.withWatermark("ts", delay)
        .groupBy("entity")
        .transformWithStateInPandas(AnswerCache(ttl_seconds), LOOKUPS, "Append", "EventTime")
    )


def cache_lookups(rows: DataFrame, path: str, held_path: str, checkpoint: str, ttl_seconds: int = 3600, delay_seconds: int = 600) -> None:
    """``cache_stream`` without an entity's rows in one task: lookups go to a folder per batch under ``path``.

    The last answer is carried over each entity's rows by blocks of time, so of an entity only a row per block
    meets in one task. Answers that are still of use are kept from batch to batch, one row per entity, in two
    folders by turns: a repeated batch finds what the one before it left.
    """
    spark = rows.sparkSession
    if "seq" not in rows.columns:
        rows = rows.withColumn("seq", F.lit(0).cast("bigint"))
    rows = rows.select("entity", "ts", "seq", "predicted_class", "probability")
    answer = F.struct("ts", "seq", "predicted_class", "probability")
    kept = T.StructType([*rows.schema.fields, T.StructField("seen", T.TimestampType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            seen = batch.agg(F.max("ts").alias("seen"))
            every = batch
            if batch_id:
                before = spark.read.schema(kept).parquet(f"{held_path}/turn={(batch_id - 1) % 2}")
                seen = seen.unionByName(before.select("seen")).agg(F.max("seen").alias("seen"))
                every = every.unionByName(before.drop("seen"))
            every = every.withColumn("answer", F.when(F.col("predicted_class").isNotNull(), answer))
            told = running_last(every, ["entity"], ["ts", "seq"], "answer", "last").where(F.col("predicted_class").isNull())
            age = F.unix_micros("ts") - F.unix_micros("last.ts")
            told = told.withColumn("hit", F.coalesce(age < ttl_seconds * 1_000_000, F.lit(False)))
            found = [F.when(F.col("hit"), F.col(f"last.{c}")).alias(c) for c in ("predicted_class", "probability")]
            told.select("entity", "ts", "hit", *found).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            newest = every.where("answer IS NOT NULL").groupBy("entity").agg(F.max_by("answer", F.struct("ts", "seq")).alias("answer"))
            newest = newest.select("entity", "answer.*").crossJoin(F.broadcast(seen))
            # what is older than any request that may still come by more than its time to live
            newest = newest.where(F.unix_micros("ts") + (ttl_seconds + delay_seconds) * 1_000_000 > F.unix_micros("seen"))
            newest.write.mode("overwrite").parquet(f"{held_path}/turn={batch_id % 2}")
        finally:
            batch.unpersist()

    drain(rows, path, checkpoint, "append", write)


def looked_up(rows: DataFrame, ttl_seconds: int, label: str = "lookups") -> DataFrame:
    """Run ``cache_lookups`` to its end and return the rows it wrote."""
    spark = rows.sparkSession
    out, held, checkpoint = (fresh_path(spark, f"{label}{c}") for c in ("", "-held", "-checkpoint"))
    cache_lookups(rows, out, held, checkpoint, ttl_seconds)
    entity = rows.schema["entity"].dataType.simpleString()
    return spark.read.schema(LOOKUPS.replace("entity bigint", f"entity {entity}")).parquet(out)


def score_requests(
    requests: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    log_path: str,
    quarantine_path: str,
    checkpoint: str,
    validate: Callable[[DataFrame], DataFrame] = validate_requests,
) -> None:
    """Score a stream of raw requests: valid ones into the log, the others with the rules they break into a
    quarantine.

    ``score`` takes valid requests to rows of the prediction log. Both sinks have a folder per batch, written
    whole: a batch that is repeated after a failure, whichever of the two writes it had done, leaves both
    as one run would.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = validate(batch).persist()
        try:
            wrong = checked.where(~F.col("valid")).drop("valid")
            wrong.write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
            right = score(checked.where("valid").drop("valid", "violations"))
            right.write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")
        finally:
            checked.unpersist()

    drain(requests, log_path, checkpoint, "append", write)
