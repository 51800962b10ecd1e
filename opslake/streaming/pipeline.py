"""Streaming telemetry: source, parsing, windows, alerts, state and sinks.

Every transformation is the batch operator of the same name applied to a stream; only sources,
sinks, watermarks and keyed state live here.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from opslake import schemas
from opslake.operators import marts, scoring, telemetry as tel
from opslake.sources.files import parse_telemetry

# Watermark delay, trigger, retries.
WATERMARK = "10 seconds"
TRIGGER = "10 seconds"
MAX_ATTEMPTS = 3


def kafka_lines(spark: SparkSession, servers: str, topic: str, from_start: bool = False) -> DataFrame:
    """Messages of a topic. Needs the Kafka connector on the class path; not exercised in the tests."""
    return spark.readStream.format("kafka").options(**{
        "kafka.bootstrap.servers": servers, "subscribe": topic,
        "startingOffsets": "earliest" if from_start else "latest", "failOnDataLoss": "false",
    }).load().select("value")


def file_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of files appearing in a folder: the same shape as the topic, for files and tests."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def parsed(lines: DataFrame) -> DataFrame:
    """Well-formed readings of a stream."""
    return parse_telemetry(lines).where(~F.col("malformed")).drop("raw", "malformed")


def with_watermark(stream: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return stream.withWatermark("event_time", delay)


def minute_aggregates(stream: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return tel.minute_aggregates(with_watermark(stream, delay))


def sliding_anomaly_counts(stream: DataFrame, as_of: str, delay: str = WATERMARK) -> DataFrame:
    return tel.sliding_anomaly_counts(scoring.score_telemetry(with_watermark(stream, delay), as_of))


def threshold_alerts(stream: DataFrame, as_of: str) -> DataFrame:
    return scoring.build_alerts(scoring.score_telemetry(stream, as_of), as_of)


def enrich(stream: DataFrame, dim: DataFrame) -> DataFrame:
    return marts.enrich(stream, dim)


def dedup(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    return stream.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])


def start(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_by: list[str] | None = None,
          available_now: bool = False, trigger: str = TRIGGER, mode: str = "append") -> StreamingQuery:
    """Checkpointed file sink. The sink's commit log makes a restarted query add nothing twice."""
    writer = df.writeStream.format(fmt).outputMode(mode).option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()


def run_available(df: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Process everything there is and stop."""
    query = start(df, path, checkpoint, available_now=True, **options)
    query.awaitTermination()
    return query


def for_each_batch(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None],
                   available_now: bool = True, trigger: str = TRIGGER, mode: str = "append") -> StreamingQuery:
    writer = df.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()
    if available_now:
        query.awaitTermination()
    return query


def one_sink(path: str) -> Callable:
    """Batch handler that gives each micro-batch a ``batch_id`` partition, which a repeat overwrites."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    return write


def two_sinks(first: str, second: str, second_view: Callable[[DataFrame], DataFrame]) -> Callable:
    """Batch handler: one read, two tables.

    Delivery is at least once, so each micro-batch owns a ``batch_id`` partition that a repeat
    overwrites. An empty batch writes nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            if kept.isEmpty():
                return
            for frame, path in ((kept, first), (second_view(kept), second)):
                frame.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
        finally:
            kept.unpersist()

    return write


def route_attempts(tasks: DataFrame, failed, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """``outcome`` of every delivery: ok, retry with the attempt raised, or dead after the last one."""
    bad = F.coalesce(failed, F.lit(True))
    return tasks.withColumn("outcome", F.when(~bad, "ok").when(F.col("attempt") < max_attempts, "retry").otherwise(
        "dead")).withColumn("attempt", F.when(F.col("outcome") == "retry", F.col("attempt") + 1).otherwise(
            F.col("attempt")))


def dead_letter(paths: dict[str, str], failed, max_attempts: int = MAX_ATTEMPTS) -> Callable:
    """Batch handler that writes ok, retry and dead rows to their own tables."""
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = route_attempts(batch, failed, max_attempts).persist()
        try:
            for outcome, path in paths.items():
                kept.where(F.col("outcome") == outcome).withColumn("batch_id", F.lit(batch_id)).write.mode(
                    "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
        finally:
            kept.unpersist()

    return write


def consumers(events: DataFrame) -> dict[str, DataFrame]:
    """Three independent views of one topic: counts by type, new document ids, notification texts."""
    return {
        "analytics": events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events")),
        "ingestion": events.select("document_id").distinct(),
        "notification": events.select(
            "document_id", F.concat(F.col("user"), F.lit(" uploaded "), F.col("filename")).alias("message")),
    }


def log_lines(lines: DataFrame) -> DataFrame:
    """Log records from JSON lines, with event time and service; unreadable lines are left out."""
    record = F.from_json(F.col("value").cast("string"), schemas.LOG_LINE).alias("r")
    return lines.select(record).select(
        F.try_to_timestamp("r.timestamp").alias("event_time"), "r.service", "r.level", "r.message"
    ).where(F.col("event_time").isNotNull())


def late_rows(query: StreamingQuery) -> int:
    """Rows that reached the state behind the watermark and were dropped.

    In a windowed count these are partial aggregates, one per late window and key. A query keeps the progress of its last
    micro-batches only; where older ones may be gone the sum would be too small, so that is an error.
    """
    kept = int(SparkSession.getActiveSession().conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(query.recentProgress) >= kept:
        raise RuntimeError("progress is incomplete: raise spark.sql.streaming.numRecentProgressUpdates")
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress
               for s in json.loads(p.json if isinstance(p.json, str) else json.dumps(p))["stateOperators"])


def session_history(messages: DataFrame, keep: int = 50, idle_seconds: int = 3600) -> DataFrame:
    """Last messages per session on a stream; a session is forgotten after the idle limit.

    Idle time is event time (``created_at``), so a replay forgets the same sessions. State holds at
    most ``keep`` messages per session, so a hot session costs no more than that.
    """
    def remember(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        stored, last = json.loads(state.get[0]) if state.exists else ([], 0)
        for frame in frames:
            last = max(last, int(frame["created_at"].max().timestamp() * 1000))
            fresh = frame.sort_values("turn").tail(keep)
            stored.extend([int(t), r, c] for t, r, c in zip(fresh["turn"], fresh["role"], fresh["content"]))
            stored = sorted(stored)[-keep:]
        body = json.dumps(stored, ensure_ascii=False)
        state.update((json.dumps([stored, last], ensure_ascii=False),))
        state.setTimeoutTimestamp(max(last + idle_seconds * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"session_id": [key[0]], "messages": [len(stored)], "first_turn": [stored[0][0]],
                            "last_turn": [stored[-1][0]], "history": [body]})

    return messages.withWatermark("created_at", WATERMARK).groupBy("session_id").applyInPandasWithState(
        remember, "session_id string, messages long, first_turn long, last_turn long, history string", "body string",
        "Update", GroupStateTimeout.EventTimeTimeout)


def consecutive_breaches(stream: DataFrame, metric: str = "temperature", limit: float = 95.0, k: int = 3) -> DataFrame:
    """Streaming form of the consecutive-breach match: state is the length of the current run."""
    columns = ["event_id", "device_id", "event_time", metric, "run_length"]

    def follow(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # The rows of a micro-batch come in any order, so they are ordered before the run goes on.
        frame = pd.concat(list(frames)).sort_values(["event_time", "event_id"])
        before = int(state.get[0]) if state.exists else 0
        breach = frame[metric] > limit
        block = (~breach).cumsum()
        length = breach.astype("int64").groupby(block).cumsum() + before * ((block == 0) & breach).astype("int64")
        state.update((int(length.iloc[-1]),))
        yield frame.assign(device_id=key[0], run_length=length)[length >= k][columns]

    return stream.groupBy("device_id").applyInPandasWithState(
        follow, f"event_id long, device_id string, event_time timestamp, {metric} double, run_length long", "length long",
        "Append", GroupStateTimeout.NoTimeout)
