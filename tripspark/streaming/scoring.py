"""Streaming scoring of landed trip files.

file source (declared schema) -> frozen null plan (drop columns, modes and a mean for every numeric column, decided on a
batch: the policy is a whole-table operator and cannot be computed on an unbounded stream) ->
optional dedup within a watermark -> time features -> outlier rules -> model -> parquet sink.
The checkpoint makes the sink exactly-once across restarts and lost executors: a restarted
query resumes at the first unprocessed file.

Dedup (``dedup_within``) is off by default. A global distinct needs unbounded state on a
stream; the bounded form keeps each trip for ``dedup_within`` of event time. Spark drops rows
that arrive later than the watermark (event time older than the newest pickup seen minus the
window) from a deduplicating stream, so enable it only when arrival delay is bounded by the
window; without it the stream is stateless and never discards a row.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripspark.functions.trip import from_log_target
from tripspark.operators import ml
from tripspark.operators.filters import OutlierRules, filter_outliers
from tripspark.operators.nulls import NullPlan
from tripspark.plans.silver import add_time_features
from tripspark.schema import DURATION_COL, FEATURE_ORDER, PICKUP_COL


EVENT_TIME = "_event_time"
DEFAULT_MAX_FILES_PER_TRIGGER = 1000


def scored_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    null_plan: NullPlan,
    model,
    rules: OutlierRules | None = None,
    dedup_within: str | None = None,
    max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """The scored stream. ``max_files_per_trigger`` bounds each micro-batch, so a backlog of
    landed files is drained in several bounded batches (availableNow honours it) rather than
    one batch the size of the backlog."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(source_dir)
    cleaned = null_plan.apply(raw, planned_on=False)  # later files may hold a null or NaN in any column
    if dedup_within:
        # watermarks need TIMESTAMP; a timestamp copy of the pickup time drives state eviction only
        key = list(cleaned.columns)
        cleaned = (
            cleaned.withColumn(EVENT_TIME, F.col(PICKUP_COL).cast("timestamp"))
            .withWatermark(EVENT_TIME, dedup_within)
            .dropDuplicatesWithinWatermark(key)
            .drop(EVENT_TIME)
        )
    silver = filter_outliers(add_time_features(cleaned), rules)
    scored = ml.predict_present(silver.select(*FEATURE_ORDER, DURATION_COL, "payment_type"), model)
    return scored.select(
        *FEATURE_ORDER,
        DURATION_COL,
        "payment_type",
        "inputs_present",
        from_log_target("prediction").alias("predicted_duration"),
        F.current_timestamp().alias("scored_at"),
    )


def start_stream_scoring(
    stream: DataFrame,
    sink_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start the parquet sink. ``state_partitions``: partitions of the dedup state; Spark fixes
    this number in the checkpoint when the query first starts (AQE does not resize streaming
    state), so size it for the state, not for the session's batch default."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).outputMode("append")
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    if state_partitions is None:
        return writer.start(sink_dir)
    conf = stream.sparkSession.conf
    previous = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return writer.start(sink_dir)
    finally:
        conf.set("spark.sql.shuffle.partitions", previous)


def run_until_drained(stream: DataFrame, sink_dir: str, checkpoint_dir: str, state_partitions: int | None = None) -> DataFrame:
    """availableNow: process every file present, stop, and return the sink as a batch table."""
    return drain(stream, sink_dir, checkpoint_dir, state_partitions).table


@dataclass(frozen=True)
class DrainedStream:
    """The sink after a run, and what the run's micro-batches counted: rows read, and rows that the watermark dropped as late."""

    table: DataFrame
    n_read: int
    n_late: int


def drain(stream: DataFrame, sink_dir: str, checkpoint_dir: str, state_partitions: int | None = None) -> DrainedStream:
    """availableNow: process every file present and stop. A deduplicating stream drops rows later than its watermark; they are counted,
    so a caller can tell that the window was too short."""
    q = start_stream_scoring(stream, sink_dir, checkpoint_dir, available_now=True, state_partitions=state_partitions)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    progress = [json.loads(p.json) for p in q.recentProgress]
    late = sum(state.get("numRowsDroppedByWatermark", 0) for p in progress for state in p.get("stateOperators", []))
    # the schema is known: a sink without files yet is an empty table
    table = stream.sparkSession.read.schema(stream.schema).parquet(sink_dir)
    return DrainedStream(table, sum(p.get("numInputRows", 0) for p in progress), late)
