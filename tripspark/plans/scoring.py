"""Score a DataFrame of requests with a loaded model, and keep a prediction log.

The reference scored one HTTP request at a time (one-row frame, model loaded per request,
collect, expm1 on the driver). Here requests are a DataFrame of any size: one assembly, one
``transform`` (the model is loaded once per job and shipped to executors), expm1 in the plan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripspark.functions.trip import from_log_target, last_path_segment_of
from tripspark.operators import ml
from tripspark.schema import FEATURE_ORDER, REQUEST_SCHEMA, validate
from tripspark.sources.parquet import write_overwrite

LOG_PARTITIONS = ["model_version", "batch_id"]
LOG_COLUMNS = T.StructType(
    [
        *REQUEST_SCHEMA.fields,
        T.StructField("predicted_duration", T.DoubleType()),
        T.StructField("timeStamp", T.TimestampType()),
        T.StructField("user_id", T.IntegerType()),
    ]
)
LOG_SCHEMA = T.StructType([*LOG_COLUMNS.fields, *[T.StructField(c, T.StringType()) for c in LOG_PARTITIONS]])
_LABEL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def payload_valid() -> Column:
    """Checks the reference left out (it accepts an all-zero payload): all seven inputs present (no null, no NaN), hour
    0-23, month 1-12, weekday 1-7, rate code at least 1, non-negative distance, fee and fare. Never null."""
    ranges = (
        F.col("pickup_hour").between(0, 23)
        & F.col("pickup_month").between(1, 12)
        & F.col("pickup_day_week").between(1, 7)
        & (F.col("RatecodeID") >= 1)
        & (F.col("trip_distance") >= 0)
        & (F.col("Airport_fee") >= 0)
        & (F.col("fare_amount") >= 0)
    )
    return F.coalesce(ml.inputs_present() & ranges, F.lit(False))


def score_requests(requests: DataFrame, model, log_scale: bool = True, keep_columns: list[str] | None = None) -> DataFrame:
    """Requests (the 7 inputs, any extra columns) -> + payload_valid, prediction, predicted_duration.

    No row is dropped: payloads out of range are flagged and scored like the reference would; one with a null or
    NaN input is flagged and has a null prediction.
    """
    req = validate(requests, REQUEST_SCHEMA)
    keep = keep_columns if keep_columns is not None else [c for c in req.columns if c not in FEATURE_ORDER]
    scored = ml.predict_present(req.withColumn("payload_valid", payload_valid()), model)
    minutes = from_log_target("prediction") if log_scale else F.col("prediction")
    return scored.select(
        *FEATURE_ORDER,
        *keep,
        "payload_valid",
        "prediction",
        minutes.alias("predicted_duration"),
    )


def prediction_log_rows(scored: DataFrame, model_path: str, batch_id: str, user_id: int | None = None) -> DataFrame:
    """S10 rows: the 7 inputs, predicted_duration, model_version (last path segment),
    timeStamp (UTC now), user_id, batch_id."""
    return scored.select(
        *FEATURE_ORDER,
        "predicted_duration",
        F.current_timestamp().alias("timeStamp"),
        F.lit(user_id).cast("int").alias("user_id"),
        F.lit(last_path_segment_of(model_path)).alias("model_version"),
        F.lit(batch_id).alias("batch_id"),
    )


def _batch_folder(log_path: str, version: str, batch_id: str) -> str:
    for label in (version, batch_id):
        if not _LABEL.fullmatch(label):
            raise ValueError(f"model version and batch id are letters, digits, '.', '_' and '-': {label!r}")
    return f"{log_path.rstrip('/')}/model_version={version}/batch_id={batch_id}"


def append_prediction_log(scored: DataFrame, log_path: str, model_path: str, batch_id: str, user_id: int | None = None) -> DataFrame:
    """Write a batch to its folder of the log (by model_version, batch_id) and return that batch read back. A re-run
    replaces the batch, also with an empty one; no other folder is listed or touched."""
    version = last_path_segment_of(model_path)
    folder = _batch_folder(log_path, version, batch_id)
    write_overwrite(prediction_log_rows(scored, model_path, batch_id, user_id).drop(*LOG_PARTITIONS), folder)
    return read_batch(scored.sparkSession, log_path, version, batch_id)


def read_batch(spark: SparkSession, log_path: str, version: str, batch_id: str) -> DataFrame:
    """One batch of the log."""
    rows = spark.read.schema(LOG_COLUMNS).parquet(_batch_folder(log_path, version, batch_id))
    return rows.withColumns({"model_version": F.lit(version), "batch_id": F.lit(batch_id)}).select(LOG_SCHEMA.fieldNames())


def read_prediction_log(spark: SparkSession, log_path: str, model_version: str | None = None, batch_id: str | None = None) -> DataFrame:
    """The log; version and batch id are strings, whatever they look like. With either given, only its folders are read (a
    filter on the partition columns)."""
    log = spark.read.schema(LOG_SCHEMA).parquet(log_path)
    for column, value in (("model_version", model_version), ("batch_id", batch_id)):
        if value is not None:
            log = log.filter(F.col(column) == value)
    return log


def requests_frame(spark, records: list[dict] | list[tuple]) -> DataFrame:
    """In-memory request records -> a typed DataFrame (explicit schema, no inference)."""
    rows = [tuple(r[f.name] for f in REQUEST_SCHEMA.fields) if isinstance(r, dict) else tuple(r) for r in records]
    return spark.createDataFrame(rows, REQUEST_SCHEMA)


def requests_from_silver(silver: DataFrame) -> DataFrame:
    """Scoring requests built from silver trips (their 7 inputs + the observed duration)."""
    return silver.select(*[F.col(f.name).cast(f.dataType) for f in REQUEST_SCHEMA.fields], "duration_minutes")
