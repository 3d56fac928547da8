"""A6 / A7 kept up to date: partial aggregates of silver, by landed batch.

The grouped answers are means and counts, whose partials (sum, count) merge. The store holds them by key and batch of silver, a
folder per batch, so a refresh reads only the batches that it does not hold yet, a repeated refresh replaces its own folder, and an answer
reads a few rows a batch and never silver. A batch that was replaced in silver is recomputed by naming it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.schema import DURATION_COL
from tripspark.sources import files
from tripspark.sources.parquet import write_partitions

BATCH = "landed_batch"
KEYS = ["pickup_hour", "payment_type"]
STORED = f"pickup_hour int, payment_type string, n_trips long, n_durations long, sum_duration long, {BATCH} int"


def partials(silver: DataFrame) -> DataFrame:
    """Mergeable partials by key and batch: trips, known durations and their sum (whole minutes, exact)."""
    return silver.groupBy(*KEYS, BATCH).agg(
        F.count(F.lit(1)).alias("n_trips"),
        F.count(DURATION_COL).alias("n_durations"),
        F.coalesce(F.sum(F.col(DURATION_COL).cast("long")), F.lit(0)).alias("sum_duration"),
    )


def refresh(spark: SparkSession, silver: str, store: str, replaced: list[int] | None = None) -> list[int]:
    """Add the batches of silver that the store lacks, and recompute those ``replaced``; returns the batches read."""
    held = set(files.partition_values(spark, store, BATCH))
    wanted = [int(b) for b in files.partition_values(spark, silver, BATCH) if b not in held or int(b) in (replaced or [])]
    if wanted:
        new = spark.read.parquet(silver).filter(F.col(BATCH).isin(wanted))  # only these folders are read
        write_partitions(partials(new).coalesce(1), store, [BATCH])  # hours x payment types rows a batch
    return sorted(wanted)


def _merged(spark: SparkSession, store: str, key: str) -> DataFrame:
    mean = F.try_divide(F.sum("sum_duration").cast("double"), F.sum("n_durations").cast("double"))
    return spark.read.schema(STORED).parquet(store).groupBy(key).agg(F.sum("n_trips").alias("total_trips"), mean.alias("avg_duration"))


def avg_duration_by_hour(spark: SparkSession, store: str) -> DataFrame:
    """A6 from the store."""
    return _merged(spark, store, "pickup_hour").select("pickup_hour", F.col("avg_duration").alias("avgduration"))


def payment_analysis(spark: SparkSession, store: str) -> DataFrame:
    """A7 from the store."""
    return _merged(spark, store, "payment_type").select("payment_type", "total_trips", "avg_duration")
