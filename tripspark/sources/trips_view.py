"""The ``trips`` view: raw-trip-shaped rows derived from the ``events`` table.

The test tables hold no trip file, so trips are projected out of ``events`` with nulls
injected by ``event_id``: one narrow projection over the scan, no shuffle, so it scales with
``events`` and Catalyst prunes it to the columns a query asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.schema import EVENTS_SCHEMA, TRIP_VIEW_SCHEMA, validate
from tripspark.sources.parquet import read_table


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def trips_from_events(events: DataFrame, keep_id: bool = False) -> DataFrame:
    eid = F.col("event_id")
    value = F.col("value")
    shared_null = eid % 7 == 0  # passenger_count, RatecodeID, flag and Airport_fee are null together
    dropoff_seconds = F.floor(value * 60 + 0.5)
    trips = events.select(
        (eid % 2 + 1).cast("int").alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(secs=dropoff_seconds.cast("decimal(18,6)"))).alias("tpep_dropoff_datetime"),
        _null_if(shared_null, (F.col("user_id") % 7).cast("long")).alias("passenger_count"),
        (value * 0.45).alias("trip_distance"),
        F.when(shared_null, F.lit(None).cast("long"))
        .when(eid % 50 == 1, F.lit(99).cast("long"))
        .otherwise((eid % 6 + 1).cast("long"))
        .alias("RatecodeID"),
        F.when(shared_null, F.lit(None).cast("string"))
        .when(eid % 11 == 1, F.lit("Y"))
        .otherwise(F.lit("N"))
        .alias("store_and_fwd_flag"),
        F.col("event_type").alias("payment_type"),
        (value * 1.5 - 1.0).alias("fare_amount"),
        (value * 1.5).alias("total_amount"),
        F.when(shared_null, F.lit(None).cast("double"))
        .when(eid % 13 == 0, F.lit(1.75))
        .otherwise(F.lit(0.0))
        .alias("Airport_fee"),
        _null_if(eid % 40 == 3, F.lit(0.75)).cast("double").alias("cbd_congestion_fee"),
        *(["event_id"] if keep_id else []),
    )
    return validate(trips, TRIP_VIEW_SCHEMA, allow_extra=keep_id)


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/events.parquet", EVENTS_SCHEMA)


def load_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(load_events(spark, sf_dir))
