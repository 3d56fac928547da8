"""Grouped analytics over silver trips.

All are hash aggregates with a partial (map-side) step, so a hot key (one hour holding a third
of the trips) is collapsed inside each map task before the shuffle: the exchange carries at
most one row per key per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.fixed import CATEGORY_COLUMNS
from tripspark.schema import DURATION_COL

HOURS = range(0, 24)


def avg_duration_by(df: DataFrame, key: str, duration_col: str = DURATION_COL, alias: str = "avg_duration") -> DataFrame:
    """Mean duration per value of ``key``, ordered by the key."""
    return df.groupBy(key).agg(F.avg(duration_col).alias(alias)).orderBy(key)


def avg_duration_by_hour(df: DataFrame, duration_col: str = DURATION_COL) -> DataFrame:
    """pickup_hour, avgduration (no order, like the reference's CTE)."""
    return df.groupBy("pickup_hour").agg(F.avg(duration_col).alias("avgduration"))


def avg_duration_for_hour(df: DataFrame, hour: int, duration_col: str = DURATION_COL) -> DataFrame:
    """One hour when 0 <= hour <= 23, else every hour (the reference's range guard).

    The equality on the group key sits outside the aggregate; Catalyst pushes it below the
    partial aggregate and into the scan.
    """
    by_hour = avg_duration_by_hour(df, duration_col)
    if hour < 0 or hour > 23:
        return by_hour
    return by_hour.filter(F.col("pickup_hour") == F.lit(hour))


def payment_analysis(df: DataFrame, duration_col: str = DURATION_COL) -> DataFrame:
    """payment_type, total_trips, avg_duration."""
    return df.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.avg(duration_col).alias("avg_duration"),
    )


def avg_duration_by_category(
    df: DataFrame,
    categories: tuple[str, ...] | list[str] = CATEGORY_COLUMNS,
    duration_col: str = DURATION_COL,
) -> DataFrame:
    """Every category column in one job (GROUPING SETS: one scan, one shuffle).

    Output: category (column name), category_value (string form of the key), n_trips,
    avg_duration.
    """
    cats = list(categories)
    grouped = df.groupingSets([[c] for c in cats], *cats).agg(
        *[F.grouping(c).alias(f"_g_{i}") for i, c in enumerate(cats)],
        F.count(F.lit(1)).alias("n_trips"),
        F.avg(duration_col).alias("avg_duration"),
    )
    category = F.coalesce(*[F.when(F.col(f"_g_{i}") == 0, F.lit(c)) for i, c in enumerate(cats)])
    value = F.coalesce(*[F.when(F.col(f"_g_{i}") == 0, F.col(c).cast("string")) for i, c in enumerate(cats)])
    return grouped.select(
        category.alias("category"),
        value.alias("category_value"),
        F.col("n_trips"),
        F.col("avg_duration"),
    )
