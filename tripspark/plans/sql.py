"""The analytics in their SQL form (A9, F3): CTEs and a bound parameter over a DataFrame.

``spark.sql`` with DataFrame keyword arguments binds the frame without registering a global
view, and ``args`` binds the parameter marker (no string interpolation of user input). The CTE
is inlined by Catalyst, and the equality on the group key is pushed below the aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AVG_DURATION_BY_HOUR_SQL = """
WITH minutes_of_hour AS (
    SELECT s.pickup_hour AS hour_of_day, s.duration_minutes AS minutes FROM {silver} AS s
)
SELECT hour_of_day AS pickup_hour, avg(minutes) AS avgduration FROM minutes_of_hour GROUP BY hour_of_day
"""

AVG_DURATION_ONE_HOUR_SQL = """
WITH mean_by_hour AS (
    SELECT s.pickup_hour, avg(s.duration_minutes) AS mean_minutes FROM {silver} AS s GROUP BY s.pickup_hour
)
SELECT m.pickup_hour, m.mean_minutes AS avgduration FROM mean_by_hour AS m WHERE m.pickup_hour = :pickup_hour
"""

PAYMENT_ANALYSIS_SQL = """
WITH by_payment AS (
    SELECT s.payment_type AS paid_with, count(1) AS n, avg(s.duration_minutes) AS mean_minutes FROM {silver} AS s GROUP BY s.payment_type
)
SELECT paid_with AS payment_type, n AS total_trips, mean_minutes AS avg_duration FROM by_payment
"""


def avg_duration_by_hour_sql(spark: SparkSession, silver: DataFrame, hour: int | None = None) -> DataFrame:
    """All hours, or one hour when 0 <= hour <= 23 (the reference's range guard)."""
    if hour is None or hour < 0 or hour > 23:
        return spark.sql(AVG_DURATION_BY_HOUR_SQL, silver=silver)
    return spark.sql(AVG_DURATION_ONE_HOUR_SQL, args={"pickup_hour": int(hour)}, silver=silver)


def payment_analysis_sql(spark: SparkSession, silver: DataFrame) -> DataFrame:
    return spark.sql(PAYMENT_ANALYSIS_SQL, silver=silver)
