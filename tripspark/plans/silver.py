"""Bronze -> silver. Null policy -> full-row distinct -> time features -> outlier rules.

Physical shape: the null policy is planned by one small aggregate (see operators.nulls). The outlier
predicate is row-wise and deterministic, so it commutes with the distinct and is applied first: its terms on plain
columns, and the drop filter, reach the parquet scan. The distinct then shuffles one hash per surviving row
(see operators.dedup); rows are shuffled only where hashes repeat, so a file without duplicates is written
from the scan without any shuffle of its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tripspark.functions.trip import time_feature_columns
from tripspark.operators.dedup import distinct_by_hash, distinct_rows, row_hash
from tripspark.operators.filters import OutlierRules, filter_outliers
from tripspark.operators.nulls import DEFAULT_THRESHOLD_PCT, NullPlan, plan_null_policy
from tripspark.schema import DROPOFF_COL, PICKUP_COL
from tripspark.sources.parquet import read_table, write_overwrite


def add_time_features(df: DataFrame, pickup: str = PICKUP_COL, dropoff: str = DROPOFF_COL, drop_timestamps: bool = True) -> DataFrame:
    """duration_minutes, pickup_hour, pickup_day_week, pickup_month, and the trip's split bucket, computed from
    its times before the two timestamps are dropped."""
    out = df.withColumns(time_feature_columns(pickup, dropoff))
    return out.drop(pickup, dropoff) if drop_timestamps else out


@dataclass
class SilverResult:
    frame: DataFrame
    null_plan: NullPlan


def build_silver(
    raw: DataFrame,
    threshold_pct: float = DEFAULT_THRESHOLD_PCT,
    rules: OutlierRules | None = None,
    null_plan: NullPlan | None = None,
    hash_first: bool = True,
) -> SilverResult:
    """Raw trips -> silver. ``hash_first`` runs the pass over the row hashes now; without it the distinct is part of the plan."""
    plan = null_plan or plan_null_policy(raw, threshold_pct)
    cleaned = plan.apply(raw, planned_on=null_plan is None)
    if not hash_first:
        deduped = distinct_rows(cleaned)  # before the timestamps go: equal trips at other times stay
        return SilverResult(filter_outliers(add_time_features(deduped), rules), plan)
    kept = filter_outliers(add_time_features(cleaned, drop_timestamps=False), rules)
    deduped = distinct_by_hash(kept, row_hash(cleaned.columns))  # the features are functions of the cleaned columns
    return SilverResult(deduped.drop(PICKUP_COL, DROPOFF_COL), plan)


SORTED_ROW_GROUP_BYTES = 32 * 1024 * 1024


def write_silver(
    silver: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    sort_within: list[str] | None = None,
) -> DataFrame:
    """Write silver (overwrite) and return the table read back from storage.

    ``sort_within``: sort each write task's rows by these columns (no shuffle, no skew), so
    parquet row groups get tight min/max statistics and an equality filter on them (e.g. one
    pickup hour) skips most row groups. Directory partitioning by hour would instead multiply
    the file count by 24 and, repartitioned, send a hot hour to one task.
    """
    if sort_within:
        writer = silver.sortWithinPartitions(*sort_within).write.mode("overwrite")
        # several row groups per file, each covering a narrow range of the sort columns
        writer = writer.option("parquet.block.size", str(SORTED_ROW_GROUP_BYTES))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    else:
        write_overwrite(silver, path, partition_by)
    if partition_by:  # partition columns come back last from a partitioned layout
        return read_table(silver.sparkSession, path).select(*silver.columns)
    return silver.sparkSession.read.schema(silver.schema).parquet(path)  # schema known: no footer job
