"""Outlier rules (F1) and the rejected-row audit.

A row is kept when every rule holds; a null operand makes the rule unknown, and the row is
dropped, exactly as a SQL WHERE does. Bounds are parameters.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.fixed import EXCLUDED_RATECODE, MAX_DURATION_MINUTES, MAX_TRIP_DISTANCE
from tripspark.schema import DURATION_COL


@dataclass(frozen=True)
class OutlierRules:
    max_distance: float = MAX_TRIP_DISTANCE
    max_duration_minutes: int = MAX_DURATION_MINUTES
    excluded_ratecode: int = EXCLUDED_RATECODE
    duration_col: str = DURATION_COL

    def rules(self) -> list[tuple[str, Column]]:
        d = F.col(self.duration_col)
        return [
            ("trip_distance_positive", F.col("trip_distance") > 0),
            ("trip_distance_at_most_max", F.col("trip_distance") <= self.max_distance),
            ("passenger_count_positive", F.col("passenger_count") > 0),
            ("duration_positive", d > 0),
            ("fare_amount_positive", F.col("fare_amount") > 0),
            ("total_amount_positive", F.col("total_amount") > 0),
            ("duration_at_most_max", d <= self.max_duration_minutes),
            ("ratecode_not_excluded", F.col("RatecodeID") != self.excluded_ratecode),
        ]

    def predicate(self) -> Column:
        return reduce(lambda a, b: a & b, [c for _, c in self.rules()])


def filter_outliers(df: DataFrame, rules: OutlierRules | None = None) -> DataFrame:
    return df.filter((rules or OutlierRules()).predicate())


def _violated(cond: Column) -> Column:
    # unknown (null) counts as a violation: the filter drops such rows too
    return ~F.coalesce(cond, F.lit(False))


def violated_rules(rules: OutlierRules | None = None) -> Column:
    """Per-row array of the names of the rules a row breaks (empty when kept)."""
    r = rules or OutlierRules()
    return F.array_compact(F.array(*[F.when(_violated(c), F.lit(name)) for name, c in r.rules()]))


def reject_reasons(df: DataFrame, rules: OutlierRules | None = None) -> DataFrame:
    """Rows rejected per rule, plus 'any_rule' and 'kept', from one aggregate pass.

    Output: rule string, n_rows bigint. A row breaking two rules counts under both.
    """
    r = rules or OutlierRules()
    named = r.rules()
    aggs = [F.count_if(_violated(c)).alias(f"r{i}") for i, (_, c) in enumerate(named)]
    aggs.append(F.count_if(_violated(r.predicate())).alias("r_any"))
    aggs.append(F.count_if(F.coalesce(r.predicate(), F.lit(False))).alias("r_kept"))
    totals = df.agg(*aggs)
    entries = [F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("n_rows")) for i, (name, _) in enumerate(named)]
    entries.append(F.struct(F.lit("any_rule").alias("rule"), F.col("r_any").alias("n_rows")))
    entries.append(F.struct(F.lit("kept").alias("rule"), F.col("r_kept").alias("n_rows")))
    return totals.select(F.inline(F.array(*entries)))
