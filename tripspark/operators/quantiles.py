"""Exact quantiles of a numeric column, without a sort and without bringing rows to the driver.

Each round narrows every quantile's bracket: a sketch of the rows inside (``percentile_approx``, mergeable) proposes
two values around the wanted rank, and exact counts decide whether the rank lies between them. A round leaves about
4 / ``ACCURACY`` of the rows of a bracket, whatever their distribution; once a bracket holds few rows, or one value, its values are
counted and the one that reaches the rank is the result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
FEW_ROWS = 100_000


@dataclass
class _Bracket:
    """The wanted value lies in [low, high]; ``below`` rows are smaller than low, ``inside`` rows lie in it."""

    quantile: float
    rank: int
    low: float
    high: float
    below: int
    inside: int

    def holds(self, x: Column) -> Column:
        return x.between(F.lit(self.low), F.lit(self.high))


def discrete_rank(quantile: float, n: int) -> int:
    """The rank (from 1) of the smallest value whose share of rows reaches the quantile."""
    return max(1, n - math.floor(n - quantile * n))


def exact_quantiles(df: DataFrame, column: str, quantiles: list[float], accuracy: int = ACCURACY, few_rows: int = FEW_ROWS) -> DataFrame:
    """``quantile, value``: the values at the discrete quantiles; nulls and NaN are left out, no rows give null values.

    One pass for the range, two per round (2 to 3 rounds at 10**11 rows), one for the values that are left; each is an aggregate over
    the one column."""
    spark = df.sparkSession
    x = F.col(column).cast("double")
    values = df.select(F.nanvl(x, F.lit(None).cast("double")).alias("x")).filter("x IS NOT NULL")
    value = F.col("x")
    whole = values.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).first()  # one row
    if not whole["n"]:
        return spark.createDataFrame([(q, None) for q in quantiles], "quantile double, value double")
    brackets = [_Bracket(q, discrete_rank(q, whole["n"]), whole["low"], whole["high"], 0, whole["n"]) for q in quantiles]
    while True:
        wide = [b for b in brackets if b.low != b.high and b.inside > few_rows]
        if not wide:
            break
        _narrow(values, value, wide, accuracy)
    return _counted(values, value, brackets)


def _narrow(values: DataFrame, x: Column, wide: list[_Bracket], accuracy: int) -> None:
    sketches, counts = [], []
    for i, b in enumerate(wide):
        share = (b.rank - b.below) / b.inside
        around = [max(0.0, share - 2 / accuracy), min(1.0, share + 2 / accuracy)]
        sketches.append(F.percentile_approx(F.when(b.holds(x), x), around, accuracy).alias(f"s{i}"))
    proposed = values.agg(*sketches).first()  # two values a bracket
    cuts = []
    for i, b in enumerate(wide):
        low, high = proposed[f"s{i}"]
        if (low, high) == (b.low, b.high):  # nothing gained: cut the range in two instead
            low = high = b.low + (b.high - b.low) / 2
        cuts.append((low, high))
        below, above = b.holds(x) & (x < low), b.holds(x) & (x > high)
        counts += [F.count_if(below).alias(f"below{i}"), F.count_if(b.holds(x) & x.between(low, high)).alias(f"inside{i}")]
        counts += [F.max(F.when(below, x)).alias(f"largest{i}"), F.min(F.when(above, x)).alias(f"smallest{i}")]
    seen = values.agg(*counts).first()  # four numbers a bracket
    for i, (b, (low, high)) in enumerate(zip(wide, cuts, strict=True)):
        less, middle = seen[f"below{i}"], seen[f"inside{i}"]
        if b.rank <= b.below + less:
            b.high, b.inside = seen[f"largest{i}"], less
        elif b.rank <= b.below + less + middle:
            b.low, b.high, b.below, b.inside = low, high, b.below + less, middle
        else:
            b.low, b.below, b.inside = seen[f"smallest{i}"], b.below + less + middle, b.inside - less - middle


def _counted(values: DataFrame, x: Column, brackets: list[_Bracket]) -> DataFrame:
    """The values inside the brackets counted by value; in each, the first one whose rows reach the rank."""
    shape = "array<struct<quantile: double, rank: bigint, low: double, high: double>>"
    wanted = F.array(*[F.struct(*[F.lit(v) for v in (b.quantile, b.rank - b.below, b.low, b.high)]) for b in brackets]).cast(shape)
    inside = values.filter(reduce(or_, [b.holds(x) for b in brackets])).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    met = inside.select("x", "n", F.inline(F.filter(wanted, lambda b: x.between(b["low"], b["high"]))))
    upto = F.sum("n").over(Window.partitionBy("quantile").orderBy("x"))  # at most FEW_ROWS values a quantile
    return met.withColumn("upto", upto).filter("upto >= rank").groupBy("quantile").agg(F.min("x").alias("value"))
