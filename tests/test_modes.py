"""The mode from a summary of frequent values and exact counts, against counting everything."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripspark.operators import nulls

KINDS = "s string, l long, d double, b boolean, day date, t timestamp_ntz, m decimal(12,2)"


def brute(rows, column):
    counts = Counter(r[column] for r in rows if r[column] is not None)
    return min(counts, key=lambda v: (-counts[v], v)) if counts else None


def modes_of(spark, rows, schema, drops=()):
    df = spark.createDataFrame(rows, schema).repartition(4)
    got = nulls.column_modes(df, [(c, list(drops)) for c in df.columns])
    want = spark.createDataFrame([tuple(brute(rows, i) for i in range(len(df.columns)))], schema)
    return got, want.select(*[F.col(c).cast("string") for c in want.columns]).collect()[0].asDict()


@pytest.mark.parametrize("distinct", [1, 3, 50, 20000])
def test_every_type_from_few_values_to_unique(spark, distinct):
    rng = random.Random(distinct)
    start = dt.datetime(2024, 1, 1, 5, 30)
    rows = []
    for _ in range(20000):
        k = rng.randrange(distinct)
        rows.append((f"v{k}", k, k / 7, k % 2 == 0, dt.date(2020, 1, 1) + dt.timedelta(days=k % 3000), start + dt.timedelta(seconds=k), None if k % 5 == 0 and distinct > 1 else k))
    schema = KINDS.replace("m decimal(12,2)", "m int")
    got, want = modes_of(spark, rows, schema)
    assert got == want


def test_ties_go_to_the_smallest_value(spark):
    unique = [(f"k{i:05}", float(i)) for i in range(9000)]  # more values than the summary follows, all once
    got, want = modes_of(spark, unique, "s string, d double")
    assert got == want == {"s": "k00000", "d": "0.0"}
    twice = unique + [("k08000", 8000.0), ("k07000", 7000.0)]
    got, want = modes_of(spark, twice, "s string, d double")
    assert got == want == {"s": "k07000", "d": "7000.0"}


def test_one_frequent_value_needs_no_count_of_all(spark, monkeypatch):
    rows = [(f"k{i}",) for i in range(9000)] + [("hot",)] * 4500
    calls = []
    exact = nulls._exact_modes
    monkeypatch.setattr(nulls, "_exact_modes", lambda df, targets: calls.append(targets) or exact(df, targets))
    got, want = modes_of(spark, rows, "s string")
    assert got == want == {"s": "hot"} and len(calls) == 1
    calls.clear()
    got, want = modes_of(spark, rows[:9000], "s string")
    assert got == want and len(calls) == 2


def test_nulls_zeros_drops_and_empty(spark):
    rows = [(None, -0.0), ("a", 0.0), ("a", 1.0), ("b", 1.0), ("b", 0.0), ("b", None)]
    df = spark.createDataFrame(rows, "s string, d double")
    assert nulls.column_modes(df, [("s", []), ("d", [])])["s"] == "b"
    assert float(nulls.column_modes(df, [("d", [])])["d"]) == 0.0  # three zeros of either sign
    assert nulls.column_modes(df, [("s", ["d"]), ("d", ["s"])]) == {"s": "a", "d": "0.0"}
    assert nulls.column_modes(df.limit(0), [("s", [])]) == {"s": None}
    assert nulls.column_modes(df.select(F.lit(None).cast("string").alias("s")), [("s", [])]) == {"s": None}
    assert nulls.column_modes(df, []) == {}
