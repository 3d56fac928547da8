"""Null policy, dedup, profiles on a small frame, and their edges."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tripspark.operators import dedup, nulls, profile
from tripspark.operators.correlation import correlation_long


def test_distinct_removes_repeats(fixture_frame):
    assert fixture_frame.count() == 24
    assert dedup.distinct_rows(fixture_frame).count() == 22


def test_duplicate_report(fixture_frame):
    r = dedup.duplicate_report(fixture_frame, "fx").collect()[0]
    assert (r.table_name, r.n_rows, r.n_distinct, r.n_duplicates) == ("fx", 24, 22, 2)
    once = dedup.duplicate_report(fixture_frame.distinct()).collect()[0]  # decided from the hashes alone
    assert (once.n_rows, once.n_distinct, once.n_duplicates) == (22, 22, 0)
    none = dedup.duplicate_report(fixture_frame.limit(0)).collect()[0]
    assert (none.n_rows, none.n_distinct, none.n_duplicates) == (0, 0, 0)


def test_null_policy_on_the_fixture(fixture_frame):
    rows = fixture_frame.collect()
    plan = nulls.plan_null_policy(fixture_frame)
    assert plan.n_rows == 24
    by_col = {d.column: d for d in plan.decisions}
    tolls = [r.toll for r in rows if r.toll is not None]
    assert by_col["trip"].action == "none"
    assert (by_col["toll"].action, by_col["toll"].null_count, by_col["toll"].null_pct) == ("fill_mean", 6, 25.0)
    assert by_col["toll"].fill_value == sum(tolls) / len(tolls)
    assert (by_col["zone"].action, by_col["zone"].fill_value) == ("fill_mode", "south")
    assert (by_col["weight"].action, by_col["weight"].null_count) == ("drop", 1)
    out = plan.apply(fixture_frame)
    assert out.count() == 23
    assert all(out.filter(F.col(c).isNull()).count() == 0 for c in out.columns)


def test_frozen_plan_on_another_batch(spark):
    """NaN and nulls in columns that had none when planned are filled."""
    first = spark.createDataFrame([(1.0, 2, "a"), (3.0, 5, "b")], "x double, k long, s string")
    plan = nulls.plan_null_policy(first)
    later = spark.createDataFrame([(float("nan"), 1, "a"), (None, None, "b"), (7.0, 4, None)], "x double, k long, s string")
    out = plan.apply(later, planned_on=False).collect()
    assert [(r.x, r.k, r.s) for r in out] == [(2.0, 1, "a"), (2.0, 3, "b"), (7.0, 4, None)]


def test_drop_changes_later_counts(spark):
    # 100 rows: a is null in 3 rows (<5 %: drop), b null in 10 rows of which 2 overlap a's.
    rows = []
    for i in range(100):
        a = None if i < 3 else float(i)
        b = None if 1 <= i <= 10 else i % 4
        rows.append((a, b, "x" if i % 3 else None))
    df = spark.createDataFrame(rows, "a double, b long, s string")
    plan = nulls.plan_null_policy(df)
    d = {x.column: x for x in plan.decisions}
    assert d["a"].action == "drop" and d["a"].null_count == 3
    assert d["b"].null_count == 8  # rows 1, 2 went with a's drop
    assert d["b"].action == "fill_mean"
    alive = [r for r in rows if r[0] is not None]
    bvals = [r[1] for r in alive if r[1] is not None]
    assert d["b"].fill_value == int(sum(bvals) / len(bvals))  # bigint: truncated mean
    assert d["s"].action == "fill_mode" and d["s"].fill_value == "x"
    out = plan.apply(df)
    assert out.count() == 97
    assert out.filter(F.col("b").isNull() | F.col("s").isNull()).count() == 0


def test_mode_tie_goes_to_smallest_and_ignores_null_group(spark):
    rows = [("b",), ("a",), ("b",), ("a",)] + [(None,)] * 6
    df = spark.createDataFrame(rows, "s string")
    out = nulls.fill_mode(df)
    assert sorted(r.s for r in out.collect()) == ["a"] * 8 + ["b"] * 2


def test_nan_counts_as_null(spark):
    rows = [(float("nan"),)] * 3 + [(1.0,), (3.0,)] + [(None,)]
    df = spark.createDataFrame(rows, "x double")
    plan = nulls.plan_null_policy(df)
    (d,) = plan.decisions
    assert d.null_count == 4 and d.action == "fill_mean" and d.fill_value == 2.0
    vals = [r.x for r in plan.apply(df).collect()]
    assert not any(v is None or math.isnan(v) for v in vals)


def test_all_null_column_is_reported_not_filled(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, x double")
    d = {x.column: x for x in nulls.plan_null_policy(df).decisions}
    assert d["x"].action == "unfillable"


def test_timestamp_column_filled_by_mode(spark):
    t1, t2 = dt.datetime(2024, 1, 1, 8, 0), dt.datetime(2024, 1, 2, 9, 30)
    rows = [(t1,), (t2,), (t2,), (None,)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    plan = nulls.plan_null_policy(df)
    (d,) = plan.decisions
    assert d.action == "fill_mode"
    out = [r.t for r in plan.apply(df).collect()]
    assert out.count(t2) == 3


def test_plan_equals_sequential_loop(spark):
    import random

    rnd = random.Random(7)
    rows = []
    for i in range(400):
        rows.append(
            (
                None if rnd.random() < 0.03 else rnd.randint(0, 9),
                None if rnd.random() < 0.2 else rnd.random() * 100,
                None if rnd.random() < 0.04 else rnd.choice(["p", "q", "r"]),
                None if rnd.random() < 0.3 else rnd.randint(-50, 50),
                None if rnd.random() < 0.15 else rnd.choice(["u", "v"]),
            )
        )
    df = spark.createDataFrame(rows, "a int, b double, c string, d long, e string")
    fast = nulls.plan_null_policy(df)
    slow = nulls.plan_null_policy_sequential(df)
    for x, y in zip(fast.decisions, slow.decisions):
        assert (x.column, x.action, x.null_count) == (y.column, y.action, y.null_count)
        if isinstance(x.fill_value, float):
            assert math.isclose(x.fill_value, y.fill_value, rel_tol=1e-12)
        else:
            assert x.fill_value == y.fill_value
    assert sorted(fast.apply(df).collect()) == sorted(slow.apply(df).collect())


def test_many_null_patterns_are_one_plan(spark):
    """5000 rows with as many null patterns as 13 columns give: the same planner, and predicates stay plain columns."""
    names = [f"c{i}" for i in range(13)]
    df = spark.range(5000).selectExpr(*[f"if((shiftright(id, {i}) & 1) = 1, null, cast(id % 7 as double)) as {n}" for i, n in enumerate(names)])
    plan = nulls.plan_null_policy(df)
    assert plan.method == "fixed-point" and plan.nan_columns == frozenset()
    assert [(d.action, d.null_count) for d in plan.decisions] == [(d.action, d.null_count) for d in nulls.plan_null_policy_sequential(df).decisions]


def test_fixed_point_equals_sequential_with_cascading_drops(spark):
    # b is above the threshold until a's drop removes most of its nulls; then c falls below it
    # only after b is dropped: three discovery rounds.
    rows = []
    for i in range(1000):
        a = None if i < 40 else 1.0  # 4 %: dropped
        b = None if i < 70 else float(i % 3)  # 7 %, 3 % once a's rows are gone: dropped
        c = None if 30 <= i < 90 else i % 4  # 6 %, then 2 % after a and b: dropped
        d = None if i % 10 == 0 else i % 5  # fill
        s = None if i % 9 == 0 else ("x" if i % 2 else "y")
        rows.append((a, b, c, d, s))
    df = spark.createDataFrame(rows, "a double, b double, c long, d long, s string")
    fixed = nulls.plan_null_policy(df)
    seq = nulls.plan_null_policy_sequential(df)
    assert fixed.extra["passes"] >= 3
    assert [(d.column, d.action, d.null_count, d.fill_value) for d in fixed.decisions] == [
        (d.column, d.action, d.null_count, d.fill_value) for d in seq.decisions
    ]
    assert [d.action for d in seq.decisions] == ["drop", "drop", "drop", "fill_mean", "fill_mode"]


def test_drop_sparse_nulls(spark):
    rows = [(None if i == 0 else i, None if i < 30 else i) for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b int")
    out = nulls.drop_sparse_nulls(df)
    assert out.count() == 99  # only a (1 %) is sparse


def test_profiles(fixture_frame):
    p = {r.column_name: r for r in profile.null_profile(fixture_frame).collect()}
    assert p["toll"].null_count == 6 and p["toll"].null_pct == 25.0 and p["trip"].null_count == 0
    d = {r.column_name: r for r in profile.describe_numeric(fixture_frame).collect()}
    assert set(d) == {"trip", "toll", "weight"} and d["weight"].n == 23 and d["weight"].min == 10.0 and d["weight"].max == 220.0
    t = {r.column_name: r for r in profile.describe(fixture_frame).collect()}["zone"]
    assert (t.n, t.mean, t.max, t.min_text, t.max_text) == (20, None, None, "north", "south")
    c = profile.profile_columns(fixture_frame).collect()
    assert [r.column_name for r in c] == ["trip", "toll", "zone", "weight"]
    assert c[0].data_type == "bigint" and c[0].n_rows == 24 and c[1].n_non_null == 18


@pytest.mark.parametrize("width", [3, 12, 13, 17, 60])
def test_profiles_have_a_row_per_column_for_any_width_and_without_rows(spark, width):
    df = spark.range(0).selectExpr(*[f"cast(id as double) as c{i}" for i in range(width)])
    for rows, frame in ((0, df), (1, spark.range(1).selectExpr(*[f"cast(id as double) as c{i}" for i in range(width)]))):
        for out in (profile.null_profile(frame), profile.profile_columns(frame), profile.describe_numeric(frame), profile.describe(frame)):
            assert out.count() == width
        assert {r.n_rows for r in profile.profile_columns(frame).collect()} == {rows}
    assert [tuple(r) for r in correlation_long(df.select("c0", "c1")).collect()] == [(a, b, None) for a, b in (("c0", "c0"), ("c0", "c1"), ("c1", "c0"), ("c1", "c1"))]


def test_profiles_in_blocks_equal_one_block(spark):
    rows = [(i, None if i % 3 == 0 else float(i), float("nan") if i == 4 else i * 0.5, "s" if i % 2 else None) for i in range(30)]
    df = spark.createDataFrame(rows, "a long, b double, c double, d string")
    wide = {
        "null": sorted(profile.null_profile(df).collect()),
        "desc": sorted(profile.describe_numeric(df).collect()),
        "cols": sorted(profile.profile_columns(df).collect()),
    }
    for limit in ("2", "20"):  # blocks of one column, then of two
        spark.conf.set("spark.sql.codegen.maxFields", limit)
        try:
            long = {
                "null": sorted(profile.null_profile(df).collect()),
                "desc": sorted(profile.describe_numeric(df).collect()),
                "cols": sorted(profile.profile_columns(df).collect()),
            }
        finally:
            spark.conf.unset("spark.sql.codegen.maxFields")
        assert wide["null"] == long["null"] and wide["cols"] == long["cols"]
        assert len(wide["desc"]) == len(long["desc"]) == 3
        for x, y in zip(wide["desc"], long["desc"]):
            assert x.column_name == y.column_name and x.n == y.n
            for k in ("mean", "stddev", "min", "max"):
                assert (x[k] is None and y[k] is None) or math.isclose(x[k], y[k], rel_tol=1e-12) or (math.isnan(x[k]) and math.isnan(y[k]))


def test_null_profile_blocks(spark):
    cols = ", ".join(f"c{i} {'double' if i % 2 else 'int'}" for i in range(10))
    rows = [tuple((None if (r + i) % (i + 2) == 0 else (float(r) if i % 2 else r)) for i in range(10)) for r in range(25)]
    rows[3] = tuple(float("nan") if i % 2 else v for i, v in enumerate(rows[3]))
    df = spark.createDataFrame(rows, cols)
    wide = sorted(profile.null_profile(df).collect())
    spark.conf.set("spark.sql.codegen.maxFields", "12")  # blocks of 5 columns
    try:
        blocked = sorted(profile.null_profile(df).collect())
    finally:
        spark.conf.unset("spark.sql.codegen.maxFields")
    assert blocked == wide and len(wide) == 10
