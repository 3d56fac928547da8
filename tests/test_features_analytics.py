"""Time features, flag encoding, outlier rules, grouped analytics, correlation."""

import datetime as dt


from tripspark.functions.trip import duration_minutes, encode_flag, last_path_segment, last_path_segment_of
from tripspark.operators import aggregates
from tripspark.operators.correlation import correlation_long, correlation_wide
from tripspark.operators.filters import filter_outliers, reject_reasons, violated_rules
from tripspark.operators.histogram import approx_quantiles, histogram
from tripspark.plans.silver import add_time_features


def test_duration_truncates_toward_zero(spark):
    base = dt.datetime(2024, 1, 7, 23, 0, 0)
    rows = [
        (base, base + dt.timedelta(minutes=2, seconds=59, microseconds=900000)),
        (base, base - dt.timedelta(minutes=1, seconds=59)),
    ]
    df = spark.createDataFrame(rows, "p timestamp_ntz, d timestamp_ntz")
    assert [r.m for r in df.select(duration_minutes("p", "d").alias("m")).collect()] == [2, -1]


def test_time_features(spark):
    p = dt.datetime(2024, 1, 7, 23, 10, 0)  # a Sunday
    df = spark.createDataFrame([(p, p + dt.timedelta(minutes=75))], "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz")
    r = add_time_features(df).collect()[0]
    assert (r.duration_minutes, r.pickup_hour, r.pickup_day_week, r.pickup_month) == (75, 23, 1, 1)
    assert "tpep_pickup_datetime" not in r.asDict()


def test_encode_flag(spark):
    df = spark.createDataFrame([("N",), ("Y",), ("x",), (None,)], "f string")
    assert [r.e for r in df.select(encode_flag("f").alias("e")).collect()] == [0, 1, None, None]


def test_last_path_segment(spark):
    df = spark.createDataFrame([("/lake/models/gbt_duration_minutes_v1",), ("a/b/",)], "p string")
    assert [r.s for r in df.select(last_path_segment("p").alias("s")).collect()] == ["gbt_duration_minutes_v1", "b"]
    assert last_path_segment_of("/lake/models/gbt_duration_minutes_v1") == "gbt_duration_minutes_v1"


def _trip(dist=1.0, pc=1, dur=10, fare=5.0, total=6.0, rc=1):
    return (dist, pc, dur, fare, total, rc)


def test_outlier_rules_and_reasons(spark):
    rows = [
        _trip(),
        _trip(dist=0.0),
        _trip(dist=201.0),
        _trip(pc=0),
        _trip(pc=None),
        _trip(dur=0),
        _trip(dur=241),
        _trip(fare=-1.0),
        _trip(total=0.0),
        _trip(rc=99),
        _trip(dist=200.0, dur=240),
    ]
    df = spark.createDataFrame(rows, "trip_distance double, passenger_count long, duration_minutes int, fare_amount double, total_amount double, RatecodeID long")
    assert filter_outliers(df).count() == 2
    reasons = {r.rule: r.n_rows for r in reject_reasons(df).collect()}
    assert reasons["passenger_count_positive"] == 2  # 0 and null
    assert reasons["any_rule"] == 9 and reasons["kept"] == 2
    per_row = df.select(violated_rules().alias("v")).collect()
    assert per_row[0].v == [] and per_row[9].v == ["ratecode_not_excluded"]


def _silver_like(spark):
    rows = [(h, d, pt, flag) for h, d, pt, flag in [(0, 10, "a", 0), (0, 20, "b", 1), (8, 30, "a", 0), (8, 50, "a", 0), (9, 7, "b", 1)]]
    return spark.createDataFrame(rows, "pickup_hour int, duration_minutes int, payment_type string, store_and_fwd_flag int")


def test_grouped_analytics(spark):
    s = _silver_like(spark)
    by_hour = {r.pickup_hour: r.avgduration for r in aggregates.avg_duration_by_hour(s).collect()}
    assert by_hour == {0: 15.0, 8: 40.0, 9: 7.0}
    assert [tuple(r) for r in aggregates.avg_duration_for_hour(s, 8).collect()] == [(8, 40.0)]
    assert aggregates.avg_duration_for_hour(s, 24).count() == 3  # out of range: every hour
    assert aggregates.avg_duration_for_hour(s, -1).count() == 3
    pay = {r.payment_type: (r.total_trips, r.avg_duration) for r in aggregates.payment_analysis(s).collect()}
    assert pay == {"a": (3, 30.0), "b": (2, 13.5)}
    cats = aggregates.avg_duration_by_category(s, ["pickup_hour", "payment_type"]).collect()
    got = {(r.category, r.category_value): (r.n_trips, r.avg_duration) for r in cats}
    assert got[("pickup_hour", "8")] == (2, 40.0) and got[("payment_type", "b")] == (2, 13.5)
    assert len(got) == 5


def test_sql_forms_match_dataframe_forms(spark):
    from tripspark.plans import sql as sqlforms

    s = _silver_like(spark)
    assert sorted(sqlforms.avg_duration_by_hour_sql(spark, s, 8).collect()) == sorted(aggregates.avg_duration_for_hour(s, 8).collect())
    assert sorted(sqlforms.avg_duration_by_hour_sql(spark, s, 30).collect()) == sorted(aggregates.avg_duration_by_hour(s).collect())
    assert sorted(sqlforms.payment_analysis_sql(spark, s).collect()) == sorted(aggregates.payment_analysis(s).collect())


def test_correlation(spark):
    rows = [(float(i), 2.0 * i + 1, 5.0, None if i == 3 else -float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "x double, y double, c double, z double")
    long = {(r.feature1, r.feature2): r.corr_value for r in correlation_long(df).collect()}
    assert len(long) == 16
    assert abs(long[("x", "y")] - 1.0) < 1e-12 and long[("x", "y")] == long[("y", "x")]
    assert long[("c", "x")] is None and long[("c", "c")] is None  # constant column
    assert abs(long[("x", "z")] + 1.0) < 1e-12  # pairwise-complete
    wide = {r.feature1: r for r in correlation_wide(df).collect()}
    assert abs(wide["x"]["y"] - 1.0) < 1e-12


def test_histogram_and_quantiles(spark):
    df = spark.createDataFrame([(i,) for i in range(20)] + [(None,)], "d int")
    h = {r.bucket_start: r.n_rows for r in histogram(df, "d", 5.0).collect()}
    assert h == {0.0: 5, 5.0: 5, 10.0: 5, 15.0: 5}
    q = {r.probability: r.value for r in approx_quantiles(df, "d", [0.5, 1.0]).collect()}
    assert q[1.0] == 19.0 and 8.0 <= q[0.5] <= 10.0


def test_results_do_not_depend_on_session_time_zone(spark):
    from conftest import SF001
    from tripspark.catalog import silver_plan

    def run():
        s = silver_plan(spark, SF001)
        return sorted(aggregates.avg_duration_by_hour(s).collect()), s.count()

    utc = run()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other


def test_results_do_not_depend_on_ansi_mode(spark):
    from conftest import SF001
    from tripspark.catalog import SILVER_NUMERIC, silver_plan, trips
    from tripspark.operators import nulls

    def run():
        s = silver_plan(spark, SF001).withColumn("store_and_fwd_flag", encode_flag("store_and_fwd_flag"))
        corr = sorted(correlation_long(s, SILVER_NUMERIC).collect())
        plan = nulls.plan_null_policy(trips(spark, SF001))
        return corr, [(d.column, d.action, d.fill_value) for d in plan.decisions], s.count()

    on = run()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        off = run()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert on == off


def test_correlation_block_size_does_not_change_the_result(spark):
    rows = [(float(i), 2.0 * i + (i % 3), 5.0, None if i % 4 == 0 else -float(i * i), i % 7) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, y double, c double, z double, k int")
    results = [
        sorted(correlation_long(df, pairs_per_block=m).collect(), key=lambda r: (r.feature1, r.feature2)) for m in (1, 4, 100)
    ]
    for other in results[1:]:
        assert [(r.feature1, r.feature2) for r in other] == [(r.feature1, r.feature2) for r in results[0]]
        for a, b in zip(results[0], other):
            assert (a.corr_value is None and b.corr_value is None) or abs(a.corr_value - b.corr_value) < 1e-12
