"""Seeded ML reproducibility, metric definitions, model round trip, scoring, log, stream = batch."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from conftest import SF001
from tripspark.catalog import saved_model, silver, trained
from tripspark.functions.trip import key_bucket
from tripspark.operators import ml
from tripspark.plans import scoring, training
from tripspark.plans.training import model_frame, train_duration_model
from tripspark.schema import FEATURE_ORDER, SPLIT_COL


@pytest.fixture(scope="module")
def silver001(spark):
    return silver(spark, SF001)


def test_metrics_equal_evaluator(spark, silver001):
    tm = trained(spark, SF001, "gbt")
    m = {r.metric: r.value for r in tm.metrics().collect()}
    p = tm.predictions
    r2 = RegressionEvaluator(labelCol="duration_log", predictionCol="prediction", metricName="r2").evaluate(p)
    mae = RegressionEvaluator(labelCol="duration_minutes", predictionCol="predicted_minutes", metricName="mae").evaluate(p)
    assert m["r2"] == pytest.approx(r2, rel=1e-12)
    assert m["mae_minutes"] == pytest.approx(mae, rel=1e-12)


@pytest.mark.parametrize("kind", ["rf", "gbt"])
def test_seeded_training_is_reproducible(spark, silver001, kind):
    a = {r.metric: r.value for r in train_duration_model(silver001, kind).metrics().collect()}
    b = {r.metric: r.value for r in train_duration_model(silver001, kind).metrics().collect()}
    assert a == b


def test_hash_split_is_stable_under_repartitioning(spark, silver001):
    cols = ["trip_distance", "fare_amount", "duration_minutes"]
    flag = ml.hash_split_flag(cols)
    a = sorted(silver001.filter(flag).select(*cols).collect())
    b = sorted(silver001.repartition(7).filter(flag).select(*cols).collect())
    assert a == b
    n, k = silver001.count(), len(a)
    assert 0.6 < k / n < 0.8


def test_key_split_fraction(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    share = ev.select((ml.key_split_label("event_id") == "train").cast("int").alias("t")).agg(F.avg("t")).collect()[0][0]
    assert 0.65 < share < 0.75


def test_model_roundtrip_same_predictions(spark):
    from tripspark.catalog import q_model_roundtrip

    out = q_model_roundtrip(spark, SF001)
    assert out.count() > 0
    assert out.filter(~F.col("same_prediction")).count() == 0


def test_score_requests_and_payload_flag(spark):
    model, _ = saved_model(spark, SF001, "gbt")
    reqs = spark.createDataFrame(
        [(6.4, 9, 11, 1.75, 3, 2, 31.2), (0.0, 0, 0, 0.0, 0, 0, 0.0), (6.4, 9, 11, None, 3, 2, 31.2), (float("nan"), 9, 11, 1.75, 3, 2, 31.2), (None,) * 7],
        "trip_distance double, pickup_hour int, pickup_month int, Airport_fee double, pickup_day_week int, RateCodeID long, fare_amount double",
    )
    out = scoring.score_requests(reqs, model).collect()
    assert [r.payload_valid for r in out] == [True, False, False, False, False]  # all-zero payload flagged, still scored
    assert [r.predicted_duration is not None for r in out] == [True, True, False, False, False]
    assert out[2].Airport_fee is None and out[2].trip_distance == 6.4  # inputs as given
    assert out[0].predicted_duration == pytest.approx(2.718281828459045 ** out[0].prediction - 1)


def test_prediction_log_is_idempotent(spark, tmp_path):
    model, path = saved_model(spark, SF001, "gbt")
    scored = scoring.score_requests(scoring.requests_from_silver(silver(spark, SF001)), model)
    log = str(tmp_path / "log")
    first = scoring.append_prediction_log(scored, log, path, "b1", user_id=7).count()
    again = scoring.append_prediction_log(scored, log, path, "b1", user_id=7).count()
    other = scoring.append_prediction_log(scored, log, path, "b2", user_id=7).count()
    assert first == again == other
    total = spark.read.parquet(log)
    assert total.count() == 2 * first
    assert total.select("model_version").distinct().collect()[0][0] == "gbt_duration_minutes_v1"


def test_prediction_log_keeps_batches_apart(spark, tmp_path):
    model, path = saved_model(spark, SF001, "gbt")
    scored = scoring.score_requests(scoring.requests_from_silver(silver(spark, SF001)), model)
    log = str(tmp_path / "log")
    for n, batch in enumerate(("1", "01", "2026-01-01", "x"), 1):
        got = scoring.append_prediction_log(scored.limit(n), log, path, batch)
        assert got.count() == n and got.schema["batch_id"].dataType.simpleString() == "string"
        assert {r.batch_id for r in got.collect()} == {batch}
    assert scoring.read_batch(spark, log, "gbt_duration_minutes_v1", "1").count() == 1
    assert {(r.batch_id, r["count"]) for r in scoring.read_prediction_log(spark, log).groupBy("batch_id").count().collect()} == {("1", 1), ("01", 2), ("2026-01-01", 3), ("x", 4)}
    assert scoring.append_prediction_log(scored.limit(0), log, path, "x").count() == 0  # an empty re-run replaces too
    with pytest.raises(ValueError, match="batch id"):
        scoring.append_prediction_log(scored, log, path, "a/b")


def test_equal_rows_fall_on_both_sides(spark):
    from tripspark.plans.silver import add_time_features

    trips = spark.range(1000).selectExpr(
        "timestamp_ntz'2024-05-01 08:00:00' + make_dt_interval(0, 0, 0, id) as tpep_pickup_datetime",
        "timestamp_ntz'2024-05-01 08:20:00' + make_dt_interval(0, 0, 0, id) as tpep_dropoff_datetime",
        "2.5D as trip_distance", "0D as Airport_fee", "1L as RatecodeID", "12D as fare_amount",
    )
    sides = model_frame(add_time_features(trips)).agg(F.count_if("is_train").alias("train"), F.count(F.lit(1)).alias("n")).first()
    assert sides.n == 1000 and 600 < sides.train < 800


def test_stream_survives_a_null_and_an_empty_folder(spark, tmp_path):
    from tripspark.catalog import trips
    from tripspark.operators.nulls import plan_null_policy
    from tripspark.schema import TRIP_VIEW_SCHEMA
    from tripspark.streaming.scoring import run_until_drained, scored_stream

    land, out, ck = (str(tmp_path / x) for x in ("land", "out", "ck"))
    t = trips(spark, SF001).filter("Airport_fee IS NOT NULL AND cbd_congestion_fee IS NOT NULL")
    plan = plan_null_policy(t)  # no null fee when planned
    model, _ = saved_model(spark, SF001, "gbt")
    (tmp_path / "land").mkdir()
    stream = scored_stream(spark, land, TRIP_VIEW_SCHEMA, plan, model)
    assert run_until_drained(stream, out, ck).count() == 0
    some = t.limit(20)
    some.withColumn("Airport_fee", F.lit(None).cast("double")).write.mode("append").parquet(land)
    some.withColumn("fare_amount", F.lit(float("nan"))).write.mode("append").parquet(land)
    got = run_until_drained(scored_stream(spark, land, TRIP_VIEW_SCHEMA, plan, model), out, ck)
    assert got.count() > 20 and got.filter("predicted_duration IS NULL OR NOT inputs_present").count() == 0


def test_stream_equals_batch(spark):
    from tripspark.catalog import q_stream_score, trips
    from tripspark.operators.filters import filter_outliers
    from tripspark.operators.nulls import plan_null_policy
    from tripspark.plans.silver import add_time_features

    streamed = q_stream_score(spark, SF001)
    t = trips(spark, SF001)
    batch = filter_outliers(add_time_features(plan_null_policy(t).apply(t)))
    model, _ = saved_model(spark, SF001, "gbt")
    batch_scored = model.transform(ml.assemble_features(batch)).select(F.expm1("prediction").alias("predicted_duration"), "trip_distance", "duration_minutes")
    cols = ["trip_distance", "duration_minutes", "predicted_duration"]
    assert sorted(streamed.select(*cols).collect()) == sorted(batch_scored.select(*cols).collect())


def test_requests_frame_and_random_split(spark):
    reqs = scoring.requests_frame(
        spark,
        [
            dict(zip(FEATURE_ORDER, (6.4, 9, 11, 1.75, 3, 2, 31.2))),
            (0.0, 0, 0, 0.0, 0, 0, 0.0),
        ],
    )
    assert reqs.count() == 2 and reqs.schema["RatecodeID"].dataType.simpleString() == "bigint"
    df = spark.range(1000).toDF("k")
    a, b = ml.train_test_split(df, 0.7, method="random", seed=3)
    assert a.count() + b.count() == 1000
    assert ml.versioned_model_path("/m/", "gbt_duration_minutes", 2) == "/m/gbt_duration_minutes_v2"


def test_stream_dedups_like_batch_silver(spark, tmp_path):
    from tripspark.catalog import silver_plan, trips
    from tripspark.operators.nulls import plan_null_policy
    from tripspark.schema import TRIP_VIEW_SCHEMA
    from tripspark.streaming.scoring import run_until_drained, scored_stream

    land = str(tmp_path / "land")
    t = trips(spark, SF001)
    t.unionAll(t).write.parquet(land)  # every trip lands twice
    bronze = spark.read.schema(TRIP_VIEW_SCHEMA).parquet(land)
    model, _ = saved_model(spark, SF001, "gbt")
    stream = scored_stream(spark, land, TRIP_VIEW_SCHEMA, plan_null_policy(bronze), model, dedup_within="1 hour")
    out = run_until_drained(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    cols = ["trip_distance", "duration_minutes", "pickup_hour", "fare_amount"]
    assert sorted(out.select(*cols).collect()) == sorted(silver_plan(spark, SF001).select(*cols).collect())


def test_stream_is_incremental_and_exactly_once(spark, tmp_path):
    from tripspark.catalog import trips
    from tripspark.operators.nulls import plan_null_policy
    from tripspark.schema import TRIP_VIEW_SCHEMA
    from tripspark.streaming.scoring import run_until_drained, scored_stream

    t = trips(spark, SF001)
    cut = t.agg(F.percentile_approx("tpep_pickup_datetime", 0.5)).collect()[0][0]
    land, out_dir, ck = (str(tmp_path / n) for n in ("land", "out", "ck"))
    t.filter(F.col("tpep_pickup_datetime") < cut).write.mode("append").parquet(land)
    plan = plan_null_policy(t)
    model, _ = saved_model(spark, SF001, "gbt")

    def run():
        return run_until_drained(scored_stream(spark, land, TRIP_VIEW_SCHEMA, plan, model), out_dir, ck).count()

    first = run()
    assert run() == first  # restart without new files: nothing reprocessed
    t.filter(F.col("tpep_pickup_datetime") >= cut).write.mode("append").parquet(land)
    total = run()  # only the new files are processed
    from tripspark.operators.filters import filter_outliers
    from tripspark.plans.silver import add_time_features

    assert total == filter_outliers(add_time_features(plan.apply(t))).count() and total > first


def test_regression_metrics_by_hand(spark):
    rows = [(3.0, 2.5), (5.0, 5.0), (7.0, 8.0), (None, 1.0), (4.0, None)]
    m = ml.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").collect()[0]
    ys, ps = [3.0, 5.0, 7.0], [2.5, 5.0, 8.0]
    ss_res = sum((y - p) ** 2 for y, p in zip(ys, ps))
    mean = sum(ys) / 3
    ss_tot = sum((y - mean) ** 2 for y in ys)
    assert m.n == 3
    assert m.r2 == pytest.approx(1 - ss_res / ss_tot, rel=1e-12)
    assert m.mae == pytest.approx(sum(abs(y - p) for y, p in zip(ys, ps)) / 3, rel=1e-12)
    assert m.rmse == pytest.approx((ss_res / 3) ** 0.5, rel=1e-12)
    const = ml.regression_metrics(spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double"), "y", "p").collect()[0]
    assert const.r2 is None  # constant label: R2 undefined, not an error


def test_key_split_bucket_matches_integer_arithmetic(spark):
    ids = [0, 1, 2, 7, 12345, 2147483646, 2147483647, 9_000_000_000_000]
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    got = [r.b for r in df.select(key_bucket("k").alias("b")).collect()]
    expected = [((i % 2147483647) * 2654435761 % 4294967296) * 100 // 4294967296 for i in ids]
    assert got == expected


def test_stream_drains_a_backlog_in_bounded_batches(spark, tmp_path):
    from tripspark.catalog import trips
    from tripspark.operators.nulls import plan_null_policy
    from tripspark.schema import TRIP_VIEW_SCHEMA
    from tripspark.streaming.scoring import run_until_drained, scored_stream

    land = str(tmp_path / "land")
    t = trips(spark, SF001)
    t.repartition(6).write.parquet(land)  # six files
    plan = plan_null_policy(t)
    model, _ = saved_model(spark, SF001, "gbt")
    small = run_until_drained(
        scored_stream(spark, land, TRIP_VIEW_SCHEMA, plan, model, max_files_per_trigger=2), str(tmp_path / "a"), str(tmp_path / "ca")
    )
    one = run_until_drained(scored_stream(spark, land, TRIP_VIEW_SCHEMA, plan, model), str(tmp_path / "b"), str(tmp_path / "cb"))
    cols = ["trip_distance", "duration_minutes", "predicted_duration"]
    assert sorted(small.select(*cols).collect()) == sorted(one.select(*cols).collect())
    assert len(spark.read.text(str(tmp_path / "ca" / "offsets")).inputFiles()) >= 3  # three or more micro-batches


def test_fit_rows_per_task_are_bounded(spark, monkeypatch):
    """The partitions that a fit keeps and reads hold a bounded number of rows, however the rows came, and all of them."""
    rows = spark.range(0, 6000, 1, 2).select(
        *[(F.col("id") % (k + 2)).cast("double").alias(c) for k, c in enumerate(FEATURE_ORDER)],
        (F.col("id") % 40).cast("int").alias("duration_minutes"),
        (F.col("id") % 100).cast("int").alias(SPLIT_COL),
    )
    rows = rows.unionAll(rows.filter("duration_minutes = 7")).coalesce(1)  # one partition, equal rows
    monkeypatch.setattr(training, "FIT_ROWS_PER_TASK", 500)
    tm = train_duration_model(rows, "lr")
    sizes = [r["n"] for r in tm.frame.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) <= 500
    counted = tm.frame.groupBy("features", "duration_minutes").count()
    wanted = model_frame(rows).filter("is_train").groupBy("features", "duration_minutes").count()
    assert sum(sizes) == model_frame(rows).filter("is_train").count()
    assert counted.exceptAll(wanted).count() == 0 and wanted.exceptAll(counted).count() == 0
    tm.release()


def test_spread_rows_are_in_the_same_places_each_time(spark):
    """Rows within the bound stay as they lie; dealt rows take the same partitions and places when they are computed again."""
    df = spark.range(0, 3000, 1, 3).select((F.col("id") % 700).alias("a"), (F.col("id") % 11).cast("double").alias("b"))
    assert training.spread_rows(df, 1000) is df
    assert training.spread_rows(df.filter("a < 0"), 0).count() == 0
    first, again = (training.spread_rows(df.coalesce(k), 250).rdd.glom().collect() for k in (1, 1))
    assert first == again and max(map(len, first)) <= 250 and sum(map(len, first)) == 3000


def test_scored_batch_is_whole_where_the_fit_is_spread(spark, monkeypatch):
    """score_batch over a model fitted on dealt rows: every silver row once, each with the prediction of the model."""
    monkeypatch.setattr(training, "FIT_ROWS_PER_TASK", 50)
    s = silver(spark, SF001)
    tm = train_duration_model(s, "gbt", maxIter=2)
    assert tm.frame.rdd.getNumPartitions() > tm.frame.count() // 50
    scored = scoring.score_requests(scoring.requests_from_silver(s), tm.model)
    assert scored.count() == s.count() and scored.filter("prediction is null").count() == 0
    tm.release()
