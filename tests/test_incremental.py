"""What is new only: hash-first distinct, stream into the log, landing in waves, replaced partitions, maintained aggregates, model versions;
and exact quantiles."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tripspark.catalog import saved_model, silver, trips
from tripspark.functions.trip import last_path_segment_of
from tripspark.operators import dedup, ml, nulls
from tripspark.operators.quantiles import discrete_rank, exact_quantiles
from tripspark.plans import maintained, scoring
from tripspark.plans.silver import build_silver
from tripspark.schema import FEATURE_ORDER, TRIP_VIEW_SCHEMA
from tripspark.sources import files
from tripspark.sources.parquet import read_table, write_partitions
from tripspark.streaming import landing, prediction_log
from tripspark.streaming.scoring import drain, scored_stream

SF001 = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- hash-first distinct
@pytest.mark.parametrize("collide", [False, True])
def test_distinct_by_hash(spark, collide):
    rng = random.Random(1)
    rows = [(i, None if i % 9 == 0 else f"t{i % 40}", float("nan") if i % 50 == 0 else i / 3) for i in range(400)]
    rows += rng.sample(rows, 30) + [rows[7]] * 20
    df = spark.createDataFrame(rows, "a long, b string, c double").repartition(5)
    hash_of = F.col("a") % 350 if collide else None  # rows that differ share a hash
    got = dedup.distinct_by_hash(df, hash_of)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, df.distinct().collect()))


def test_distinct_by_hash_without_repeats_moves_no_rows(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id * 2 AS twice").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert dedup.distinct_by_hash(df) is df
    few = df.union(df.filter("id < 10"))
    assert dedup.distinct_by_hash(few).count() == 1000
    assert dedup.distinct_by_hash(df.union(df)).count() == 1000
    assert dedup.distinct_by_hash(df.limit(0)).count() == 0


def test_silver_without_duplicates_is_not_shuffled(spark, tmp_path):
    trips(spark, SF001).distinct().write.parquet(str(tmp_path / "raw"))
    plan = build_silver(spark.read.parquet(str(tmp_path / "raw"))).frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PushedFilters" in plan
    with_repeats = spark.read.parquet(str(tmp_path / "raw"))
    both = with_repeats.union(with_repeats.limit(3))
    plan = nulls.plan_null_policy(both)
    a, b = (build_silver(both, null_plan=plan, hash_first=h).frame for h in (True, False))
    assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


# ---------------------------------------------------------------- stream into the log
@pytest.fixture
def landed(spark, tmp_path):
    source = str(tmp_path / "files")
    trips(spark, SF001).repartition(3).write.parquet(source)
    model, path = saved_model(spark, SF001, "gbt")
    plan = nulls.plan_null_policy(read_table(spark, source, TRIP_VIEW_SCHEMA))
    return source, path, lambda: scored_stream(spark, source, TRIP_VIEW_SCHEMA, plan, model, max_files_per_trigger=1)


def test_log_survives_a_stop_between_write_and_commit(spark, landed, tmp_path):
    source, path, stream = landed
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    files.make_folder(spark, log)
    write = prediction_log.log_writer(log, path, "trips")

    def stopped(batch, epoch):
        write(batch, epoch)
        if epoch == 1:
            raise RuntimeError("stopped after the write")

    query = stream().writeStream.foreachBatch(stopped).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="stopped after the write"):
        query.awaitTermination()
    assert spark.read.parquet(log).select("batch_id").distinct().count() == 2  # epoch 1 is written, not committed
    logged = prediction_log.log_until_drained(stream(), log, path, checkpoint, "trips")
    expected = drain(stream(), str(tmp_path / "scored"), str(tmp_path / "other")).table
    assert sorted(map(tuple, logged.select(*FEATURE_ORDER).collect())) == sorted(map(tuple, expected.select(*FEATURE_ORDER).collect()))
    assert {r.batch_id for r in logged.select("batch_id").distinct().collect()} == {prediction_log.epoch_batch_id("trips", e) for e in range(3)}
    before = logged.count()
    trips(spark, SF001).coalesce(1).write.mode("append").parquet(source)  # only what is new is scored
    assert prediction_log.log_until_drained(stream(), log, path, checkpoint, "trips").count() == 2 * before


def test_log_of_a_repeated_epoch_under_another_model(spark, landed, tmp_path):
    _, path, _ = landed
    log = str(tmp_path / "log")
    files.make_folder(spark, log)
    scored = scoring.score_requests(scoring.requests_from_silver(silver(spark, SF001)), saved_model(spark, SF001, "gbt")[0])
    prediction_log.log_writer(log, path, "trips")(scored, 0)
    prediction_log.log_writer(log, path, "other")(scored, 0)
    newer = path.replace("_v1", "_v2")
    prediction_log.log_writer(log, newer, "trips")(scored.limit(5), 0)
    found = {(r.model_version, r.batch_id): r["count"] for r in spark.read.parquet(log).groupBy("model_version", "batch_id").count().collect()}
    first = last_path_segment_of(path)
    assert found == {(first, "other-000000000000"): scored.count(), (last_path_segment_of(newer), "trips-000000000000"): 5}


def test_stream_counts_late_rows(spark, tmp_path):
    start = dt.datetime(2024, 5, 1, 8)
    base = trips(spark, SF001).limit(1).first().asDict()

    def write(name, hours):
        rows = [{**base, "cbd_congestion_fee": 0.75, "tpep_pickup_datetime": start + dt.timedelta(hours=h), "tpep_dropoff_datetime": start + dt.timedelta(hours=h, minutes=9)} for h in hours]
        spark.createDataFrame([tuple(r[f.name] for f in TRIP_VIEW_SCHEMA.fields) for r in rows], TRIP_VIEW_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    write("files", [0, 1, 1, 50])
    plan = nulls.plan_null_policy(trips(spark, SF001))
    model, _ = saved_model(spark, SF001, "gbt")

    def run():
        stream = scored_stream(spark, str(tmp_path / "files"), TRIP_VIEW_SCHEMA, plan, model, dedup_within="10 hours", max_files_per_trigger=1)
        return drain(stream, str(tmp_path / "scored"), str(tmp_path / "checkpoint"), state_partitions=2)

    first = run()
    assert (first.n_read, first.n_late) == (4, 0)
    write("files", [2, 49, 50])  # two in the window, of which one repeats, and one 38 hours late
    second = run()
    assert (second.n_read, second.n_late) == (3, 1)


# ---------------------------------------------------------------- landing
def test_landing_in_waves(spark, tmp_path):
    source, bronze, checkpoint = (str(tmp_path / n) for n in ("landing", "bronze", "checkpoint"))
    t = trips(spark, SF001)
    t.coalesce(2).write.parquet(source)

    def land(**how):
        return landing.land_new_files(spark, source, bronze, checkpoint, TRIP_VIEW_SCHEMA, **how)

    n = t.count()
    assert [(b.batch, b.n_rows, b.extra_columns) for b in land()] == [(0, n, ())]
    assert land() == []
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "bronze" / "landed_batch=0").iterdir()}
    t.withColumn("new_fee", F.lit(1.5)).repartition(3).write.mode("append").parquet(source)
    waves = land(max_files=2)
    assert [b.n_files for b in waves] == [2, 1] and sum(b.n_rows for b in waves) == n and waves[0].extra_columns == ("new_fee",)
    assert {str(p): p.stat().st_mtime_ns for p in (tmp_path / "bronze" / "landed_batch=0").iterdir()} == before  # not touched
    found = landing.read_bronze(spark, bronze)
    assert (found.count(), found.filter("new_fee = 1.5").count()) == (2 * n, n)
    t.withColumn("trip_distance", F.col("trip_distance").cast("string")).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="mistyped"):
        land()
    assert landing.read_bronze(spark, bronze).count() == 2 * n


def test_landing_repeats_a_batch_that_was_not_committed(spark, tmp_path, monkeypatch):
    source, bronze, checkpoint = (str(tmp_path / n) for n in ("landing", "bronze", "checkpoint"))
    t = trips(spark, SF001)
    t.write.parquet(source)
    real = landing.land_bronze

    def stopped(*args):
        real(*args)
        raise RuntimeError("stopped after the write")

    monkeypatch.setattr(landing, "land_bronze", stopped)
    with pytest.raises(Exception, match="stopped after the write"):
        landing.land_new_files(spark, source, bronze, checkpoint, TRIP_VIEW_SCHEMA)
    monkeypatch.setattr(landing, "land_bronze", real)
    assert [b.batch for b in landing.land_new_files(spark, source, bronze, checkpoint, TRIP_VIEW_SCHEMA)] == [0]
    assert landing.read_bronze(spark, bronze).count() == t.count()


# ---------------------------------------------------------------- partitions
def test_replaced_partition_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "months")
    s = spark.range(300).selectExpr("id", "cast(id % 3 + 1 AS int) AS pickup_month")
    write_partitions(s, path, ["pickup_month"])

    def stamps(month):
        return {p.name: p.stat().st_mtime_ns for p in (tmp_path / "months" / f"pickup_month={month}").iterdir()}

    before = {m: stamps(m) for m in (1, 2, 3)}
    write_partitions(s.filter("pickup_month = 2").withColumn("id", -F.col("id")), path, ["pickup_month"])
    assert stamps(1) == before[1] and stamps(3) == before[3] and stamps(2) != before[2]
    assert spark.read.parquet(path).agg(F.count("*"), F.count_if(F.col("id") < 0)).first()[:] == (300, 100)
    plan = spark.read.parquet(path).filter("pickup_month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_month" in plan


def test_maintained_aggregates(spark, tmp_path):
    s = silver(spark, SF001).withColumn("landed_batch", (F.col("pickup_day_week") % 3).cast("int"))
    table, store = str(tmp_path / "silver"), str(tmp_path / "store")
    for batch in range(3):
        write_partitions(s.filter(F.col("landed_batch") == batch), table, ["landed_batch"])
        assert maintained.refresh(spark, table, store) == [batch]
    assert maintained.refresh(spark, table, store) == []
    want = {r.payment_type: (r.n, r.m) for r in s.groupBy("payment_type").agg(F.count("*").alias("n"), F.avg("duration_minutes").alias("m")).collect()}
    got = maintained.payment_analysis(spark, store)
    found = {r.payment_type: (r.total_trips, r.avg_duration) for r in got.collect()}
    assert found.keys() == want.keys() and all(found[k] == pytest.approx(want[k]) for k in want)
    scans = got._jdf.queryExecution().executedPlan().toString()
    assert "/store" in scans and "/silver" not in scans
    write_partitions(s.filter("landed_batch = 1").limit(4), table, ["landed_batch"])  # a batch was replaced
    assert maintained.refresh(spark, table, store, replaced=[1]) == [1]
    total = s.filter("landed_batch <> 1").count() + 4
    assert maintained.payment_analysis(spark, store).agg(F.sum("total_trips")).first()[0] == total


# ---------------------------------------------------------------- models and their log
def test_model_versions(spark, tmp_path):
    root = str(tmp_path / "models")
    frame = ml.assemble_features(spark.range(30).selectExpr("cast(id AS double) AS x", "cast(2 * id AS double) AS y"), ["x"])
    first = ml.linear_regression("y").fit(frame)
    second = ml.linear_regression("y", fitIntercept=False).fit(frame.withColumn("y", F.col("y") * 2))
    paths = [ml.save_next_version(spark, m, root, "lr") for m in (first, second)]
    assert [p.rsplit("_", 1)[1] for p in paths] == ["v1", "v2"]
    assert files.claim_file(spark, f"{root}/.claims/lr_v3")  # another fit has this number, and is not complete
    assert ml.save_next_version(spark, first, root, "lr").endswith("lr_v4")
    assert ml.model_versions(spark, root, "lr") == [1, 2, 4]
    assert ml.load_version(spark, root, "lr", "lr")[1].endswith("lr_v4")
    loaded, path = ml.load_version(spark, root, "lr", "lr", 2)
    assert path == paths[1] and loaded.coefficients[0] == pytest.approx(second.coefficients[0])
    with pytest.raises(FileNotFoundError, match="wanted 3"):
        ml.load_version(spark, root, "lr", "lr", 3)


def test_log_is_pruned_by_version_and_batch(spark, tmp_path):
    scored = scoring.score_requests(scoring.requests_from_silver(silver(spark, SF001)), saved_model(spark, SF001, "gbt")[0])
    log = str(tmp_path / "log")
    for version in ("m_v1", "m_v2"):
        for batch in ("1", "01"):
            scoring.append_prediction_log(scored.limit(3), log, f"models/{version}", batch)
    one = scoring.read_prediction_log(spark, log, "m_v2", "01")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model_version" in plan and "(batch_id" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert {(r.model_version, r.batch_id) for r in one.collect()} == {("m_v2", "01")} and one.count() == 3


# ---------------------------------------------------------------- quantiles
@pytest.mark.parametrize("shape", ["uniform", "skewed", "ties", "two", "one", "negative"])
def test_exact_quantiles(spark, shape):
    rng = random.Random(5)
    n = 20_000
    make = {
        "uniform": lambda: rng.random(),
        "skewed": lambda: 10 ** rng.uniform(-300, 300),
        "ties": lambda: rng.choice([1.0, 1.0, 1.0, 2.0, rng.random()]),
        "two": lambda: rng.choice([1.0, 2.0]),
        "one": lambda: 3.5,
        "negative": lambda: -rng.paretovariate(0.5),
    }[shape]
    values = [make() for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(4)
    wanted = [0.0, 0.001, 0.1, 0.5, 0.77, 0.999, 1.0]
    got = {r["quantile"]: r["value"] for r in exact_quantiles(df, "v", wanted, accuracy=100, few_rows=50).collect()}
    ordered = sorted(values)
    assert got == {q: ordered[discrete_rank(q, n) - 1] for q in wanted}


def test_exact_quantiles_empty(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert [tuple(r) for r in exact_quantiles(df, "v", [0.5]).collect()] == [(0.5, None)]
