"""The four pipeline jobs on a raw 20-column trip table (the recorded raw schema)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tripspark.plans import jobs
from tripspark.schema import FEATURE_ORDER, RAW_TRIP_SCHEMA
from tripspark.sources import jdbc
from tripspark.sources.trips_view import load_trips


def _raw_file(spark, path):
    t = load_trips(spark, SF001)
    extra = {
        "PULocationID": (F.abs(F.hash("tpep_pickup_datetime")) % 265).cast("int"),
        "DOLocationID": (F.abs(F.hash("tpep_dropoff_datetime")) % 265).cast("int"),
        "payment_type": (F.length("payment_type") % 4 + 1).cast("long"),
        "extra": F.lit(0.5),
        "mta_tax": F.lit(0.5),
        "tip_amount": F.round(F.col("fare_amount") * 0.15, 2),
        "tolls_amount": F.lit(0.0),
        "improvement_surcharge": F.lit(1.0),
        "congestion_surcharge": F.when(F.col("passenger_count").isNull(), None).otherwise(F.lit(2.5)),
    }
    raw = t.withColumns(extra).select(*[F.col(f.name).cast(f.dataType) for f in RAW_TRIP_SCHEMA.fields])
    raw.write.mode("overwrite").parquet(path)
    return raw


def test_pipeline_jobs(spark, tmp_path):
    src, bronze, silver = (str(tmp_path / n) for n in ("raw", "bronze", "silver"))
    raw = _raw_file(spark, src)
    counts = jobs.bronze_job(spark, src, bronze).collect()[0]
    assert counts.n_rows == raw.count() and counts.n_columns == 20

    s = jobs.silver_job(spark, bronze, silver)
    assert "duration_minutes" in s.columns and "tpep_pickup_datetime" not in s.columns
    assert len(s.columns) == 23
    assert s.filter(F.col("duration_minutes") <= 0).count() == 0
    assert s.filter(F.col("congestion_surcharge").isNull()).count() == 0  # filled by its mean

    model_path = str(tmp_path / "models" / "gbt_duration_minutes_v1")
    metrics = {r.metric: r for r in jobs.train_job(spark, silver, model_path).collect()}
    assert metrics["r2"].version == "gbt_duration_minutes_v1" and metrics["r2"].n_test > 0

    req_path = str(tmp_path / "requests")
    spark.read.parquet(silver).select(*FEATURE_ORDER).write.parquet(req_path)
    logged = jobs.score_job(spark, req_path, model_path, str(tmp_path / "log"), "b-1")
    assert logged.count() == s.count()


def test_silver_job_fails_fast_on_jdbc_config(monkeypatch):
    monkeypatch.delenv("TRIPSPARK_DB_URL", raising=False)
    with pytest.raises(jdbc.SinkConfigError):
        jobs.main(["silver", "--bronze", "/nonexistent", "--silver", "/nonexistent", "--jdbc-table", "silver_data"])


def test_jobs_cli_end_to_end(spark, tmp_path, capsys):
    import json

    src = str(tmp_path / "raw")
    _raw_file(spark, src)
    paths = {n: str(tmp_path / n) for n in ("bronze", "silver", "log", "requests")}
    model = str(tmp_path / "models" / "rf_duration_minutes_v3")
    from tripspark.config import scale_conf

    touched = list(scale_conf(1))
    before = {k: spark.conf.get(k, None) for k in touched}
    try:
        assert jobs.main(["bronze", "--source", src, "--bronze", paths["bronze"], "--expected-shuffle-gb", "4"]) == 0
        assert spark.conf.get("spark.sql.shuffle.partitions") == "16"  # 4 GB / 256 MB
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert jobs.main(["silver", "--bronze", paths["bronze"], "--silver", paths["silver"], "--partition-by", "pickup_month"]) == 0
    assert jobs.main(["train", "--silver", paths["silver"], "--model-dir", model, "--kind", "rf"]) == 0
    spark.read.parquet(paths["silver"]).select(*FEATURE_ORDER).write.parquet(paths["requests"])
    assert jobs.main(["score", "--requests", paths["requests"], "--model", model, "--log", paths["log"], "--batch-id", "7", "--kind", "rf"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    by_name = {d.get("table_name"): d for d in lines if "table_name" in d}
    actions = {d["column"]: d["action"] for d in lines if "action" in d}
    assert actions["cbd_congestion_fee"] == "drop" and actions["store_and_fwd_flag"] == "fill_mode"
    assert actions["passenger_count"] == "fill_mean"
    assert by_name["bronze"]["n_columns"] == 20
    assert by_name["silver"]["n_rows"] == by_name["prediction_log"]["n_rows"] > 0
    assert {d["metric"] for d in lines if "metric" in d} == {"r2", "mae_minutes"}
    assert all(d["version"] == "rf_duration_minutes_v3" for d in lines if "metric" in d)


def test_silver_over_a_raw_file_pushes_drop_and_outlier_filters(spark, tmp_path):
    import contextlib
    import io

    from tripspark.plans.silver import build_silver

    src = str(tmp_path / "raw")
    _raw_file(spark, src)
    res = build_silver(spark.read.parquet(src))
    assert res.null_plan.nan_columns == frozenset()  # no NaN: floating columns pass through untouched
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        res.frame.explain("formatted")
    pushed = next(line for line in buf.getvalue().splitlines() if line.startswith("PushedFilters"))
    for f in (
        "IsNotNull(cbd_congestion_fee)",
        "GreaterThan(trip_distance,0.0)",
        "LessThanOrEqual(trip_distance,200.0)",
        "GreaterThan(fare_amount,0.0)",
        "GreaterThan(total_amount,0.0)",
    ):
        assert f in pushed, pushed
