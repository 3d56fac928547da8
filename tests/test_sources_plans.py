"""Schema checks, sinks, JDBC option builder, and plan shapes (pushdown, one job, one shuffle)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001
from tripspark.catalog import SILVER_NUMERIC, silver, silver_encoded, silver_plan, trips
from tripspark.config import run_path
from tripspark.operators.aggregates import avg_duration_for_hour
from tripspark.operators.correlation import correlation_long
from tripspark.schema import TRIP_VIEW_SCHEMA, SchemaMismatch, normalize_names, validate
from tripspark.sources import jdbc
from tripspark.sources.parquet import check_files, land_bronze, read_table, table_counts


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_validate_renames_and_rejects(spark):
    df = spark.createDataFrame([(1, 2)], "ratecodeid long, x int")
    assert normalize_names(df, ["RatecodeID"]).columns == ["RatecodeID", "x"]
    schema = T.StructType([T.StructField("RatecodeID", T.LongType()), T.StructField("y", T.IntegerType())])
    with pytest.raises(SchemaMismatch, match="missing"):
        validate(df, schema)
    with pytest.raises(SchemaMismatch, match="mistyped"):
        validate(df, T.StructType([T.StructField("RatecodeID", T.IntegerType())]))


def test_read_table_checks_footer(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([(1,)], "VendorID string").write.parquet(p)
    with pytest.raises(SchemaMismatch):
        read_table(spark, p, T.StructType([T.StructField("VendorID", T.IntegerType())]))


def test_bronze_landing_preserves_rows_and_columns(spark):
    t = trips(spark, SF001)
    report = land_bronze(t, run_path(spark, "test-bronze"))
    landed = read_table(spark, report.path, TRIP_VIEW_SCHEMA)
    assert landed.columns == t.columns and landed.count() == t.count()
    assert (report.n_rows, report.n_columns) == (t.count(), 12)
    r = table_counts(landed, "trips").collect()[0]
    assert r.n_rows == report.n_rows


def test_landing_keeps_columns_beyond_the_declaration(spark, tmp_path):
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    t = trips(spark, SF001).withColumn("new_fee", F.lit(1.5))
    t.write.parquet(raw)
    found = read_table(spark, raw, TRIP_VIEW_SCHEMA, keep_extra=True)
    report = land_bronze(found, bronze, TRIP_VIEW_SCHEMA)
    assert spark.read.parquet(bronze).columns == t.columns and report.extra_columns == ("new_fee",) and report.n_columns == 13
    assert read_table(spark, raw, TRIP_VIEW_SCHEMA).columns == TRIP_VIEW_SCHEMA.fieldNames()


def test_a_second_file_without_a_column_is_named(spark, tmp_path):
    raw = str(tmp_path / "raw")
    t = trips(spark, SF001)
    t.coalesce(1).write.parquet(raw)
    read_table(spark, raw, TRIP_VIEW_SCHEMA)
    t.drop("Airport_fee").coalesce(1).write.mode("append").parquet(raw)  # after a first, valid check
    for keep in (False, True):
        with pytest.raises(SchemaMismatch, match="part-.*missing \\['Airport_fee'\\]"):
            read_table(spark, raw, TRIP_VIEW_SCHEMA, keep_extra=keep)


def test_sink_frame_types_and_names(spark):
    s = silver(spark, SF001)
    own = jdbc.sink_frame(s)
    assert own.schema["duration_minutes"].dataType.simpleString() == "int" and "split_bucket" not in own.columns
    table = jdbc.sink_frame(s, declared_types=True, table_names=True)
    assert table.schema["Durée_minutes"].dataType.simpleString() == "decimal(10,2)"
    big = spark.createDataFrame([(40000, 264)], "PULocationID int, DOLocationID int")
    assert jdbc.sink_frame(big, declared_types=True).collect()[0].PULocationID == 40000


def test_jdbc_options_validated_before_work():
    with pytest.raises(jdbc.SinkConfigError, match="password"):
        jdbc.jdbc_sink("jdbc:postgresql://db:5432/x", "silver_data", "u", None)
    with pytest.raises(jdbc.SinkConfigError, match="jdbc:"):
        jdbc.jdbc_sink("postgresql://db", "silver_data", "u", "p")
    opts = jdbc.jdbc_sink("jdbc:postgresql://db:5432/x", "silver_data", "u", "p", num_partitions=8).options()
    assert opts["dbtable"] == "silver_data" and opts["numPartitions"] == "8" and opts["truncate"] == "true"


def test_hour_filter_pushed_below_aggregates(spark):
    plan = _plan(avg_duration_for_hour(silver_plan(spark, SF001), 8))
    # the equality on the group key is evaluated in the Filter over the scan, below both aggregates
    lines = plan.splitlines()
    filt = [i for i, line in enumerate(lines) if "Filter (" in line and "hour(ts" in line and "= 8)" in line]
    aggs = [i for i, line in enumerate(lines) if "HashAggregate" in line]
    assert filt and aggs and filt[0] > max(aggs)


def test_hour_filter_reaches_silver_table_scan(spark):
    plan = _plan(avg_duration_for_hour(silver(spark, SF001), 8))
    assert "PushedFilters: [IsNotNull(pickup_hour), EqualTo(pickup_hour,8)]" in plan
    assert "ReadSchema: struct<duration_minutes:int,pickup_hour:int>" in plan


def test_silver_has_one_shuffle_and_pushed_scan(spark):
    plan = _plan(silver_plan(spark, SF001))
    assert plan.count("Exchange") == 1
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "IsNotNull(ts)" in pushed and "IsNotNull(value)" in pushed
    assert "props" not in plan.split("ReadSchema:")[1].split("\n")[0]  # unused column pruned


def test_correlation_is_one_aggregate(spark):
    plan = _plan(correlation_long(silver_encoded(spark, SF001), SILVER_NUMERIC))
    # silver is a scanned table: the only exchange is the tiny one keyed by pair
    # silver has no nulls: one global aggregate of the centred products (a row per task is shuffled), no generated rows
    assert plan.count("Exchange") == 1 and "Generate" not in plan.split("HashAggregate")[-1]
    assert plan.count("SortAggregate") + plan.count("HashAggregate") + plan.count("ObjectHashAggregate") <= 4


def test_scale_conf_sizes_partitions():
    from tripspark.config import scale_conf

    conf = scale_conf(30 * 1024**4)  # a 30 TB shuffle
    assert int(conf["spark.sql.shuffle.partitions"]) == 30 * 1024**4 // (256 * 1024**2)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert int(scale_conf(1)["spark.sql.shuffle.partitions"]) == 8


def test_relational_view_casts_to_declared_types(spark):
    from decimal import Decimal

    s = silver(spark, SF001)
    r = jdbc.relational_view(s)
    types = {f.name: f.dataType.simpleString() for f in r.schema.fields}
    assert types["trip_distance"] == "decimal(6,2)" and types["fare_amount"] == "decimal(10,2)"
    assert types["VendorID"] == "smallint" and types["duration_minutes"] == "decimal(10,2)"
    assert types["payment_type"] == "string"  # text in the test data: not forced to the numeric declaration
    rows = r.collect()  # every cast evaluated: nothing overflows the declaration
    assert len(rows) == s.count() and isinstance(rows[0].trip_distance, Decimal)


def _exchange_children(plan: str) -> list[str]:
    """For every Exchange in a physical plan string, the operator line right below it."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line or "Exchange SinglePartition" in line:
            out.append(lines[i + 1] if i + 1 < len(lines) else "")
    return out


def test_every_shuffle_is_fed_by_a_map_side_aggregate(spark):
    # a hot key (one hour with a third of the rows) or a row repeated for a third of the table is
    # collapsed inside each map task: the exchange carries at most one row per key per task
    for df in (
        silver_plan(spark, SF001),
        avg_duration_for_hour(silver(spark, SF001), -1),
        correlation_long(silver_encoded(spark, SF001), SILVER_NUMERIC),
    ):
        children = _exchange_children(df._jdf.queryExecution().executedPlan().toString())
        assert children and all("HashAggregate" in c for c in children), children


def test_footers_of_2000_files_are_read_in_one_job(spark, tmp_path):
    import shutil

    one, raw = str(tmp_path / "one"), tmp_path / "raw dir"
    t = trips(spark, SF001).limit(5)
    t.coalesce(1).write.parquet(one)
    (part,) = (tmp_path / "one").glob("part-*.parquet")
    raw.mkdir()
    for i in range(2000):
        shutil.copyfile(part, raw / f"file-{i:04}.parquet")
    files = spark.read.schema(TRIP_VIEW_SCHEMA).parquet(str(raw)).inputFiles()
    assert len(files) == 2000
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        check_files(spark, files, TRIP_VIEW_SCHEMA)
        assert len(tracker.getJobIdsForGroup("footers")) <= 3  # the footers (a stage to group them is a job under AQE)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    drifted = str(tmp_path / "drifted")
    t.withColumn("VendorID", F.col("VendorID").cast("string")).coalesce(1).write.parquet(drifted)
    (odd,) = (tmp_path / "drifted").glob("part-*.parquet")
    for name in ("odd-1.parquet", "odd-2.parquet"):
        shutil.copyfile(odd, raw / name)
    with pytest.raises(SchemaMismatch, match="odd-1.parquet \\(and 1 files like it\\): missing \\[\\], mistyped.*VendorID"):
        read_table(spark, str(raw), TRIP_VIEW_SCHEMA)
