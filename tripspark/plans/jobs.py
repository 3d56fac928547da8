"""The pipeline as runnable jobs: land bronze, prepare silver, train, score.

    python -m tripspark.plans.jobs bronze  --source RAW --bronze BRONZE
    python -m tripspark.plans.jobs silver  --bronze BRONZE --silver SILVER [--jdbc-table T]
    python -m tripspark.plans.jobs train   --silver SILVER --model-dir DIR [--kind gbt]
    python -m tripspark.plans.jobs score   --requests REQ --model PATH --log LOG --batch-id B

Hand-off between jobs is by tables only (as in the reference's task graph). Sink settings are
validated before the expensive work starts. Each job uses the session it is given (on a
cluster: the cluster's own settings, shuffle partitions and ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from tripspark.config import scale_conf
from tripspark.operators import ml
from tripspark.plans import scoring
from tripspark.plans.silver import build_silver, write_silver
from tripspark.plans.training import train_duration_model
from tripspark.schema import RAW_TRIP_SCHEMA
from tripspark.sources import jdbc
from tripspark.sources.parquet import land_bronze, read_table, table_counts


def bronze_job(spark: SparkSession, source: str, bronze: str, validate_raw: bool = True, extra: list | None = None) -> DataFrame:
    """Land the raw file(s) as-is, with every column they hold; returns (table_name, n_rows, n_columns), observed
    during the write. Columns beyond the declaration are landed too, and appended to ``extra`` when a list is given."""
    raw = read_table(spark, source, RAW_TRIP_SCHEMA if validate_raw else None, keep_extra=True)
    report = land_bronze(raw, bronze, RAW_TRIP_SCHEMA)
    if extra is not None:
        extra.extend(report.extra_columns)
    return report.frame(spark, "bronze")


def silver_job(
    spark: SparkSession,
    bronze: str,
    silver: str,
    jdbc_sink: jdbc.JdbcSink | None = None,
    partition_by: list[str] | None = None,
    decisions: list | None = None,
) -> DataFrame:
    """Bronze -> silver parquet (-> JDBC table, from the written parquet). Returns the silver table;
    the null-policy decisions (per column: nulls, share, action, fill value) are appended to
    ``decisions`` when a list is given."""
    raw = read_table(spark, bronze)
    result = build_silver(raw)
    if decisions is not None:
        decisions.extend(result.null_plan.decisions)
    written = write_silver(result.frame, silver, partition_by, sort_within=["pickup_hour"])
    if jdbc_sink is not None:
        jdbc.write_jdbc(written, jdbc_sink, mode="overwrite")
    return written


def train_job(spark: SparkSession, silver: str, model_path: str, kind: str = "gbt") -> DataFrame:
    """Train on the silver table, save the model, return its metrics frame."""
    tm = train_duration_model(read_table(spark, silver), kind)
    ml.save_model(tm.model, model_path)
    version = model_path.rstrip("/").split("/")[-1]
    metrics = tm.metrics(version)
    rows = metrics.collect()  # two rows: r2 and mae
    tm.release()
    return spark.createDataFrame(rows, metrics.schema)


def score_job(spark: SparkSession, requests: str, model_path: str, log_path: str, batch_id: str, kind: str = "gbt", user_id: int | None = None) -> DataFrame:
    """Score a table of requests with a saved model and append them to the prediction log."""
    model = ml.load_model(model_path, kind)
    scored = scoring.score_requests(read_table(spark, requests), model, log_scale=(kind == "gbt"))
    return scoring.append_prediction_log(scored, log_path, model_path, batch_id, user_id)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tripspark.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("bronze")
    b.add_argument("--source", required=True)
    b.add_argument("--bronze", required=True)
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--jdbc-table")
    s.add_argument("--partition-by", nargs="*")
    t = sub.add_parser("train")
    t.add_argument("--silver", required=True)
    t.add_argument("--model-dir", required=True)
    t.add_argument("--kind", default="gbt", choices=sorted(ml.MODEL_CLASSES))
    c = sub.add_parser("score")
    c.add_argument("--requests", required=True)
    c.add_argument("--model", required=True)
    c.add_argument("--log", required=True)
    c.add_argument("--batch-id", required=True)
    c.add_argument("--kind", default="gbt", choices=sorted(ml.MODEL_CLASSES))
    for sp in (b, s, t, c):
        sp.add_argument(
            "--expected-shuffle-gb",
            type=float,
            help="size the session for a shuffle of this many GB (see config.scale_conf)",
        )
    args = p.parse_args(argv)

    sink = jdbc.jdbc_sink_from_env(args.jdbc_table) if getattr(args, "jdbc_table", None) else None  # fail fast
    spark = SparkSession.builder.appName(f"tripspark-{args.job}").getOrCreate()
    if args.expected_shuffle_gb:
        for key, value in scale_conf(int(args.expected_shuffle_gb * 1024**3)).items():
            spark.conf.set(key, value)
    if args.job == "bronze":
        extra: list = []
        out = bronze_job(spark, args.source, args.bronze, extra=extra)
        if extra:
            print(json.dumps({"columns_beyond_the_declaration": extra}))
    elif args.job == "silver":
        decisions: list = []
        out = table_counts(silver_job(spark, args.bronze, args.silver, sink, args.partition_by, decisions), "silver")
        for d in decisions:  # the null policy's report, one line per column with nulls
            if d.action != "none":
                print(json.dumps({"column": d.column, "nulls": d.null_count, "null_pct": round(d.null_pct, 4), "action": d.action, "fill_value": d.fill_value}, default=str))
    elif args.job == "train":
        out = train_job(spark, args.silver, args.model_dir, args.kind)
    else:
        out = table_counts(score_job(spark, args.requests, args.model, args.log, args.batch_id, args.kind), "prediction_log")
    for row in out.collect():  # small report frames only
        print(json.dumps(row.asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
