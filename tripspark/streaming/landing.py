"""E5 / S3 on a stream: land only what is new.

A streaming file source with a checkpoint remembers which files were landed; each micro-batch (at most ``max_files`` files) is
copied once, with every column its files hold, to its own folder ``landed_batch=<epoch>`` of bronze. A repeated epoch gets the same files and
replaces its folder, so a job that stops between the write and the commit lands nothing twice. Bronze is never rewritten: a run costs what is new.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripspark.sources import files
from tripspark.sources.parquet import land_bronze, read_table

BATCH_COLUMN = "landed_batch"


@dataclass(frozen=True)
class LandedBatch:
    batch: int
    n_files: int
    n_rows: int
    extra_columns: tuple[str, ...]


def batch_folder(bronze: str, epoch: int) -> str:
    return f"{bronze.rstrip('/')}/{BATCH_COLUMN}={epoch}"


def land_new_files(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint_dir: str,
    declared: T.StructType,
    max_files: int = 1000,
) -> list[LandedBatch]:
    """Copy the files of ``landing`` that no earlier run has landed; one report per batch of this run (none if nothing is new).

    A file that lacks a declared column or holds it in another type stops the run before its batch is written; the batches before stay."""
    landed: list[LandedBatch] = []

    def land(batch: DataFrame, epoch: int) -> None:
        names = [r["f"] for r in batch.selectExpr("_file AS f").distinct().collect()]  # at most max_files names
        if not names:
            return
        raw = read_table(spark, sorted(names), declared, keep_extra=True)
        report = land_bronze(raw, batch_folder(bronze, epoch), declared)
        landed.append(LandedBatch(epoch, len(names), report.n_rows, report.extra_columns))

    files.make_folder(spark, bronze)
    found = spark.readStream.schema(declared).option("maxFilesPerTrigger", str(max_files)).parquet(landing)
    names_only = found.selectExpr("_metadata.file_path AS _file")  # footers only: no column is read
    query = names_only.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"landing failed: {query.exception()}")
    return landed


def read_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    """All landed batches with every column any of them holds (null where a batch lacks it) and ``landed_batch``."""
    return spark.read.option("mergeSchema", "true").parquet(bronze)
