"""Tables written to the shared folder of the session (``spark.checkpoint.dir``)."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tripspark.config import run_path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call uses."""
    return run_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet (with the writer's ``options``) to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send ``rows`` long texts at a time to Python, where the session has Spark's default of 10 000 rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def worker_state(owner: str) -> dict:
    """A dictionary of ``owner`` that lives in the Python worker over its tasks, until a task of another owner runs there:
    workers serve all operators of an application, and must not hold what earlier ones kept."""
    held = sys.modules.setdefault("_tripspark_worker", types.ModuleType("_tripspark_worker")).__dict__
    if held.get("owner") != owner:
        held["owner"], held["state"] = owner, {}
        give_back()
    return held["state"]


def give_back() -> None:
    """Return to the system the memory that the worker's allocators hold free: workers live on beside an executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task`` (of mapInArrow), after which the worker gives free memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run
