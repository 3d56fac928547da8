"""Parquet scan and sinks (bronze landing, overwrite).

A scan's files are validated once against the declared schema (every footer, metadata only) and then
the declared columns are projected; Catalyst prunes columns and pushes filters into the scan.
Landing observes its counts while writing, so nothing is read back to be counted.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripspark.config import app_key
from tripspark.schema import SchemaMismatch, compare_schema, validate

_VALIDATED: set = set()
FOOTER_THREADS = 16
FOOTERS_PER_TASK = 50


def read_table(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    validate_footer: bool = True,
    keep_extra: bool = False,
) -> DataFrame:
    """Scan a parquet file or directory.

    With ``schema``: every file's footer is checked against the declaration (metadata only), and the
    declared columns are projected in declared order and spelling. A file that lacks a column or holds another type
    fails here with one clear message that names it, rather than deep inside a job. ``keep_extra``: all columns of
    the files stay, in file order, columns of later files last (only the names are normalised).
    Without footer validation the declared schema is imposed on the scan directly.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if schema is None:
        return spark.read.parquet(*paths)
    if not validate_footer:
        return validate(spark.read.schema(schema).parquet(*paths), schema)
    found = spark.read.parquet(*paths)
    files = sorted(found.inputFiles())
    key = (app_key(spark), hash(tuple(files)), schema.json())
    if key not in _VALIDATED:
        check_files(spark, files, schema)
        _VALIDATED.add(key)  # the same files are checked once per session
    if keep_extra:
        return validate(spark.read.option("mergeSchema", "true").parquet(*paths), schema)
    return validate(found, schema).select(*[f.name for f in schema.fields])


def _footer_digest(uri: str) -> str:
    """What a Parquet file's footer says about its columns; the file's own name where its file system cannot be opened here."""
    import hashlib

    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    try:
        fs, path = pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
        with fs.open_input_file(path) as f:
            footer = pq.ParquetFile(f).metadata
    except Exception:  # the reader of the session opens it, or reports what is wrong with it
        return uri
    columns = [footer.schema.column(i) for i in range(footer.num_columns)]
    parts = [f"{c.path}|{c.physical_type}|{c.logical_type}|{c.converted_type}|{c.max_definition_level}|{c.max_repetition_level}" for c in columns]
    declared = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
    return hashlib.sha256("\n".join(parts).encode() + b"\n" + declared).hexdigest()


def check_files(spark: SparkSession, files: list[str], schema: T.StructType) -> None:
    """Raise SchemaMismatch if any of the files lacks a declared column or holds it in another type.

    One distributed job reads all footers and groups equal ones. The session's reader then opens one file of each group, so the
    schema compared is exactly the one that Spark sees; the driver's work grows with the number of unlike footers. A file on a
    file system that tasks cannot open by themselves is a group of its own.
    """

    def digests(batches):
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([_footer_digest(f) for f in batch.column(0).to_pylist()])], ["file", "footer"])

    paths = spark.createDataFrame([(f,) for f in files], "file string")
    tasks = max(1, min(len(files) // FOOTERS_PER_TASK, 10 * spark.sparkContext.defaultParallelism))
    footers = paths.repartition(tasks).mapInArrow(digests, "file string, footer string")
    kinds = footers.groupBy("footer").agg(F.min("file").alias("first"), F.count(F.lit(1)).alias("n_files")).collect()  # unlike footers

    def problem(kind) -> str | None:
        plain = re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(kind["first"]))  # a listed name is a URI, a read one a pattern
        report = compare_schema(spark.read.parquet(plain).schema, schema)
        alike = f" (and {kind['n_files'] - 1} files like it)" if kind["n_files"] > 1 else ""
        return None if report.ok else f"{kind['first']}{alike}: missing {list(report.missing)}, mistyped {list(report.mistyped)}"

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        problems = sorted(p for p in pool.map(problem, kinds) if p)
    if problems:
        raise SchemaMismatch("; ".join(problems[:5]) + (f"; and {len(problems) - 5} more kinds of files" if len(problems) > 5 else ""))


def write_overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the whole directory (the reference's SaveData)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions that ``df`` holds rows of; the files of the others are not touched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


@dataclass(frozen=True)
class LandingReport:
    path: str
    n_rows: int
    n_columns: int
    extra_columns: tuple[str, ...] = ()  # not in the declaration the frame was compared with

    def frame(self, spark: SparkSession, name: str) -> DataFrame:
        """One row: table_name, n_rows, n_columns."""
        return spark.createDataFrame([(name, self.n_rows, self.n_columns)], "table_name string, n_rows long, n_columns int")


def land_bronze(df: DataFrame, path: str, declared: T.StructType | None = None) -> LandingReport:
    """Copy a raw frame as-is to the bronze folder (columns and order preserved, nothing cleaned), and report which
    columns ``declared`` does not know.

    The row count is observed while the files are written (Spark ``Observation``): one pass over the
    data, no re-read of what was just landed. It comes from the successful task attempts only, so
    retried tasks do not double count.
    """
    obs = Observation("bronze_landing")
    write_overwrite(df.observe(obs, F.count(F.lit(1)).alias("_rows")), path)
    extra = compare_schema(df.schema, declared).extra if declared is not None else ()
    return LandingReport(path, int(obs.get["_rows"]), len(df.columns), extra)


def table_counts(df: DataFrame, name: str) -> DataFrame:
    """One row: table name, row count, column count (single aggregate job)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"),
        F.col("n_rows"),
        F.lit(len(df.columns)).cast("int").alias("n_columns"),
    )
