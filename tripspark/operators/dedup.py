"""Deduplication.

``distinct_rows`` plans as a partial aggregate on all columns before the exchange, so repeated rows
(even one row repeated for a third of the table) are merged map-side; the shuffle carries at
most one copy per map task.

``distinct_by_hash`` moves no full rows where there is nothing to merge: a first pass shuffles one 64-bit
hash per row and keeps the hashes seen more than once; rows whose hash was seen once differ from all others and stay
where they are, and only the others are compared in full. Equal hashes of different rows cost a comparison, never a row.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripspark.config import run_path

#: above this share of repeated hashes a plain distinct moves less than finding and moving the rows that repeat
MOSTLY_REPEATED = 0.25
HASH = "_row_hash"


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct, planned once (the reference counted, distinct-counted, then distinct-ed)."""
    return df.distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


@dataclass(frozen=True)
class RepeatedHashes:
    """The row hashes seen more than once, as a written table, and what the pass over all rows counted."""

    table: DataFrame
    n_rows: int
    n_hashes: int
    n_repeated: int


def row_hash(columns: list[str]) -> Column:
    """64-bit hash of the columns; a NaN or a negative zero hashes like its equals."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def repeated_hashes(df: DataFrame, hash_of: Column | None = None) -> RepeatedHashes:
    """One pass over ``df`` that shuffles a hash per row (merged map-side) and writes those seen more than once to the
    shared folder."""
    groups = df.select((row_hash(df.columns) if hash_of is None else hash_of).alias(HASH)).groupBy(HASH).agg(F.count(F.lit(1)).alias("_n"))
    seen = Observation("row_hashes")
    many = F.col("_n") > 1
    counted = groups.observe(seen, F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("hashes"), F.count_if(many).alias("repeated"))
    path = run_path(df.sparkSession, "dedup", uuid.uuid4().hex[:12])
    counted.filter(many).select(HASH).write.parquet(path)
    found = seen.get
    return RepeatedHashes(df.sparkSession.read.schema(f"{HASH} long").parquet(path), int(found["rows"] or 0), int(found["hashes"]), int(found["repeated"]))


def _among(df: DataFrame, repeated: RepeatedHashes, how: str, hash_of: Column | None = None) -> DataFrame:
    hashed = df.withColumn(HASH, row_hash(df.columns) if hash_of is None else hash_of)
    return hashed.join(repeated.table, HASH, how).drop(HASH)


def distinct_by_hash(df: DataFrame, hash_of: Column | None = None) -> DataFrame:
    """Full-row distinct of a frame that gives the same rows each time it is evaluated (a scan with projections and filters).

    Runs the pass over the hashes now. Nothing repeats: ``df`` itself, and the rows are never shuffled. Little repeats: the rows whose hash
    was seen once, and the distinct of the others. ``hash_of``: another hash of the row (any function of it gives the same result)."""
    repeated = repeated_hashes(df, hash_of)
    if not repeated.n_repeated:
        return df
    if repeated.n_repeated > MOSTLY_REPEATED * repeated.n_rows:
        return df.distinct()
    return _among(df, repeated, "left_anti", hash_of).unionAll(_among(df, repeated, "left_semi", hash_of).distinct())


def duplicate_report(df: DataFrame, name: str | None = None) -> DataFrame:
    """One row: n_rows, n_distinct, n_duplicates (= rows - distinct rows).

    Rows whose hash was seen once are distinct; the others, found by the hashes that repeat, are compared in full, as one aggregate
    (repeated rows merge map-side), so the count is exact.
    """
    repeated = repeated_hashes(df)
    once = F.lit(repeated.n_hashes - repeated.n_repeated).cast("long")
    if repeated.n_repeated:
        rows = _among(df, repeated, "left_semi").distinct()
        out = rows.agg((once + F.count(F.lit(1))).alias("n_distinct"))
    else:
        out = df.sparkSession.range(1).select(once.alias("n_distinct"))
    total = F.lit(repeated.n_rows).cast("long")
    out = out.select(total.alias("n_rows"), "n_distinct", (total - F.col("n_distinct")).alias("n_duplicates"))
    if name is not None:
        out = out.select(F.lit(name).alias("table_name"), "*")
    return out
