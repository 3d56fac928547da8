"""Trip column expressions.

All of them are plain ``pyspark.sql.functions`` compositions, so they stay inside whole-stage
codegen and can be pushed through projections by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripspark.fixed import FLAG_NO, FLAG_YES
from tripspark.schema import DROPOFF_COL, DURATION_COL, PICKUP_COL, SPLIT_COL


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_minutes(pickup: str | Column = PICKUP_COL, dropoff: str | Column = DROPOFF_COL) -> Column:
    """Whole minutes between two timestamps, truncated toward zero.

    dropoff - pickup is a day-time interval; cast to bigint gives whole seconds; /60 then a
    cast to int truncates toward zero (2:59.9 -> 2, -1:59 -> -1).
    """
    seconds = (_c(dropoff) - _c(pickup)).cast("long")
    return (seconds / 60).cast("int")


def time_feature_columns(pickup: str | Column = PICKUP_COL, dropoff: str | Column = DROPOFF_COL) -> dict[str, Column]:
    """duration_minutes, pickup_hour (0-23), pickup_day_week (1=Sunday..7), pickup_month (1-12)."""
    p = _c(pickup)
    return {
        DURATION_COL: duration_minutes(p, dropoff),
        "pickup_hour": F.hour(p),
        "pickup_day_week": F.dayofweek(p),
        "pickup_month": F.month(p),
        SPLIT_COL: key_bucket(_seconds(p) * 7919 + _seconds(_c(dropoff))),
    }


def _seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without zone."""
    return (ts.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("long")


# Constants of 32-bit Fibonacci hashing (2^32 / golden ratio, 2^32, 2^31 - 1).
FIB_MULTIPLIER = 2654435761
TWO_POW_32 = 4294967296
MERSENNE_31 = 2147483647


def key_bucket(key: str | Column, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 of an integer key by Fibonacci hashing (high bits of k * 2654435761 mod 2^32).

    Integer arithmetic only (no overflow: k < 2^31, so k * multiplier < 2^63), so any SQL engine
    can reproduce it exactly. A null key gives null.
    """
    k = F.pmod(_c(key), F.lit(MERSENNE_31))
    h = F.pmod(k * F.lit(FIB_MULTIPLIER), F.lit(TWO_POW_32))
    return F.floor(h * F.lit(buckets) / F.lit(TWO_POW_32)).cast("int")


def encode_flag(c: str | Column, no: str = FLAG_NO, yes: str = FLAG_YES) -> Column:
    """N -> 0, Y -> 1, anything else (including null) -> null."""
    col = _c(c)
    return F.when(col == no, F.lit(0)).when(col == yes, F.lit(1))


def to_log_target(c: str | Column) -> Column:
    """log(1 + x): the training label."""
    return F.log1p(_c(c))


def from_log_target(c: str | Column) -> Column:
    """exp(x) - 1: back from the log label to minutes."""
    return F.expm1(_c(c))


def last_path_segment(c: str | Column) -> Column:
    """Last '/'-separated segment of a path column, ignoring a trailing slash."""
    return F.element_at(F.split(F.regexp_replace(_c(c), "/+$", ""), "/"), -1)


def last_path_segment_of(path: str) -> str:
    """Driver-side twin of :func:`last_path_segment` for a configured path string."""
    return path.rstrip("/").split("/")[-1]
