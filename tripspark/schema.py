"""Declared schemas, name normalisation and validation.

Reads never rely on footer inference alone: the scan declares the schema it expects, and
``validate`` turns a missing, extra or mistyped column into one clear error before any
expensive work starts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripspark.fixed import FEATURE_ORDER, RAW_TRIP_COLUMNS, SILVER_TABLE_COLUMNS  # noqa: F401 - FEATURE_ORDER re-exported

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

# The raw trip file, declared from the fixed column list.
RAW_TRIP_SCHEMA = T.StructType([T.StructField(name, _TYPES[type_name]) for name, type_name in RAW_TRIP_COLUMNS])

# The trips view derived from the test tables: 12 of the 20 raw columns, payment_type a string.
TRIP_VIEW_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
        T.StructField("cbd_congestion_fee", T.DoubleType()),
    ]
)

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

PICKUP_COL = "tpep_pickup_datetime"
DROPOFF_COL = "tpep_dropoff_datetime"
DURATION_COL = "duration_minutes"
SPLIT_COL = "split_bucket"  # 0-99, from the trip's times: which side of the train / test split it is on
TIME_FEATURE_COLS = (DURATION_COL, "pickup_hour", "pickup_day_week", "pickup_month", SPLIT_COL)

# Scoring request: the seven model inputs.
REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pickup_hour", T.IntegerType()),
        T.StructField("pickup_month", T.IntegerType()),
        T.StructField("Airport_fee", T.DoubleType()),
        T.StructField("pickup_day_week", T.IntegerType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
    ]
)

# Relational declaration of silver, used only at a typed sink.
_SINK_TYPES = {"smallint": T.ShortType(), "integer": T.IntegerType(), "text": T.StringType()}


def _sink_type(declared: str) -> T.DataType:
    if declared.startswith("numeric"):
        precision, scale = declared[len("numeric(") : -1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _SINK_TYPES[declared]


SILVER_SINK_TYPES: dict[str, T.DataType] = {name: _sink_type(declared) for name, declared in SILVER_TABLE_COLUMNS}


class SchemaMismatch(ValueError):
    """Raised when a frame does not carry the declared columns and types."""


@dataclass(frozen=True)
class SchemaReport:
    missing: tuple[str, ...]
    extra: tuple[str, ...]
    mistyped: tuple[tuple[str, str, str], ...]

    @property
    def ok(self) -> bool:
        return not (self.missing or self.mistyped)


def compare_schema(actual: T.StructType, expected: T.StructType) -> SchemaReport:
    """Case-insensitive comparison, as Spark's default resolution is."""
    have = {f.name.lower(): f for f in actual.fields}
    want = {f.name.lower(): f for f in expected.fields}
    missing = tuple(f.name for k, f in want.items() if k not in have)
    extra = tuple(f.name for k, f in have.items() if k not in want)
    mistyped = tuple(
        (f.name, f.dataType.simpleString(), have[k].dataType.simpleString())
        for k, f in want.items()
        if k in have and have[k].dataType != f.dataType
    )
    return SchemaReport(missing, extra, mistyped)


def validate(df: DataFrame, expected: T.StructType, allow_extra: bool = True) -> DataFrame:
    """Return ``df`` with columns renamed to the declared spelling; raise on mismatch."""
    report = compare_schema(df.schema, expected)
    if not report.ok or (report.extra and not allow_extra):
        problems = []
        if report.missing:
            problems.append(f"missing columns {list(report.missing)}")
        if report.mistyped:
            problems.append(
                "mistyped " + ", ".join(f"{n} (want {w}, got {g})" for n, w, g in report.mistyped)
            )
        if report.extra and not allow_extra:
            problems.append(f"unexpected columns {list(report.extra)}")
        raise SchemaMismatch("; ".join(problems))
    return normalize_names(df, [f.name for f in expected.fields])


def normalize_names(df: DataFrame, canonical: list[str] | tuple[str, ...]) -> DataFrame:
    """Rename columns matching ``canonical`` case-insensitively to the canonical spelling."""
    lookup = {c.lower(): c for c in canonical}
    renames = {c: lookup[c.lower()] for c in df.columns if c.lower() in lookup and lookup[c.lower()] != c}
    return df.withColumnsRenamed(renames) if renames else df


NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING_TYPES = (T.FloatType, T.DoubleType)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]
