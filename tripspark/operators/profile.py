"""Column profiles (P7, N1, A8): global aggregates, reshaped to one row per column.

The per-column functions stand side by side in one aggregate, and ``inline`` of an array of structs turns
its single row into one row per column. A frame with more columns than whole-stage codegen takes in one
aggregate (``spark.sql.codegen.maxFields``, 100 by default; beyond it a stage is interpreted, ~5x slower a row) is
profiled in blocks of columns, each scan pruned to its own columns. Every block is a global aggregate, so the
result has one row per column for any width, and for a frame without rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripspark.schema import FLOATING_TYPES, is_numeric


def codegen_field_budget(df: DataFrame) -> int:
    try:
        return int(df.sparkSession.conf.get("spark.sql.codegen.maxFields", "100"))
    except Exception:  # noqa: BLE001
        return 100


def _pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def _in_blocks(
    df: DataFrame,
    fields: list[T.StructField],
    buffer_fields: int,
    aggregates: Callable[[int, T.StructField], list[Column]],
    entry: Callable[[int, T.StructField], Column],
) -> DataFrame:
    """One row per field: ``entry`` of the aggregates of its block, which also counts the rows as ``_rows``."""
    per_block = max(1, (codegen_field_budget(df) - 2) // buffer_fields)
    numbered = list(enumerate(fields))
    parts = []
    for k in range(0, len(numbered), per_block):
        block = numbered[k : k + per_block]
        totals = df.agg(F.count(F.lit(1)).alias("_rows"), *[a for i, f in block for a in aggregates(i, f)])
        parts.append(totals.select(F.inline(F.array(*[entry(i, f) for i, f in block]))))
    return reduce(DataFrame.unionByName, parts)


def null_profile(df: DataFrame) -> DataFrame:
    """column_name, position, null_count, nan_count, null_pct (null share of the row count)."""

    def aggregates(i: int, f: T.StructField) -> list[Column]:
        nan = F.isnan(f.name) if isinstance(f.dataType, FLOATING_TYPES) else F.lit(False)
        return [F.count_if(F.col(f.name).isNull()).alias(f"_n{i}"), F.count_if(nan).alias(f"_x{i}")]

    def entry(i: int, f: T.StructField) -> Column:
        return F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i + 1).alias("position"),
            F.col(f"_n{i}").alias("null_count"),
            F.col(f"_x{i}").alias("nan_count"),
            _pct(F.col(f"_n{i}"), F.col("_rows")).alias("null_pct"),
        )

    return _in_blocks(df, df.schema.fields, 2, aggregates, entry)


def profile_columns(df: DataFrame) -> DataFrame:
    """Schema and shape: column_name, position, data_type, n_rows, n_columns, n_non_null."""
    n = len(df.schema.fields)

    def entry(i: int, f: T.StructField) -> Column:
        return F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i + 1).alias("position"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("_rows").alias("n_rows"),
            F.lit(n).alias("n_columns"),
            F.col(f"_v{i}").alias("n_non_null"),
        )

    return _in_blocks(df, df.schema.fields, 1, lambda i, f: [F.count(f.name).alias(f"_v{i}")], entry)


# buffer fields per described column: count 1, avg 2, stddev 3, min 1, max 1
_DESCRIBE_FIELDS = 8


def _numbers(i: int, f: T.StructField) -> list[Column]:
    x = F.col(f.name).cast("double") if is_numeric(f.dataType) else F.lit(None).cast("double")
    return [
        F.count(f.name).alias(f"_n{i}"),
        F.avg(x).alias(f"_a{i}"),
        F.stddev_samp(x).alias(f"_s{i}"),
        F.min(x).alias(f"_lo{i}"),
        F.max(x).alias(f"_hi{i}"),
    ]


def _number_columns(i: int, f: T.StructField) -> list[Column]:
    return [
        F.lit(f.name).alias("column_name"),
        F.col(f"_n{i}").alias("n"),
        F.col(f"_a{i}").alias("mean"),
        F.col(f"_s{i}").alias("stddev"),
        F.col(f"_lo{i}").alias("min"),
        F.col(f"_hi{i}").alias("max"),
    ]


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Typed ``describe()`` of the numeric columns: column_name, n, mean, stddev (sample), min, max as doubles."""
    fields = [df.schema[c] for c in columns] if columns else [f for f in df.schema.fields if is_numeric(f.dataType)]
    return _in_blocks(df, fields, _DESCRIBE_FIELDS, _numbers, lambda i, f: F.struct(*_number_columns(i, f)))


def describe(df: DataFrame) -> DataFrame:
    """Typed ``describe()`` of the numeric and the text columns: as :func:`describe_numeric`, and min_text, max_text
    (null for numbers, as mean, stddev, min and max are for text)."""
    fields = [f for f in df.schema.fields if is_numeric(f.dataType) or isinstance(f.dataType, T.StringType)]

    def text(f: T.StructField) -> Column:
        return F.col(f.name) if isinstance(f.dataType, T.StringType) else F.lit(None).cast("string")

    return _in_blocks(
        df,
        fields,
        _DESCRIBE_FIELDS + 2,
        lambda i, f: [*_numbers(i, f), F.min(text(f)).alias(f"_lt{i}"), F.max(text(f)).alias(f"_ht{i}")],
        lambda i, f: F.struct(*_number_columns(i, f), F.col(f"_lt{i}").alias("min_text"), F.col(f"_ht{i}").alias("max_text")),
    )
