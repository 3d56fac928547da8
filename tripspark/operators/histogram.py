"""Distribution of a numeric column (E4): fixed-width histogram and approximate quantiles.

The reference collected every value to the driver to plot it. A histogram is a group-by on
the bucket index (partial aggregation, <= #buckets rows per map task in the shuffle);
quantiles come from percentile_approx, a bounded-size sketch merged across partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, column: str, width: float, origin: float = 0.0) -> DataFrame:
    """bucket_start, n_rows per bucket [origin + k*width, origin + (k+1)*width). Nulls skipped."""
    k = F.floor((F.col(column) - F.lit(origin)) / F.lit(width))
    start = (k * F.lit(width) + F.lit(origin)).cast("double")
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(start.alias("bucket_start"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def approx_quantiles(df: DataFrame, column: str, probabilities: list[float], accuracy: int = 10000) -> DataFrame:
    """One row per probability: probability, value (percentile_approx, bounded memory)."""
    q = df.agg(F.percentile_approx(F.col(column).cast("double"), probabilities, accuracy).alias("_q"))
    return q.select(
        F.inline(
            F.arrays_zip(
                F.array(*[F.lit(float(p)) for p in probabilities]).alias("probability"),
                F.col("_q").alias("value"),
            )
        )
    )
