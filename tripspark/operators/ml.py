"""Machine learning operators (M1-M8, R1) on Spark ML.

* Split: a hash of the row (or of an integer key), not ``randomSplit``. randomSplit depends on
  partition contents and order, so a recomputed partition (lost executor, re-read after a
  shuffle) can move rows between train and test; a hash split is a pure function of the row:
  no shuffle, stable under repartitioning and retries.
* Metrics: R2 / MAE / RMSE as ONE aggregate over the scored frame (the evaluator runs one job
  per metric). Same definitions as RegressionEvaluator: r2 = 1 - SS_res / SS_tot with
  SS_tot = n * var_pop(label).
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.fixed import FEATURE_ORDER, GBT_PARAMS, TRAIN_FRACTION
from tripspark.functions.trip import key_bucket
from tripspark.sources import files

FEATURES_COL = "features"

MODEL_CLASSES = {
    "gbt": GBTRegressionModel,
    "lr": LinearRegressionModel,
    "rf": RandomForestRegressionModel,
}


def assemble_features(
    df: DataFrame,
    input_cols: tuple[str, ...] | list[str] = FEATURE_ORDER,
    output_col: str = FEATURES_COL,
    handle_invalid: str = "error",
) -> DataFrame:
    """M1: dense vector of the inputs in the fixed order (a null raises, as by default)."""
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col, handleInvalid=handle_invalid).transform(df)


def inputs_present(input_cols: tuple[str, ...] | list[str] = FEATURE_ORDER) -> Column:
    """Whether every model input holds a number (neither null nor NaN)."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in input_cols])


def predict_present(df: DataFrame, model, input_cols: tuple[str, ...] | list[str] = FEATURE_ORDER) -> DataFrame:
    """``df`` with ``inputs_present`` and ``prediction``: every row stays, and one with a missing input has a null
    prediction instead of failing the job."""
    safe = {f"_in{i}": F.when(F.col("inputs_present"), F.col(c).cast("double")).otherwise(F.lit(0.0)) for i, c in enumerate(input_cols)}
    ready = df.withColumn("inputs_present", inputs_present(input_cols)).withColumns(safe)
    scored = model.transform(assemble_features(ready, list(safe)))
    return scored.drop(*safe, FEATURES_COL).withColumn("prediction", F.when(F.col("inputs_present"), F.col("prediction")))


def vector_as_array(col: str = FEATURES_COL) -> Column:
    return vector_to_array(F.col(col), "float64")


def hash_split_flag(columns: list[str], train_fraction: float = TRAIN_FRACTION, seed: int = 42, resolution: int = 10000) -> Column:
    """True for the train side; a pure function of the listed columns."""
    h = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]), F.lit(resolution))
    return h < F.lit(int(round(train_fraction * resolution)))


def is_train_bucket(bucket: str | Column, train_fraction: float = TRAIN_FRACTION, buckets: int = 100) -> Column:
    """R1 on a bucket 0..buckets-1: True for the train side."""
    return (F.col(bucket) if isinstance(bucket, str) else bucket) < int(round(train_fraction * buckets))


def key_split_label(key: str | Column, train_fraction: float = TRAIN_FRACTION, buckets: int = 100) -> Column:
    return F.when(is_train_bucket(key_bucket(key, buckets), train_fraction, buckets), F.lit("train")).otherwise(F.lit("test"))


def train_test_split(
    df: DataFrame,
    train_fraction: float = TRAIN_FRACTION,
    columns: list[str] | None = None,
    seed: int = 42,
    method: str = "hash",
) -> tuple[DataFrame, DataFrame]:
    """R1. ``hash`` (default): row-hash split, stable under recomputation. ``random``: Spark's
    seeded randomSplit, reproducible only while partitioning and row order stay the same."""
    if method == "random":
        train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed)
        return train, test
    flag = hash_split_flag(columns or df.columns, train_fraction, seed)
    return df.filter(flag), df.filter(~flag)


def regression_metrics(
    df: DataFrame,
    label_col: str,
    prediction_col: str,
    where: Column | None = None,
    also: list[Column] | None = None,
    mae_of: tuple[str, str] | None = None,
) -> DataFrame:
    """One row: n, r2, mae, rmse of the rows ``where`` (pairs with a null side are skipped), and the aggregates ``also`` of
    all rows. ``mae_of``: another (label, prediction) whose mean absolute error is wanted, e.g. on another scale."""
    where = F.lit(True) if where is None else where

    def pair(label: str, prediction: str) -> tuple[Column, Column]:
        both = where & F.col(label).isNotNull() & F.col(prediction).isNotNull()
        return F.when(both, F.col(label).cast("double")), F.when(both, F.col(prediction).cast("double"))

    y, p = pair(label_col, prediction_col)
    y2, p2 = pair(*mae_of) if mae_of else (y, p)
    err = y - p
    also = also or []
    m = df.agg(
        F.count(err).alias("n"),
        F.sum(err * err).alias("_ss_res"),
        F.var_pop(y).alias("_var"),
        F.avg(F.abs(y2 - p2)).alias("mae"),
        *also,
    )
    done = m.withColumns(
        {
            "r2": F.lit(1.0) - F.try_divide(F.col("_ss_res"), F.col("_var") * F.col("n")),
            "rmse": F.sqrt(F.try_divide(F.col("_ss_res"), F.col("n").cast("double"))),
        }
    )
    return done.drop("_ss_res", "_var")


def gbt_regressor(label_col: str, features_col: str = FEATURES_COL, **overrides) -> GBTRegressor:
    """M2 with the reference's settings; checkpointInterval cuts the boosting lineage every 10 trees."""
    params = {**GBT_PARAMS, "checkpointInterval": 10, **overrides}
    return GBTRegressor(featuresCol=features_col, labelCol=label_col, **params)


def linear_regression(label_col: str, features_col: str = FEATURES_COL, **overrides) -> LinearRegression:
    """M3."""
    return LinearRegression(featuresCol=features_col, labelCol=label_col, **overrides)


def random_forest(label_col: str, features_col: str = FEATURES_COL, seed: int = 42, **overrides) -> RandomForestRegressor:
    """M4 (seeded)."""
    return RandomForestRegressor(featuresCol=features_col, labelCol=label_col, seed=seed, checkpointInterval=10, **overrides)


def versioned_model_path(root: str, name: str, version: int) -> str:
    """``<root>/<name>_v<version>``; the last segment is the model_version in the prediction log."""
    return f"{root.rstrip('/')}/{name}_v{int(version)}"


def save_model(model, path: str) -> str:
    """Overwrite-save a fitted model; returns the path."""
    model.write().overwrite().save(path)
    return path


def model_versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """The complete versions of a model under ``root``, ascending."""
    found = (re.fullmatch(rf"{re.escape(name)}_v([0-9]+)", folder) for folder in files.folder_names(spark, root))
    return sorted(int(m.group(1)) for m in found if m)


def save_next_version(spark: SparkSession, model, root: str, name: str) -> str:
    """S8 without overwriting: save under the next free version and return its path.

    The model is saved under a draft name, a version number is claimed by creating its marker file (only one caller can), and the
    draft is renamed to it, so no reader sees half a model and two concurrent fits get two versions. A caller that stops after the claim leaves a number unused."""
    draft = f"{root.rstrip('/')}/.draft-{uuid.uuid4().hex}"
    model.write().save(draft)
    version = max(model_versions(spark, root, name), default=0) + 1
    while not files.claim_file(spark, f"{root.rstrip('/')}/.claims/{name}_v{version}"):
        version += 1
    path = versioned_model_path(root, name, version)
    files.rename_folder(spark, draft, path)
    return path


def load_version(spark: SparkSession, root: str, name: str, kind: str = "gbt", version: int | None = None):
    """A model and its path, the newest version or the one named."""
    versions = model_versions(spark, root, name)
    if not versions or (version is not None and version not in versions):
        raise FileNotFoundError(f"{name} under {root}: versions {versions}, wanted {version or 'the newest'}")
    path = versioned_model_path(root, name, version or versions[-1])
    return load_model(path, kind), path


def load_model(path: str, kind: str = "gbt"):
    """Load a fitted regression model of the given kind."""
    return MODEL_CLASSES[kind].load(path)
