"""Train and evaluate a duration model on silver trips.

silver -> 7 features (fixed order) -> vector -> label (log1p minutes for GBT, minutes for the
linear and forest models) -> split by the trip's bucket -> fit on the train side -> score every row -> metrics on
the test side.
The train side is persisted MEMORY_AND_DISK for the fit (tree learners scan it once per level), in partitions of a bounded
number of rows (a learner keeps some 300 bytes a row and reads a partition's share in one task), and
the boosting lineage is checkpointed to the shared checkpoint dir every 10 iterations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.config import ensure_checkpoint_dir
from tripspark.functions.trip import from_log_target, to_log_target
from tripspark.operators import ml
from tripspark.schema import DURATION_COL, FEATURE_ORDER, SPLIT_COL

LOG_LABEL = "duration_log"

#: most train rows in a task of the fit
FIT_ROWS_PER_TASK = 250_000

# model kind -> (label column, label is log scale)
MODEL_KINDS = {"gbt": (LOG_LABEL, True), "lr": (DURATION_COL, False), "rf": (DURATION_COL, False)}


def model_frame(silver: DataFrame) -> DataFrame:
    """Features vector + labels (P2, M1, X7), the split flag from the trip's bucket (its times), so that equal rows of
    different trips fall on both sides."""
    flagged = silver.select(*FEATURE_ORDER, DURATION_COL, ml.is_train_bucket(SPLIT_COL).alias("is_train"))
    assembled = ml.assemble_features(flagged)
    return assembled.select(ml.FEATURES_COL, to_log_target(DURATION_COL).alias(LOG_LABEL), DURATION_COL, "is_train")


@dataclass
class TrainedModel:
    kind: str
    model: object
    scored: DataFrame  # every row: features, labels, is_train, prediction, predicted_minutes
    frame: DataFrame | None = None  # the persisted train side

    def release(self) -> None:
        """Drop the persisted train side (``scored`` does not read it)."""
        if self.frame is not None:
            self.frame.unpersist()

    @property
    def predictions(self) -> DataFrame:
        """Test side only."""
        return self.scored.filter(~F.col("is_train"))

    @property
    def train(self) -> DataFrame:
        return self.scored.filter(F.col("is_train"))

    def metrics(self, version: str = "v1") -> DataFrame:
        """Model, version, metric, value, n_train, n_test. R2 on the training label's scale
        (log for GBT), MAE in minutes; one aggregate job over the scored frame."""
        label, _ = MODEL_KINDS[self.kind]
        m = ml.regression_metrics(
            self.scored,
            label,
            "prediction",
            where=~F.col("is_train"),
            also=[F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("n_test")],
            mae_of=(DURATION_COL, "predicted_minutes"),
        )
        return m.select(
            F.lit(self.kind).alias("model"),
            F.lit(version).alias("version"),
            F.inline(
                F.array(
                    F.struct(F.lit("r2").alias("metric"), F.col("r2").alias("value")),
                    F.struct(F.lit("mae_minutes").alias("metric"), F.col("mae").alias("value")),
                )
            ),
            "n_train",
            "n_test",
        )


def spread_rows(df: DataFrame, most: int) -> DataFrame:
    """All rows of ``df``: as they lie where no partition holds more than ``most`` rows, else dealt evenly over as many partitions as
    that takes. A scan's partitions follow the bytes of its files, so their rows are not bounded by themselves.

    Dealt rows are ordered by their hash in each partition: a partition computed again, after a lost executor, has its rows in
    the same places, as the learners that zip frames need, whichever order the shuffle's blocks arrive in."""
    parts = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    found = parts.agg(F.max("n").alias("largest"), F.sum("n").alias("rows")).first()
    if (found["largest"] or 0) <= most:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    dealt = df.repartition(max(-(-found["rows"] // most) + 1, cores))  # one more: each task that deals starts anywhere
    return dealt.sortWithinPartitions(F.xxhash64(*df.columns), F.hash(*df.columns))


def train_duration_model(silver: DataFrame | None, kind: str = "gbt", frame: DataFrame | None = None, **params) -> TrainedModel:
    """Fit on the train side of ``silver``'s model frame, or of a ``frame`` made before (to fit several kinds on one). Only the train
    side is persisted, for the fit."""
    if kind not in MODEL_KINDS:
        raise ValueError(f"unknown model kind {kind!r}")
    frame = model_frame(silver) if frame is None else frame
    ensure_checkpoint_dir(frame.sparkSession)
    label, is_log = MODEL_KINDS[kind]
    train = spread_rows(frame.filter("is_train"), FIT_ROWS_PER_TASK).persist(StorageLevel.MEMORY_AND_DISK)
    estimators = {"gbt": ml.gbt_regressor, "lr": ml.linear_regression, "rf": ml.random_forest}
    model = estimators[kind](label, **params).fit(train)
    scored = model.transform(frame)
    minutes = from_log_target("prediction") if is_log else F.col("prediction")
    return TrainedModel(kind, model, scored.withColumn("predicted_minutes", minutes), train)
