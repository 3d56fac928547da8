"""E2 + S10 + J3: a stream of scored trips into the prediction log, each trip logged exactly once.

Every micro-batch is a batch of the log, in a folder named by the stream and the epoch, so an epoch that is repeated (the
job stopped after its rows were written and before Spark committed the epoch) replaces its own rows. The checkpoint gives a repeated epoch
the same input. When the model changed in between, the epoch's rows under the other version are removed, since they are the same trips.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripspark.functions.trip import last_path_segment_of
from tripspark.plans import scoring
from tripspark.schema import FEATURE_ORDER
from tripspark.sources import files


def epoch_batch_id(stream_name: str, epoch: int) -> str:
    return f"{stream_name}-{epoch:012d}"


def log_writer(log_path: str, model_path: str, stream_name: str, user_id: int | None = None) -> Callable[[DataFrame, int], None]:
    """The function that writes one epoch: safe to call again with the same epoch."""
    version = last_path_segment_of(model_path)

    def write(batch: DataFrame, epoch: int) -> None:
        batch_id = epoch_batch_id(stream_name, epoch)
        scoring.append_prediction_log(batch.select(*FEATURE_ORDER, "predicted_duration"), log_path, model_path, batch_id, user_id)
        for other in files.partition_values(batch.sparkSession, log_path, "model_version"):
            if other != version:
                files.delete_folder(batch.sparkSession, f"{log_path.rstrip('/')}/model_version={other}/batch_id={batch_id}")

    return write


def start_stream_log(
    stream: DataFrame,
    log_path: str,
    model_path: str,
    checkpoint_dir: str,
    stream_name: str,
    user_id: int | None = None,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start logging a scored stream (its 7 inputs and ``predicted_duration``): all files present, or every ``processing_time``."""
    files.make_folder(stream.sparkSession, log_path)
    writer = stream.writeStream.foreachBatch(log_writer(log_path, model_path, stream_name, user_id)).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


def read_stream_log(spark: SparkSession, log_path: str, stream_name: str) -> DataFrame:
    """What a stream has logged, under any model version; other batches' folders are not read."""
    return scoring.read_prediction_log(spark, log_path).filter(F.col("batch_id").startswith(f"{stream_name}-"))


def log_until_drained(stream: DataFrame, log_path: str, model_path: str, checkpoint_dir: str, stream_name: str, user_id: int | None = None) -> DataFrame:
    """Log every file present, stop, and return all that the stream has logged so far."""
    query = start_stream_log(stream, log_path, model_path, checkpoint_dir, stream_name, user_id)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return read_stream_log(stream.sparkSession, log_path, stream_name)
