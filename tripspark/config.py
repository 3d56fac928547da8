"""Session construction and shared storage locations.

Written tables (bronze, silver, models, prediction logs) and lineage cuts live under the
shared folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is
absent (local runs, tests) do we create a private temporary folder and register it.
"""

from __future__ import annotations

import os
import tempfile
import threading

from pyspark.sql import SparkSession

# Defaults for a session we build ourselves. A cluster session built elsewhere keeps its own.
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # streaming dedup state lives off-heap in RocksDB (large state, no GC pressure)
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_LOCK = threading.Lock()
_LOCAL_ROOTS: dict[str, str] = {}


def build_session(
    master: str | None = None,
    app_name: str = "tripspark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _session_setting(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - unknown keys raise on some versions
        value = None
    if value:
        return value
    try:
        return spark.sparkContext.getConf().get(key, None)
    except Exception:  # noqa: BLE001 - no SparkContext (Connect)
        return None


def app_key(spark: SparkSession) -> str:
    """Identity of the running application (for per-session memoisation)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext handle (e.g. Spark Connect)
        return _session_setting(spark, "spark.app.id") or f"session-{id(spark)}"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    ``spark.checkpoint.dir`` when the session names one; otherwise, in local mode only (tests,
    laptop runs), a fresh temporary folder registered as the checkpoint dir. On a cluster a
    missing setting is an error, never a machine-local folder.
    """
    configured = _session_setting(spark, "spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    master = _session_setting(spark, "spark.master") or "unknown"
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster, written tables and checkpoints need a "
            "shared folder every executor can reach (a machine-local temp dir would split them)"
        )
    key = app_key(spark)
    with _LOCK:
        root = _LOCAL_ROOTS.get(key)
        if root is None:
            root = tempfile.mkdtemp(prefix="tripspark-")
            try:
                spark.sparkContext.setCheckpointDir(os.path.join(root, "checkpoints"))
            except Exception:  # noqa: BLE001 - no SparkContext handle
                pass
            _LOCAL_ROOTS[key] = root
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure the SparkContext has a checkpoint dir (for GBT checkpointInterval, checkpoint())."""
    root = shared_dir(spark)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext handle
        return root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root + "/checkpoints")
    return root


def table_path(spark: SparkSession, *parts: str) -> str:
    """Location of a written table under the shared folder, e.g. ``table_path(spark, 'silver', 'trips')``."""
    return "/".join([shared_dir(spark), "tripspark", *parts])


def run_path(spark: SparkSession, *parts: str) -> str:
    """Location scoped to this application run: concurrent applications sharing the folder
    never overwrite each other's derived tables."""
    safe = "".join(ch if ch.isalnum() or ch in "-_." else "_" for ch in app_key(spark))
    return table_path(spark, "runs", safe, *parts)


def scale_conf(
    shuffle_input_bytes: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
    scan_partition_bytes: int = 256 * 1024 * 1024,
) -> dict[str, str]:
    """Session settings sized for a job whose largest shuffle carries ``shuffle_input_bytes``.

    The widest shuffle here is the full-row distinct of silver (every surviving raw column).
    Start with enough partitions that each holds ~``target_partition_bytes``; AQE coalesces
    the small ones and splits skewed ones at runtime.
    """
    partitions = max(8, -(-shuffle_input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": SESSION_DEFAULTS["spark.sql.streaming.stateStore.providerClass"],
    }
