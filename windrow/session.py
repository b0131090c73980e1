"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import contextlib
import math
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

_LOCAL_DIRS: dict[str, str] = {}  # application id -> folder, local mode without the setting only

BASE_CONF = {
    # all clock arithmetic is done in UTC; zones are explicit parameters
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # checkpointed intermediate tables go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # unbounded running counts and wide windows outgrow a heap-held state store
    STATE_STORE:
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the library's settings; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cluster_conf(shuffled_bytes: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Shuffle settings for a job that moves about `shuffled_bytes` in its largest exchange.

    The exchange starts with enough partitions to keep each near `partition_bytes`; adaptive
    execution merges those that turn out small, so over-estimating is cheap.
    """
    partitions = max(200, math.ceil(shuffled_bytes / partition_bytes))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
    }


def require_utc(spark: SparkSession) -> None:
    """Zone arithmetic on instants is only right when the session itself does not shift them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone!r})")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: what the cluster names in `spark.checkpoint.dir`.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/windrow/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streaming queries started inside keep their state in RocksDB, whatever the session says; state with timers needs it.

    A query copies the session's settings when it starts, so others are not touched.
    """
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, BASE_CONF[STATE_STORE])
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def let_workers_import(spark: SparkSession) -> None:
    """Python workers on this machine find the package wherever the session was started from.

    On a cluster the package is installed or sent with `--py-files`.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def enable_checkpoints(spark: SparkSession) -> None:
    """Let `DataFrame.checkpoint()` write to the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
