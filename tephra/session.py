"""Session set-up and the shared work folder.

Every query in this package assumes a UTC session clock: the stored
timestamps carry no zone, the tooltips print a literal ``UTC`` and the
day boundaries of all date partitions are UTC days.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Runtime SQL settings the pipeline relies on; safe to apply to a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Plain text of decimals, errors instead of silent nulls.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # Commit a change log per batch instead of a full state snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One memory budget for all state partitions an executor holds.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


# Shuffle partitions of a local session that names none; a cluster's come from spark-submit.
LOCAL_SHUFFLE_PARTITIONS = 8


def build_session(
    master: str | None = "local[*]",
    app_name: str = "tephra",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests, the bench and command-line runs.

    On a cluster, pass ``master=None`` and let spark-submit decide. Without
    ``shuffle_partitions`` the submitted value (or Spark's default) stays; only
    a local master gets a small one.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RUNTIME_CONF)
    conf.update({"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = LOCAL_SHUFFLE_PARTITIONS
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide scratch root, taken from ``spark.checkpoint.dir``.

    Only a local session may do without the setting: it gets a temporary folder.
    On a cluster that folder would be on one machine, so there it is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="tephra-ckpt-")
    if not sc.getCheckpointDir():
        # Registered, so that checkpoint() works and later calls find the same folder.
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared root for one job run."""
    return f"{shared_dir(spark)}/tephra/{name}-{uuid.uuid4().hex[:12]}"
