"""Session helpers: runtime settings every job relies on, and the shared folder.

Nothing here creates cluster resources.  ``tune`` only sets SQL runtime
options that are safe to set on an existing session; ``shared_dir`` hands out
fresh folders below the folder the cluster names in ``spark.checkpoint.dir``
(read from the session, set locally only when it is missing, as in tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime options.  Time zone: log lines carry an explicit offset, so
# instants are parsed exactly and rendered in UTC (decision D1).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partial top-k per window partition before the shuffle (row_number <= k)
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime options; returns the same session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keyed streaming state (IP, URI keys grow without bound) in RocksDB.

    Only takes effect for queries started afterwards with a fresh checkpoint.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def build_session(master: str | None = None, app: str = "hitlens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local / test session.  On a cluster use the session spark-submit gives."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session.  Only a local master without one (tests) gets a
    folder of its own; on a cluster that is an error, since executors would
    write to their own disks.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="hitlens-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/hitlens/{name}-{uuid.uuid4().hex[:12]}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made below the shared folder."""
    root = checkpoint_root(spark).rstrip("/") + "/hitlens/"
    if not path.startswith(root):
        raise ValueError(f"{path} is not below {root}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
