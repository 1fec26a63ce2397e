"""Session construction and shared-folder lookup.

Library code never builds its own session; it takes the caller's.  The
helpers here are for tests, the bench and the command-line jobs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every job in this package.  AQE re-plans joins
# and coalesces small shuffle partitions at runtime; the session zone is
# pinned so timestamp arithmetic does not depend on the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # A user's rows of one task merge into partial sessions before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Keyed streaming state lives in RocksDB: it spills to local disk instead
    # of holding every key on the executor heap (and transformWithState
    # requires it).
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "trailmix", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FALLBACK: dict[int, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to a shared filesystem and is
    used as is.  Only when it is unset and everything runs in this process
    (master ``local``: tests) do we pick a fresh scratch folder for this
    session; on a cluster a machine's own folder would lose state, so an unset
    folder is an error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        key = id(spark)
        if key not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="trailmix-ckpt-")
        path = _LOCAL_FALLBACK[key]
    spark.sparkContext.setCheckpointDir(path)
    return path


def checkpoint_location(spark: SparkSession, query_name: str, root: str | None = None) -> str:
    """Per-query streaming checkpoint folder under ``root`` (default: the
    shared folder)."""
    return os.path.join(root or os.path.join(ensure_checkpoint_dir(spark), "streams"), query_name)
