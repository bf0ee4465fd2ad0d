"""SparkSession factory and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every job of this package relies on. They are applied with
# ``setIfMissing`` semantics by :func:`get_session`, so a cluster's own
# spark-defaults win.
JOB_CONF = {
    # adaptive execution: coalesce small shuffle partitions, split skewed join
    # partitions, turn sort-merge joins with a small measured side into
    # broadcast joins at run time
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only what has a proven size: never from planning-time
    # estimates (compressed file sizes), only from measured shuffle output at
    # run time, or from an explicit hint behind a size check (operators/joins)
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # overwrite only the date partitions a run produces (sink K1)
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # timestamps in the inputs are wall-clock Eastern time without zone; never
    # shift them
    "spark.sql.session.timeZone": "UTC",
    # delete checkpoint files (lineage cuts) once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "visitlens",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, creating one with :data:`JOB_CONF` if needed."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(JOB_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    # what the cluster's spark-defaults or submit options set stays as it is
    set_by_cluster = dict(SparkConf().getAll())
    for k, v in conf.items():
        if k in (extra or {}) or k not in set_by_cluster:
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in JOB_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    On a cluster this is ``spark.checkpoint.dir`` as configured by the cluster
    (a shared file system). Only when it is unset and the master is local - one
    machine, as in tests - a private folder under the local temp directory is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="visitlens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for reading results back in tests)."""
    return path[len("file:"):] if path.startswith("file:") else os.fspath(path)


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str):
    """Set a SQL conf for the duration of a block, then restore it."""
    prev = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if prev is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, prev)
