"""Spark session and shared-storage helpers.

Every job in the library runs on whatever session the caller hands in. This
module only builds a session for local runs (tests, bench) and resolves the
shared folder used for checkpoints and intermediate tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at any scale: adaptive execution re-plans joins from
# measured sizes, coalesces small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    # No broadcast from static (file-size) estimates: a compressed fact table
    # can look small. AQE converts a join to broadcast only after measuring
    # the shuffled side at runtime, under the adaptive threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "skyledger",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    cluster is expected to name a shared ``spark.checkpoint.dir``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    # ranking checkpoints a sorted copy per call; delete it once unreferenced
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
        conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="skyledger-wh-")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local session without one gets a scratch folder;
    a cluster session without one is an error, because a machine-local
    folder would not survive the loss of the executor that wrote it.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if d:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
    if not d:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        d = tempfile.mkdtemp(prefix="skyledger-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for an intermediate table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the time of some jobs."""
    old = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def scan_tasks(spark: SparkSession, tasks: int):
    """Scans in this block get at least ``tasks`` tasks, as far as there are files:
    Spark packs small files by bytes, and a compressed byte holds many rows."""
    return setting(spark, "spark.sql.files.minPartitionNum", str(max(tasks, spark.sparkContext.defaultParallelism)))


def released_shuffles(spark: SparkSession):
    """Writes in this block give their shuffle files back when they end; Spark else keeps
    them until the driver happens to collect its garbage. For data frames that run once."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so plain-Python checks can see local paths."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
