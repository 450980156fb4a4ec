"""Spark session with the settings the jobs are designed for.

Cluster settings win: every option below is applied only when the
session does not set it already, so a cluster's own shuffle size,
broadcast threshold or checkpoint folder is never overridden.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the plans rely on.  AQE re-plans joins from runtime sizes
# (broadcast only below the threshold, sort-merge beyond), coalesces small
# shuffle partitions and splits skewed ones.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    # Split a hot key even when the split costs an extra shuffle downstream
    # (e.g. a later join that reuses the line join's partitioning).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Spark's own runtime filter: before a large side of a join is shuffled, its
# rows are checked against a Bloom filter over the other side's keys.  The
# line and task streams are joined to the few opportunities of a window, so
# most of their rows end here.  As Spark sets it up, it needs 10 GB scans and
# a small other side; here it starts with scans of 64 MB, and the filter (8 MB
# at most, whatever the input) is sized for 16 million keys.  With more keys it
# lets more rows pass, which the join then drops.
_FILTER = "spark.sql.optimizer.runtime.bloomFilter"
RUNTIME_FILTERS = {
    f"{_FILTER}.applicationSideScanSizeThreshold": "64m",
    f"{_FILTER}.creationSideThreshold": "1t",
    f"{_FILTER}.expectedNumItems": "16000000",
    f"{_FILTER}.maxNumItems": "16000000",
    f"{_FILTER}.numBits": str(8 * 8 * 1024 * 1024),
}


@contextmanager
def runtime_filters(spark: SparkSession) -> Iterator[None]:
    """Use ``RUNTIME_FILTERS`` for the jobs started inside, except where the session has a setting of its own."""
    added = [k for k in RUNTIME_FILTERS if spark.conf.get(k, None) is None]
    try:
        for k in added:
            spark.conf.set(k, RUNTIME_FILTERS[k])
        yield
    finally:
        for k in added:
            spark.conf.unset(k)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench (local mode, small shuffles)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("dimstar")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# On a cluster that sets no shuffle width, the largest shuffles (fact streams
# of tens of TB) get partitions of ~128-256 MB, and AQE coalesces the many
# small shuffles back down.
CLUSTER_SHUFFLE_PARTITIONS = 16384


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Prepare a cluster session: settings above where unset, a sized shuffle, a checkpoint folder.

    ``shuffle_partitions`` sets the shuffle width; without it a width that
    the cluster or the session has set, 200 included, is left alone.
    """
    for key, value in DEFAULTS.items():
        if key.startswith("spark.ui."):
            continue  # static; only settable at launch
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    if shuffle_partitions or "spark.sql.shuffle.partitions" not in spark.conf.getAll:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions or CLUSTER_SHUFFLE_PARTITIONS))
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; create a scratch one only when unset.

    The fallback is for local runs and tests; on a cluster
    ``spark.checkpoint.dir`` must name a shared, fault-tolerant folder.
    """
    existing = checkpoint_dir(spark)
    if existing:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(existing)
        return existing
    master = spark.sparkContext.master
    if not re.match(r"local($|\[)", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines share (master {master})")
    # spark.checkpoint.dir cannot be changed at runtime; the context's folder
    # is what checkpoint() and checkpoint_dir() use.
    folder = tempfile.mkdtemp(prefix="dimstar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir() or folder


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (one per run, never reused)."""
    import uuid

    return os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), kind, uuid.uuid4().hex)
