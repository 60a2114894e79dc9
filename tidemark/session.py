"""Session construction and the shared storage folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names;
it is only filled in here when it is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that every session of this library should carry.  AQE re-plans
# joins and shuffle partition counts at runtime and splits skewed join
# partitions; UTC keeps date arithmetic independent of the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (~100 TB inputs, ~1000 executors).  Scan
# splits of 512 MB keep task counts in the hundreds of thousands; shuffles
# start wide and AQE coalesces them to ~256 MB partitions, so no single
# reducer has to hold a multi-GB partition; skewed join partitions above
# 1 GB (and 5x the median) are split.  Auto-broadcast stays at Spark's
# default and AQE re-decides from measured shuffle sizes.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def apply_cluster_conf(spark: SparkSession) -> None:
    """Set the runtime-changeable part of ``CLUSTER_CONF`` on an existing session."""
    for k, v in CLUSTER_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; we never
    override it.  When it is unset and the master is local (tests, bench) a
    fresh folder under the system temp dir is used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
            spark.conf.set("spark.checkpoint.dir", current)
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared folder for written tables and stream state."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return os.path.join(base, "tidemark", *tail)
