"""Session settings and the shared folder used for tables written between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.ansi.enabled": "true",
}

# On a cluster shuffles start fine-grained and AQE merges them to its advisory size; 200 partitions would spill.
_CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.files.maxPartitionBytes": "256MB",
}


def build_session(master: str | None = None, app: str = "visitledger", **conf: str) -> SparkSession:
    """Session with the settings the loads expect; anything given as ``conf`` wins."""
    local = master is not None and master.startswith("local")
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_CONF, **({} if local else _CLUSTER_CONF), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_base: str | None = None


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Only a local session (tests, laptop) may fall back to a temporary folder of its own; on a cluster the
    executors would not see it, so an unset folder is an error there.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        _local_base = _local_base or tempfile.mkdtemp(prefix="visitledger-")
        base = _local_base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
