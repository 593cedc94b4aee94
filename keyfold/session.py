"""Session helpers: where scratch output goes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir / the checkpoint dir).

    On a cluster this is set by the deployment and is visible to every executor.
    Only when nothing is configured (local tests) do we pick a local directory
    and register it, so later calls agree.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="keyfold-")  # one machine: any folder is shared
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique directory under the shared root."""
    return f"{shared_root(spark).rstrip('/')}/keyfold/{label}-{uuid.uuid4().hex[:12]}"


def spread(df: DataFrame) -> DataFrame:
    """Give row-heavy work at least the cluster's parallelism.

    A scan of a file with a single row group is a single task, and everything
    up to the first shuffle (JSON building and parsing here) would run there.
    When the input already has enough splits (the normal case at scale) this
    is a no-op; otherwise one round-robin exchange spreads the rows. Spark
    sorts before a round-robin repartition, so a retried task gets the same rows.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)
