"""Spark session helpers.

Everything in the library takes a ``SparkSession`` from the caller; these helpers
only build one for tests, the bench and the smoke entry, and find the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library relies on (all public Spark options).
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Duplicate INFO keys: the last one wins, as in the VCF loaders.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "helixspark") -> SparkSession:
    """A local session for tests and benches (UI off, no extra ports)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the settings the library needs to an existing session."""
    for k, v in CORE_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    if spark.conf.get("spark.sql.mapKeyDedupPolicy") != "LAST_WIN":
        raise RuntimeError("spark.sql.mapKeyDedupPolicy must be LAST_WIN: the last of two equal INFO keys wins")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session. Only a local master may run without one (tests): a fresh
    scratch folder is then made and set. On a cluster an unset folder is an error, as
    executors do not share the driver's local folders.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="helix-ckpt-")
        sc.setCheckpointDir(d)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a fresh table in the shared checkpoint folder, read back. Every reader sees the
    same rows, so a column that depends on partitioning can be joined on."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)
