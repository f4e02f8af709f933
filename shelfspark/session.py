"""Session building and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "shelfspark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; anything else stays with the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or else a folder in the warehouse."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    For frames that several jobs read: it survives lost executors, keeps column pruning and file
    statistics for the planner, and cuts the lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def series_partitions(spark: SparkSession) -> int:
    """Partition count for per-series work.

    Gap filling and model fits turn a small shuffle into a lot of work, so byte-based
    coalescing would leave them on a handful of tasks.
    """
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
