"""Spark session settings the library assumes.

On a cluster the caller owns the session; ``configure`` only fills in the
settings the jobs rely on (UTC, AQE) and never overrides a checkpoint
directory the cluster already names.  ``local_session`` is for tests and
the bench.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job assumes.  AQE re-plans joins from runtime sizes
# (sort-merge -> broadcast when a side turns out small, skew splitting)
# and coalesces small shuffle partitions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only a local session
    (tests, bench) gets a fresh scratch directory of its own when the setting
    is missing; on a cluster a missing setting is an error, because executors
    do not share the driver's disk.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="smelter-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared checkpoint folder, for written tables.

    Every call returns a new path (a random id is part of it), on local and
    remote file systems alike, so that two runs never meet in one folder.
    The folder itself is created by whatever writes to it first.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "smelter") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SMELTER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # local runs keep catalog tables out of the working directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="smelter-warehouse-", dir="/tmp"))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def materialize(df, name: str = "table", partition_by: list[str] | None = None):
    """Cut lineage with a Parquet table in the shared checkpoint folder.

    Used before iterative work (model fits, cross-validation) so that folds
    and iterations read the prepared rows instead of recomputing the whole
    upstream plan.  Unlike an RDD checkpoint the table keeps column pruning,
    filter pushdown and size statistics; a lost executor costs a re-read.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
