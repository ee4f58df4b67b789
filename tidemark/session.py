"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE carries the skew handling of every join here: a shuffle partition that a
# hot key makes too large is split at run time, small ones are merged.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Tasks of a plan that run at a time share the cluster evenly.
    "spark.scheduler.mode": "FAIR",
    "spark.sql.orc.filterPushdown": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings the plans rely on; sizing is left to the cluster."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one of ``spark.checkpoint.dir``, else one beside the warehouse's tables."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        _refuse_local_folder(spark)
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _refuse_local_folder(spark: SparkSession) -> None:
    """On a cluster a warehouse folder of the driver alone cannot be shared."""
    folder, master = spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master
    if not master.startswith("local") and folder.startswith(("file:", "/")):
        raise ValueError(f"set spark.checkpoint.dir: {folder} may be a folder of the driver alone")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable on this session."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, what an action has shuffled is removed at its end, not when the driver happens to collect its garbage.

    For steps that end in a checkpoint or a few rows: a DataFrame made within that runs twice shuffles twice.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """Path of a fresh folder inside the shared one; it is not created yet."""
    return f"{shared_folder(spark).rstrip('/')}/{label}_{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, through the file system that Spark reads it by."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_database(spark: SparkSession, label: str) -> str:
    """Create a fresh database inside the shared folder and return its name."""
    folder = scratch_folder(spark, label)
    name = folder.rsplit("/", 1)[1]
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{folder}'")
    return name
