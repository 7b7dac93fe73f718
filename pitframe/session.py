"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench. On a cluster the submit command decides these settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pitframe")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PITFRAME_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and written intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Executors of a cluster do not see a folder that the driver makes for itself, so a missing setting is an error there. A local
    master has one machine only and gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="pitframe-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", shared)
    spark.sparkContext.setCheckpointDir(shared)
    return shared
