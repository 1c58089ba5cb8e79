"""Where intermediate tables go: the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, a local master gets a folder of our own; a cluster has to name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lorekeeper-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder
