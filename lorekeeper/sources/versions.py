"""Tables that are written together or not at all: versions of a folder, each complete or unseen."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DONE = "_COMPLETE"


def _children(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def current(spark: SparkSession, folder: str) -> str | None:
    """The folder of the newest complete version."""
    done = [name for name in _children(spark, folder) if name.startswith("v") and f"{_DONE}" in _children(spark, f"{folder}/{name}") and "_SUCCESS" in _children(spark, f"{folder}/{name}/{_DONE}")]
    return f"{folder}/{max(done)}" if done else None


def write_together(tables: dict[str, DataFrame], folder: str) -> str:
    """Writes all tables as the next version. Its mark is written last: readers see all of its tables or the version before."""
    spark = next(iter(tables.values())).sparkSession
    last = current(spark, folder)
    number = int(last.rsplit("/v", 1)[1].split("-")[0]) + 1 if last else 1
    path = f"{folder}/v{number:08d}-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")
    spark.createDataFrame([(n,) for n in sorted(tables)], "name string").coalesce(1).write.json(f"{path}/{_DONE}")
    return path


def read_together(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the newest complete version; none where there is no version."""
    path = current(spark, folder)
    if path is None:
        return {}
    return {r["name"]: spark.read.parquet(f"{path}/{r['name']}") for r in spark.read.json(f"{path}/{_DONE}").select(F.col("name")).collect()}
