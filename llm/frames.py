"""Shared plumbing: tables, bounded Arrow slices, and intermediate tables in the shared folder."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekeeper.operators.storage import shared_folder

#: Bytes of text that are worked on at once; a single longer text makes a slice of its own.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder: a cut lineage that survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of batches in order, in pieces whose text column holds at most ``limit`` bytes (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < n:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
    release()


def release() -> None:
    """Gives freed memory back at the end of a task: its Python worker stays for the tasks of later stages, beside a JVM that needs the room."""
    pa.default_memory_pool().release_unused()
    if (trim := _trim()) is not None:
        trim(0)


@lru_cache(1)
def _trim():
    """The C library's malloc_trim, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


#: Ids that a join may broadcast (8 bytes each and as much again for their table); more are joined by a shuffle.
BROADCAST_IDS = 500_000


def broadcast_if_few(ids: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """A stored table of ids, marked for broadcast when a count shows that it has at most ``limit`` rows."""
    return F.broadcast(ids) if ids.limit(limit + 1).count() <= limit else ids


def nested(docs: DataFrame, **more) -> DataFrame:
    """Every row of docs as one column ``row``, beside more columns, whose names can't clash with the row's own."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *[c.alias(name) for name, c in more.items()])


def row_order(docs: DataFrame, first: str) -> F.Column:
    """A value of the nested ``row`` that rows of docs can be ordered by: the column ``first``, then the others; maps and what holds them count as their JSON."""
    names = [first, *[c for c in docs.columns if c != first]]
    unordered = {f.name for f in docs.schema.fields if re.search(r"map<|variant|geometry|geography", f.dataType.simpleString())}
    cell = lambda c: F.to_json(F.struct(F.col("row")[c])) if c in unordered else F.col("row")[c]
    return F.struct(*[cell(c).alias(f"c{k}") for k, c in enumerate(names)])
