"""Centroid clustering by weighted deduplication: Lloyd's rounds over distinct quantised vectors.

Vectors become integers, equal ones one class with its multiplicity. A round reads the classes, gives
each its nearest centroid, and adds up integers weighted by multiplicity: one partial sum for each
partition, cluster and component, so that a round shuffles no vectors. Assignments go back to the ids
by the digest of the class; classes of very many rows are broadcast, so no row of theirs is moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.components import lookup
from llm.frames import stored

#: Largest magnitude of a quantised component: squared distances of 64 of them, and weighted sums over 2^36 rows, fit in 64 bits.
LIMIT = 1 << 27


def quantised(vectors: DataFrame, scale: int, dim: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, q) of the rows that take part: q is the vector's integers floor(scale * x)."""
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].cast("array<double>").alias("v"))
    rows = rows.where(F.coalesce((F.size("v") == dim) & F.forall("v", lambda x: F.coalesce(F.abs(x * scale) < LIMIT, F.lit(False))), F.lit(False)))
    return rows.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("int")).alias("q"))


def nearest(q: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every vector, the first of equally near ones, and its squared distance, in exact integers."""
    largest = max(int(np.abs(q).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    exact = np.float64 if 4 * q.shape[1] * largest * largest < 1 << 53 else np.int64
    x, c = q.astype(exact), centroids.astype(exact)
    distances = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
    who = distances.argmin(1)
    return who, distances[np.arange(len(q)), who].astype(np.int64)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(classes: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Multiplicity and weighted sums of every cluster that has vectors."""
    k, dim = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = np.zeros((k, dim + 1), np.int64), np.zeros(k, bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            n, q = batch.column(0).to_numpy(), _matrix(batch.column(1), dim).astype(np.int64)
            who, _ = nearest(q, centroids)
            for c in np.unique(who):
                at = who == c
                sums[c, 0] += n[at].sum()
                sums[c, 1:] += n[at] @ q[at]
                seen[c] = True
        told = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(told, dim + 1).astype(np.int32)), pa.array(np.tile(np.arange(dim + 1, dtype=np.int32), len(told))), pa.array(sums[told].ravel())], ["cluster", "place", "part"])

    parts = classes.select("n", "q").mapInArrow(partial, "cluster int, place int, part long")
    found: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():  # k * (dim + 1) rows at most
        found.setdefault(r["cluster"], [0] * (dim + 1))[r["place"]] = int(r["total"])
    return {c: (s[0], s[1:]) for c, s in found.items()}


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, scale: int = 1024, dim: int = 64, salt: str = "3", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for every vector that takes part.

    A vector takes part when it has exactly ``dim`` components, none of them null, NaN, infinite or of a
    magnitude from LIMIT / scale on, whose squared distances would not fit in a long. Components become floor(scale * x).
    Centroids start as the k vectors whose sha256 of "salt:id" is least (null ids last, equal hashes by the vector), all
    of them where there are fewer. Equal distances go to the smaller number, means are floored, empty
    centroids stay. Every row counts, repeated rows and ids too; other columns play no part; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, scale, dim, id_col, vector_col)
    hashed = rows.select(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256).alias("h"), "q")
    starts = [r["q"] for r in hashed.orderBy(F.asc_nulls_last("h"), "q").limit(k).collect()]
    members = stored(rows.select("id", F.unhex(F.md5(F.array_join("q", ",").cast("binary"))).alias("cls")), "members")
    classes = rows.select(F.unhex(F.md5(F.array_join("q", ",").cast("binary"))).alias("cls"), "q").groupBy("cls").agg(F.count("*").alias("n"), F.first("q").alias("q"))
    classes = stored(classes, "classes")
    centroids = np.array(starts, np.int64).reshape(-1, dim)
    for _ in range(rounds if len(starts) else 0):
        before = centroids.copy()
        for c, (n, sums) in _sums(classes, centroids).items():
            centroids[c] = [s // n for s in sums]
        if (before == centroids).all():
            break  # every later round would give the same

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                who, distance = nearest(_matrix(batch.column(2), dim).astype(np.int64), centroids)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(who.astype(np.int32)), pa.array(distance)], ["cls", "degree", "cluster", "distance"])

    assigned = stored(classes.select("cls", "n", "q").mapInArrow(assign, "cls binary, degree long, cluster int, distance long"), "assigned")
    totals = {r["cluster"]: (int(r["own"]), int(r["n"])) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)") * F.col("degree")).alias("own"), F.sum("degree").alias("n")).collect()}
    inertia, total = sum(own for own, _ in totals.values()), sum(n for _, n in totals.values())
    facts = [(c, own, inertia, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, (own, _) in totals.items()]
    facts = F.broadcast(spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))  # k rows at most
    out = lookup(members, assigned, "cls", total).join(facts, "cluster")
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
