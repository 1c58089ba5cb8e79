"""Connected components of an undirected graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.frames import shared_folder

#: Keys whose values a lookup may broadcast, and the least number of rows that makes a key one of these.
HUBS, HUB_DEGREE = 50_000, 256


def lookup(rows: DataFrame, values: DataFrame, key: str, total: int) -> DataFrame:
    """rows with the values (key, ..., degree) of their key, no key's rows being gathered.

    degree says how many rows a key has, and total is at least the sum of degrees. A hub is a key of more
    than total / HUBS rows: there are no more than HUBS of them and their values are broadcast, so a hub's
    rows stay where they are. The rows of all other keys, few for each, meet their values by a shuffle.
    """
    bound = max(HUB_DEGREE, total // HUBS)
    hubs = F.broadcast(values.where(F.col("degree") > bound).drop("degree"))
    others = values.where(F.col("degree") <= bound).drop("degree")
    return rows.join(hubs, key).unionAll(rows.join(hubs, key, "left_anti").join(others, key))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b), root being the smallest node of its component.

    Nodes may be of any orderable type. Self-loops, repeated edges and both directions are fine; an
    empty table gives an empty one. Minima and degrees are combined before they are shuffled, the edges
    of a hub are never gathered, and each round is checkpointed.
    """
    shared_folder(edges.sparkSession)
    proper = edges.where("a <> b")
    e = proper.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    n, before = e.count(), None
    minima = lambda x: x.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree"))
    while n:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = minima(both).withColumn("m", F.least("u", "m"))
        large = lookup(both, least, "u", 2 * n).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().checkpoint()
        lowest = minima(large)
        small = lookup(large, lowest, "u", 2 * n).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.unionAll(lowest.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        # The sum of hashes changes whenever the edges do.
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == before:
            break
        n, before = now[0], now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def named_components(members: DataFrame, roots: DataFrame, total: int) -> DataFrame:
    """members (cls, least_id, ...) with component_id, the smallest least_id of their component; a class without a root is its own.

    roots is what components gives, with nodes named cls; total is the number of members or more.
    """
    told = members.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    smallest = told.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("degree"))
    return lookup(told, smallest, "root", total).drop("root", "least_id")
