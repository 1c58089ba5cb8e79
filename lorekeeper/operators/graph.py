"""Connected parts of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeeper.operators.storage import shared_folder


def parts(edges: DataFrame) -> DataFrame:
    """(node, part): the smallest node that each node of edges (a, b) is connected with.

    Every round points the greater neighbours of a node to its least one, then all of its smaller neighbours and itself; rounds follow
    the logarithm of the longest path, and each is checkpointed. A node of very many edges is left to the adaptive splitting of skewed joins.
    """
    shared_folder(edges.sparkSession)
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct().checkpoint()
    seen = None
    while True:
        told = now.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(20,0)"))).first()
        if told == seen:
            break
        seen = told
        both = now.unionAll(now.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.least(F.min("low"), F.col("high")).alias("m"))
        up = both.join(least, "high").where("low > high").select(F.col("low").alias("high"), F.col("m").alias("low")).distinct().checkpoint()
        lowest = up.groupBy("high").agg(F.min("low").alias("m"))
        down = up.join(lowest, "high").where("low <> m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        now = down.unionAll(lowest.select("high", F.col("m").alias("low"))).distinct().checkpoint()
    roots = now.select(F.col("low").alias("node")).distinct()
    return now.select(F.col("high").alias("node"), F.col("low").alias("part")).unionAll(roots.select("node", F.col("node").alias("part")))
