"""Top rows, representatives, samples and quotas. Every order ends in a unique key, so results don't depend on arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lorekeeper.operators.storage import shared_folder


def first_by(df: DataFrame, keys: list[str], order: list, k: int = 1) -> DataFrame:
    """The first k rows of each key in the given order. Spark keeps k rows a key before it shuffles (window group limit)."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows numbered from 0 in the order of columns that no two rows share, without gathering them in one task.

    The rows are ranged and sorted once, and checkpointed with their partition and their place in it;
    both the rows and the counts of the partitions before, a table of one row a partition, are read from
    there. Bounds sampled twice, or partitions merged in two ways, would tear the numbers.
    """
    shared_folder(df.sparkSession)
    place = F.monotonically_increasing_id()  # partition << 33 | place
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place).checkpoint()
    ranged = ranged.withColumn("_part", F.shiftright("_place", 33)).withColumn("_at", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(before), "_part").withColumn(name, F.col("_at") + F.col("_before")).drop("_place", "_part", "_at", "_before")


def even_positions(n: Column, count: int) -> Column:
    """count positions spread evenly over 0..n-1, ends included, halves to even."""
    step = (n - 1) / F.lit(max(count - 1, 1))
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.bround(i * step, 0).cast("long")))


def spread(df: DataFrame, order: list[str], count: int) -> DataFrame:
    """count rows spread evenly over a total order, first and last included; all rows where there are no more."""
    at = numbered(df, order, "_slot")
    wanted = df.agg(F.count("*").alias("n")).select(F.explode(F.when(F.col("n") > count, even_positions(F.col("n"), count)).otherwise(F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0))))).alias("_slot"))
    return at.join(F.broadcast(wanted), "_slot", "left_semi").drop("_slot")  # count rows at most


def top_label(df: DataFrame, key: str, label: str) -> DataFrame:
    """The most frequent label of each key, the smaller label on a tie."""
    counted = df.where(F.col(label).isNotNull()).groupBy(key, label).agg(F.count("*").alias("_n"))
    return counted.groupBy(key).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(label).alias("v"))).alias("_t")).select(key, F.col("_t.v").alias(f"top_{label}"))
