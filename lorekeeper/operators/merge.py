"""Writes without in-place updates: each takes the old rows and new ones, and gives the table's next state.

Run twice with the same new rows, each gives the same state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """New rows replace old ones of their key; among new rows of one key the last by ``order`` counts."""
    if order is not None:
        w = W.partitionBy(*keys).orderBy(F.desc(order))
        new = new.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*old.columns))


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows stay; new rows of other keys are added."""
    return old.unionByName(new.select(*old.columns).dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"))


def fill_nulls(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Null cells of old take the value of the new row of their key."""
    other = new.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    filled = old.join(other, keys, "left")
    return filled.select(*[F.coalesce(c, f"_{c}").alias(c) if c in columns else F.col(c) for c in old.columns])


def update_where(old: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """Cells of the rows that meet the condition replaced; null conditions count as not met."""
    met = F.coalesce(condition, F.lit(False))
    return old.withColumns({c: F.when(met, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_unreferenced(old: DataFrame, references: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(references.select(*keys), keys, "left_semi")


def replace_group(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All old rows of a key that new names go; new's rows come."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new.select(*old.columns))


def merge_counters(old: DataFrame, batch: DataFrame, key: str, sums: list[str]) -> DataFrame:
    """Counters by key added up over both, with how many batches each key has seen."""
    tag = lambda df, n: df.select(key, *sums, (F.col("attempts") if "attempts" in df.columns else F.lit(n)).cast("long").alias("attempts"))
    return tag(old, 1).unionByName(tag(batch, 1)).groupBy(key).agg(*[F.sum(c).alias(c) for c in sums], F.sum("attempts").alias("attempts"))


def numbered_after(old: DataFrame, new: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """new with ids that follow old's greatest one, in a total order of new."""
    from lorekeeper.operators.ranking import numbered

    top = old.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_top"))
    return numbered(new, order, "_number").join(F.broadcast(top)).withColumn(id_col, F.col("_top") + F.col("_number") + 1).drop("_top", "_number")  # one row is broadcast
