"""Ordered rules as one expression, and what a rule decides besides its name by a join with a small table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ladder(rules: list[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first rule that is met; null conditions aren't."""
    out = F
    for condition, value in rules:
        out = out.when(condition, value)
    return out.otherwise(default)


def mentions(text: Column, terms: list[str]) -> Column:
    """Whether a text holds any of some terms as they stand: one pattern, one pass."""
    return text.rlike("|".join(map(re.escape, terms)))


def hits(text: Column, terms: list[str]) -> Column:
    """The terms that a text holds, in the order given."""
    return F.array_compact(F.array(*[F.when(F.contains(text, F.lit(t)), t) for t in terms]))


def described(df: DataFrame, branch: Column, table: list[tuple], schema: str) -> DataFrame:
    """df with a branch column and the columns that the table gives for each branch (a handful of rows, broadcast)."""
    names = F.broadcast(df.sparkSession.createDataFrame(table, schema))
    return df.withColumn("branch", branch).join(names, "branch", "left")
