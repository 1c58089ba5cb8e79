"""Aliases of a lexicon table in texts, and what records are by their best alias."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekeeper.functions import text as t
from lorekeeper.operators.gazetteer import first_mentions
from lorekeeper.operators.ranking import first_by
from lorekeeper.operators.rules import ladder

#: Kinds of aliases that tell less (fixed values).
UNSURE = ("noise_sensitive", "historical_descriptor")


def confidence(alias: Column, kind: Column) -> Column:
    return F.when(F.char_length(alias) <= 4, "low").when(kind.isin(*UNSURE), "medium").otherwise("high")


def matches(docs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(doc_id, alias_id, p, confidence, and what else the lexicon tells): aliases that texts hold as words, in any case and over any white space.

    docs has (doc_id, text), lexicon (alias_id, alias, kind, ...). p is the first place in the lower-case
    text with its white space collapsed. A lexicon of any size is one pass over the texts.
    """
    flat = docs.select("doc_id", F.lower(t.collapsed(F.col("text"))).alias("text"))
    names = lexicon.select(F.col("alias_id").alias("item_id"), F.lower(t.collapsed(F.col("alias"))).alias("name"))
    found = first_mentions(flat, names, 0).select("doc_id", F.col("item_id").alias("alias_id"), (F.col("start") + 1).alias("p"))
    return found.join(lexicon, "alias_id").withColumn("confidence", confidence(F.col("alias"), F.col("kind")))


def classify(docs: DataFrame, lexicon: DataFrame, reviewed: Column) -> DataFrame:
    """(doc_id, figure, relevance, confidence) of every document: by the alias of highest priority, then the longest, then the first in order.

    docs has (doc_id, text) and what the condition ``reviewed`` reads; lexicon also has (figure, priority).
    """
    order = [F.desc("priority"), F.desc(F.char_length("alias")), "alias", "alias_id"]
    best = first_by(matches(docs, lexicon), ["doc_id"], order).select("doc_id", "figure", "confidence")
    j = docs.withColumn("_reviewed", F.coalesce(reviewed, F.lit(False))).select("doc_id", "_reviewed").join(best, "doc_id", "left")
    relevance = ladder([(F.col("figure").isNull(), "lead_only"), (F.col("_reviewed"), "requires_review")], "relevant")
    return j.select("doc_id", F.coalesce("figure", F.lit("unmatched")).alias("figure"), relevance.alias("relevance"), F.coalesce("confidence", F.lit("none")).alias("confidence"))
