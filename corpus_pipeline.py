"""A training-data pipeline over documents: five stages, each a filter or a rewriting that the next one builds on."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.bpe import encode_documents
from llm.decontamination import without_leaking_texts
from llm.frames import stored, table
from llm.near_dup import one_of_each
from llm.pii import with_pseudonyms
from llm.queries import PSEUDONYM_KEY
from llm.toxicity import fit, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the multiple-instance model, trained on the labels, calls toxic go."""
    return without_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, the one with the smallest id stays."""
    return one_of_each(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose own text holds a benchmark item, edited or not, go; ids play no part."""
    return without_leaking_texts(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts give way to pseudonyms of their format; n_chars follows the new text."""
    return with_pseudonyms(docs, PSEUDONYM_KEY).withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long")).select(docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digests of ids and decoded bytes of every document that is left."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(docs, path, public_tokenizers.PATTERN).drop("exact")


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("bpe", bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written to the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs


#: The models of the first stage and the pseudonyms of the fourth are beyond SQL: tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None
