"""The registered query of every operator: production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from llm.bpe import encode_documents
from llm.clustering import cluster
from llm.decontamination import find_leaks
from llm.embeddings import near_vectors
from llm.extraction import extract_text, labeller
from llm.frames import table
from llm.hard_negatives import hard_negatives
from llm.language_id import fit as fit_languages, identify
from llm.language_model import score_documents as score_language
from llm.near_dup import near_duplicates
from llm.oracles import OP5, OP6, OP10, OP11, OP13
from llm.pii import pseudonymise
from llm.secrets import find_secrets
from llm.token_counts import count_by_section
from llm.toxicity import fit, score_documents


#: The key of the registered query; a deployment passes its own.
PSEUDONYM_KEY = b"demonstration key"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), labeller())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, keep_ids=False).drop("exact")


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return count_by_section(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_language(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit_languages(docs))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_html": op2_html,
    "op3_decontamination": op3_decontamination,
    "op4_bpe": op4_bpe,
    "op5_near_dup": op5_near_dup,
    "op6_embeddings": op6_embeddings,
    "op7_token_counts": op7_token_counts,
    "op8_language_model": op8_language_model,
    "op9_toxicity": op9_toxicity,
    "op10_secrets": op10_secrets,
    "op11_clustering": op11_clustering,
    "op12_language_id": op12_language_id,
    "op13_hard_negatives": op13_hard_negatives,
}

#: The others are beyond SQL and held against brute force, libraries or held-out accuracy in tests/llm.
ORACLE_SQL: dict[str, str] = {"op5_near_dup": OP5, "op6_embeddings": OP6, "op10_secrets": OP10, "op11_clustering": OP11, "op13_hard_negatives": OP13}
