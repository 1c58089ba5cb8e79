"""First codes of records by rule: noise, the aliases that their texts hold, and what follows from the best one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekeeper.operators.gazetteer import first_held, first_mentions
from lorekeeper.operators.lexicon import confidence
from lorekeeper.operators.ranking import first_by
from lorekeeper.operators.rules import ladder

#: Figures whose aliases are looked for, and aliases that are looked for as words (fixed values).
INCLUDED = ("include_v1", "validate_before_include", "control_only")
AS_WORDS = "^[A-Za-z0-9 -]+$"
#: Codes of publicness by level, and the code of any other level (fixed values).
PUBLICNESS = {"open_full_text": "open_article", "public_metadata": "public_metadata", "public_page": "public_heritage_page", "restricted_excluded": "restricted_excluded"}
PUBLIC = "open_article"
#: What codes say (fixed values).
RESTRICTED, CAUTION, OK = "restricted_exclude", "caution_indigenous_knowledge", "ok_public"
NOISE, REVIEW, UNKNOWN, CODER = "noise", "needs_review", "unknown", "system_seed"
REVIEW_NOTE = "Initial rule-based coding; requires human review."
NOISE_NOTE = ("Obvious noise pattern matched: ", ". Requires confirmation.")
#: What an earlier coding keeps when a record is coded again.
KEPT = ("source_voice", "genre")


def record_text(*parts: str) -> Column:
    """The parts that are neither null nor empty, each on lines of its own."""
    return F.concat_ws("\n", *[F.nullif(F.col(p), F.lit("")) for p in parts])


def noise_pattern(text: Column, patterns: list[str]) -> Column:
    """The first pattern in the order given that a text holds as it stands, in any case; null for none."""
    low = F.lower(text)
    return F.coalesce(*[F.when(F.contains(low, F.lit(p.lower())), p) for p in patterns], F.lit(None).cast("string"))


def publicness(level: Column) -> Column:
    return ladder([(level == k, v) for k, v in PUBLICNESS.items()], PUBLIC)


def alias_matches(texts: DataFrame, aliases: DataFrame, figures: DataFrame) -> DataFrame:
    """(record_id, alias_id, matched_text, match_context, confidence): aliases of included figures that texts hold, by their first mention.

    texts has (record_id, text), aliases (alias_id, alias, alias_type, figure_id), figures (figure_id, include_status). An alias of ASCII letters, digits,
    spaces and hyphens is looked for as words, its spaces being any white space; any other one as it stands, within words too. matched_text is
    what the text says, match_context that with 90 characters on each side. Both kinds are scans that never move the texts.
    """
    live = aliases.join(figures.where(F.col("include_status").isin(*INCLUDED)), "figure_id", "left_semi").where("alias <> ''")
    docs, names = texts.select(F.col("record_id").alias("doc_id"), "text"), live.select(F.col("alias_id").alias("item_id"), F.col("alias").alias("name"))
    words = F.col("name").rlike(AS_WORDS)
    found = first_mentions(docs, names.where(words), printed=True).unionByName(first_held(docs, names.where(~words)))
    told = found.select(F.col("doc_id").alias("record_id"), F.col("item_id").alias("alias_id"), F.col("printed").alias("matched_text"), F.col("evidence").alias("match_context"))
    return told.join(live.select("alias_id", confidence(F.col("alias"), F.col("alias_type")).alias("confidence")), "alias_id").select("record_id", "alias_id", "matched_text", "match_context", "confidence")


def coded(records: DataFrame, aliases: DataFrame, figures: DataFrame, patterns: list[str], done: DataFrame | None = None) -> DataFrame:
    """The first coding of every record that ``done`` (record_id) doesn't hold: one row each.

    records has (record_id, title, snippet, full_text, publicness_level, figure_id), one row for each record_id; aliases also has search_priority, figures
    (canonical_name, ontology_default, humanoid_degree, involves_indigenous_knowledge). The best alias of a text is the one of highest
    priority, then the longest, then the first in order; its figure gives the codes. A text without one is coded by the record's own
    figure, with no form as printed. Noise doesn't keep a record from its figure. Records without any text are coded like those that hold nothing.
    """
    waiting = records if done is None else records.join(done.select("record_id"), "record_id", "left_anti")
    texts = waiting.withColumn("text", record_text("title", "snippet", "full_text"))
    told = alias_matches(texts, aliases, figures).join(aliases.select("alias_id", "alias", "search_priority", F.col("figure_id").alias("matched_figure")), "alias_id")
    best = first_by(told, ["record_id"], [F.desc("search_priority"), F.desc(F.char_length("alias")), "alias", "alias_id"])
    rows = texts.select("record_id", "publicness_level", F.col("figure_id").alias("own_figure"), noise_pattern(F.col("text"), patterns).alias("noise")).join(best, "record_id", "left")
    known = figures.select(F.col("figure_id").alias("_figure"), "canonical_name", "ontology_default", "humanoid_degree", "involves_indigenous_knowledge")
    j = rows.withColumn("_wanted", F.coalesce("matched_figure", "own_figure")).join(known, F.col("_wanted") == F.col("_figure"), "left")
    caution = F.coalesce(F.col("involves_indigenous_knowledge").cast("boolean"), F.lit(False))
    return j.select(
        "record_id",
        F.col("canonical_name").alias("canonical_figure_guess"),
        F.col("matched_text").alias("figure_name_as_printed"),
        F.col("matched_text").alias("variant_normalisation"),
        F.col("ontology_default").alias("ontology_code"),
        F.col("humanoid_degree").alias("humanoid_degree_code"),
        F.lit(UNKNOWN).alias("source_voice"),
        F.lit(UNKNOWN).alias("genre"),
        publicness(F.col("publicness_level")).alias("publicness_code"),
        F.when(F.col("noise").isNull(), REVIEW).otherwise(NOISE).alias("relevance_code"),
        ladder([(F.col("publicness_level") == "restricted_excluded", RESTRICTED), (caution, CAUTION)], OK).alias("ethics_flag"),
        F.when(F.col("noise").isNull(), REVIEW_NOTE).otherwise(F.concat(F.lit(NOISE_NOTE[0]), "noise", F.lit(NOISE_NOTE[1]))).alias("notes"),
        F.lit(CODER).alias("coded_by"),
    )


def coded_again(old: DataFrame, new: DataFrame) -> DataFrame:
    """old with the rows of new in the place of those of the same record_id, whose KEPT columns stay; other rows of new are added."""
    before = old.select("record_id", *[F.col(c).alias(f"_{c}") for c in KEPT], F.lit(True).alias("_there"))
    met = new.join(before, "record_id", "left")
    kept = [F.when(F.col("_there"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in KEPT else F.col(c) for c in old.columns]
    return old.join(new.select("record_id"), "record_id", "left_anti").unionByName(met.select(*kept))
