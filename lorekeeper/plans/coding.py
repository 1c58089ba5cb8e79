"""Queries on first codes and on the classification of legacy records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeeper.operators import classification as cl
from lorekeeper.operators import coding as co
from lorekeeper.operators.rules import ladder
from lorekeeper.registry import query
from lorekeeper.sources.archive import Archive

#: Figures (figure_id, canonical_name, include_status, ontology_default, humanoid_degree, involves_indigenous_knowledge) and their aliases (alias_id, alias, alias_type, figure_id, search_priority).
FIGURES = [(1, "fool", "include_v1", "person", "full", False), (2, "mourner", "validate_before_include", "spirit", "partial", True), (3, "giant", "exclude_core", "giant", "full", False), (4, "title", "control_only", "control", "none", False)]
ALIASES = [(1, "Idiot", "noise_sensitive", 1, 2), (2, "pathetic", "plain", 2, 2), (3, "than", "plain", 3, 9), (4, "of the", "historical_descriptor", 4, 1), (5, "und", "plain", 2, 1), (6, "tion.", "plain", 4, 1), (7, "é", "plain", 1, 1), (8, "worth-less", "plain", 1, 3)]
PATTERNS = ["Licensed Under", "MORON"]
_EDGE = r"[^\p{L}\p{N}_]"
_values = lambda rows: ", ".join("(" + ", ".join("'" + v + "'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
_CODED_SQL = rf"""f AS (SELECT * FROM (VALUES {_values(FIGURES)}) t(figure_id, canonical_name, include_status, ontology, degree, caution)), v AS (SELECT *, regexp_full_match(alias, '[A-Za-z0-9 -]+') AS as_words FROM (VALUES {_values(ALIASES)}) t(alias_id, alias, kind, figure_id, priority) JOIN f USING (figure_id) WHERE include_status <> 'exclude_core'),
    r AS MATERIALIZED (SELECT doc_id AS record_id, concat_ws(chr(10), nullif(source, ''), nullif(lang, ''), nullif(text, '')) AS t, CASE WHEN toxic = 1 THEN 'restricted_excluded' WHEN quality = 1 THEN 'public_page' WHEN quality = 0 THEN 'public_metadata' END AS level, CASE lang WHEN 'de' THEN 1 WHEN 'fr' THEN 2 END AS own FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1) USING (doc_id)),
    h AS (SELECT r.*, v.*, '(?is)^(|.*?{_EDGE})(' || replace(alias, ' ', '\s+') || ')(?:{_EDGE}|$)' AS p FROM r JOIN v ON contains(lower(t), lower(split_part(alias, ' ', 1)))),
    m AS MATERIALIZED (SELECT record_id, alias_id, alias, kind, priority, figure_id, t, CASE WHEN as_words THEN length(regexp_extract(t, p, 1)) ELSE strpos(lower(t), alias) - 1 END AS s, CASE WHEN as_words THEN regexp_extract(t, p, 2) ELSE substr(t, strpos(lower(t), alias), length(alias)) END AS printed FROM h WHERE CASE WHEN as_words THEN regexp_matches(t, p) ELSE contains(lower(t), alias) END)"""


def _told(a: Archive) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents as records, with aliases and figures."""
    labels = a.table("labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    level = ladder([(F.col("toxic") == 1, "restricted_excluded"), (F.col("quality") == 1, "public_page"), (F.col("quality") == 0, "public_metadata")])
    own = ladder([(F.col("lang") == "de", 1), (F.col("lang") == "fr", 2)])
    records = a.table("documents").join(labels, "doc_id", "left").select(F.col("doc_id").alias("record_id"), F.col("source").alias("title"), F.col("lang").alias("snippet"), F.col("text").alias("full_text"), level.alias("publicness_level"), own.alias("figure_id"))
    aliases = a.spark.createDataFrame(ALIASES, "alias_id int, alias string, alias_type string, figure_id int, search_priority int")
    return records, aliases, a.spark.createDataFrame(FIGURES, "figure_id int, canonical_name string, include_status string, ontology_default string, humanoid_degree string, involves_indigenous_knowledge boolean")


@query(
    rf"""WITH {_CODED_SQL} SELECT record_id, alias_id, printed AS matched_text, trim(regexp_replace(substr(t, CAST(greatest(0, s - 90) + 1 AS BIGINT), CAST(s + length(printed) + 90 - greatest(0, s - 90) AS BIGINT)), '[\s\x{{00A0}}\x{{2000}}-\x{{200A}}\x{{3000}}]+', ' ', 'g')) AS match_context,
    CASE WHEN length(alias) <= 4 THEN 'low' WHEN kind IN ('noise_sensitive', 'historical_descriptor') THEN 'medium' ELSE 'high' END AS confidence FROM m"""
)
def alias_match_rows(a: Archive) -> DataFrame:
    """What texts say where they hold an alias, with what is around it."""
    records, aliases, figures = _told(a)
    return co.alias_matches(records.select("record_id", co.record_text("title", "snippet", "full_text").alias("text")), aliases, figures)


@query(
    f"""WITH {_CODED_SQL}, b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY priority DESC, length(alias) DESC, alias, alias_id) = 1),
    n AS (SELECT r.record_id, r.level, COALESCE(b.figure_id, r.own) AS figure_id, b.printed, CASE WHEN contains(lower(r.t), 'licensed under') THEN 'Licensed Under' WHEN contains(lower(r.t), 'moron') THEN 'MORON' END AS noise FROM r LEFT JOIN b USING (record_id))
    SELECT record_id, canonical_name AS canonical_figure_guess, printed AS figure_name_as_printed, printed AS variant_normalisation, ontology AS ontology_code, degree AS humanoid_degree_code, 'unknown' AS source_voice, 'unknown' AS genre, CASE level WHEN 'public_page' THEN 'public_heritage_page' WHEN 'public_metadata' THEN level WHEN 'restricted_excluded' THEN level ELSE 'open_article' END AS publicness_code,
    CASE WHEN noise IS NULL THEN 'needs_review' ELSE 'noise' END AS relevance_code, CASE WHEN level = 'restricted_excluded' THEN 'restricted_exclude' WHEN caution THEN 'caution_indigenous_knowledge' ELSE 'ok_public' END AS ethics_flag,
    CASE WHEN noise IS NULL THEN 'Initial rule-based coding; requires human review.' ELSE 'Obvious noise pattern matched: ' || noise || '. Requires confirmation.' END AS notes, 'system_seed' AS coded_by FROM n LEFT JOIN f USING (figure_id)"""
)
def coding_rows(a: Archive) -> DataFrame:
    """The first coding of every document."""
    records, aliases, figures = _told(a)
    return co.coded(records, aliases, figures, PATTERNS)


#: What legacy records say besides what the tables tell: source types by segment, labels and snippets by number.
SEGMENTS = {"BUILDING": "trove_newspaper", "AUTOMOBILE": "modern_web", "MACHINERY": "academic_metadata", "HOUSEHOLD": "internet_archive_metadata", "FURNITURE": "andc"}
LABELS = ["Yowie", "Hairy  Man", "Wandjina", "Bunyip", "Rainbow Serpent", "Mimih", "Pangkarlangu", "Nargun", "Ghost", "Wild Man", "", "Yahoo", "Tall Stranger"]
SNIPPETS = ["a GIANT of the ranges", "spirit people", "from a Historical source", "Wandjina in a newspaper", "nothing more", ""]
_case = lambda key, values: f"CASE {key} " + " ".join(f"WHEN {n} THEN '{v}'" for n, v in enumerate(values)) + " END"
_CONSTANT = [c for c in cl.FIELDS if any(c in k for k in cl.KINDS.values())]
_KINDS_SQL = f"(VALUES {', '.join('(' + ', '.join([repr(k)] + [('NULL' if c not in v else repr(v[c])) for c in _CONSTANT]) + ')' for k, v in cl.KINDS.items())}) k(b, {', '.join('k_' + c for c in _CONSTANT)})"
_OWN = {
    "narrative_type": "CASE WHEN b <> 'traditional' THEN k_narrative_type WHEN contains(t, 'giant') OR label IN ('pangkarlangu', 'tjangara') THEN 'giant_or_ogre_narrative' WHEN contains(t, 'spirit') OR label IN ('mimih', 'wandjina') THEN 'spirit_person_narrative' ELSE 'traditional_narrative' END",
    "secondary_role": "CASE WHEN b = 'traditional' THEN CASE WHEN source_type IN ('modern_web', 'internet_archive_metadata') THEN 'heritage_discourse' END ELSE k_secondary_role END",
    "relationship_type": "CASE WHEN b = 'traditional' THEN CASE WHEN s[1] = 'A' THEN 'original_publication' ELSE 'derivative_web_summary' END WHEN b = 'encounter' THEN CASE WHEN reprinted THEN 'archive_reproduction' WHEN own THEN 'retrospective_summary' ELSE 'witness_account_publication' END ELSE k_relationship_type END",
    "source_tier": "s[1]",
    "source_mediation": "s[2]",
    "source_traceability_status": "s[3]",
    "cultural_sensitivity": "COALESCE(k_cultural_sensitivity, CASE care WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END)",
    "ethics_review_status": "COALESCE(k_ethics_review_status, CASE care WHEN 2 THEN 'requires_ethics_review' WHEN 1 THEN 'caution_indigenous_related' ELSE 'ok_public' END)",
    "display_mode": "COALESCE(k_display_mode, CASE WHEN care > 0 THEN 'summary_only' ELSE 'full' END)",
    "label_type": "CASE WHEN b = 'encounter' THEN CASE WHEN label = 'yowie' THEN 'exact_name' ELSE 'historical_descriptor' END ELSE k_label_type END",
    "entity_concept_key": "CASE WHEN b = 'catalogue' THEN CASE WHEN related THEN 'traditional_spirit_person_cluster' ELSE 'unresolved_or_validation_label' END ELSE k_entity_concept_key END",
    "review_flags": "CASE WHEN b IN ('control', 'exclusion') THEN b ELSE concat_ws(',', CASE care WHEN 2 THEN 'high_sensitivity' WHEN 1 THEN 'indigenous_related' END, CASE WHEN source_type = 'internet_archive_metadata' AND path IS NULL THEN 'item_text_requires_inspection' END, CASE WHEN b = 'encounter' AND reprinted THEN 'original_article_verification_required' WHEN b = 'catalogue' THEN 'metadata_only_not_accepted' WHEN b = 'pointer' THEN 'requires_manual_classification' END) END",
}


def legacy_rows(a: Archive) -> DataFrame:
    """Records of the archive as flat rows that have yet to be classified."""
    key, nth = F.col("record_id"), lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), (at % len(values)).cast("int") + 1)
    segment = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in SEGMENTS.items() for x in pair]), F.col("source_type")), F.lit(""))
    return a.records.join(a.sources.select("source_id", "source_name", "source_type"), "source_id").select(
        "record_id", "year", segment.alias("source_type"), F.when(F.col("source_id") % 5 == 0, F.concat(F.lit("Australian Yowie Research "), "source_name")).otherwise(F.col("source_name")).alias("source_name"),
        nth(LABELS, key).alias("figure_name_as_printed"), F.lit("").alias("canonical_figure_guess"), F.when(key % 9 == 0, "Yowie").alias("canonical_name"), F.concat_ws(" ", F.lit("Report"), F.nullif("code", F.lit(""))).alias("title"), nth(SNIPPETS, F.floor(key / 2)).alias("snippet"),
        F.when(key % 29 == 0, "control_only").when(key % 31 == 0, "exclude_core").alias("include_status"), F.when(key % 7 != 1, key % 4 == 3).alias("involves_indigenous_knowledge"), F.when(key % 3 != 0, F.col("date_text")).alias("full_text_path"),
    )


@query(
    rf"""WITH x AS (SELECT record_id, year, CASE source_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENTS.items())} ELSE '' END AS source_type, source_id % 5 = 0 AS own, COALESCE(NULLIF({_case(f'record_id % {len(LABELS)}', LABELS)}, ''), CASE WHEN record_id % 9 = 0 THEN 'Yowie' END, 'unknown humanoid') AS given, record_id % 9 = 0 AS yowie, concat_ws(' ', 'Report', NULLIF(code, '')) AS title, {_case(f'record_id // 2 % {len(SNIPPETS)}', SNIPPETS)} AS snippet,
    record_id % 29 = 0 AS controlled, record_id % 31 = 0 AS outside, record_id % 7 <> 1 AND record_id % 4 = 3 AS related, CASE WHEN record_id % 3 <> 0 THEN date_text END AS path FROM records JOIN sources USING (source_id)),
    y AS (SELECT *, replace(lower(given), '  ', ' ') AS label, lower(given || ' ' || title || ' ' || snippet) AS t FROM x),
    z AS (SELECT *, CASE WHEN contains(t, 'wandjina') THEN 2 WHEN related THEN 1 ELSE 0 END AS care, own AND (regexp_matches(t, 'historical|newspaper') OR COALESCE(year < 1970, FALSE)) AS reprinted,
    CASE WHEN source_type = 'trove_newspaper' THEN ['A', 'original_or_near_primary', 'stable_public_identifier'] WHEN source_type = 'andc' THEN ['B', 'public_institutional_metadata', 'public_metadata_only'] WHEN source_type = 'academic_metadata' THEN ['B', 'bibliographic_metadata', 'metadata_only_pointer']
    WHEN source_type = 'internet_archive_metadata' THEN ['A', 'digitized_public_item_or_metadata', 'metadata_requires_item_inspection'] WHEN own THEN ['E', 'specialist_aggregator_or_witness_publication', 'public_page_traceable'] WHEN source_type = 'modern_web' THEN ['C', 'public_web_or_media', 'public_page_traceable'] ELSE ['C', 'public_source', 'public_page_traceable'] END AS s,
    CASE WHEN label = 'bunyip' OR controlled THEN 'control' WHEN label = 'rainbow serpent' OR outside THEN 'exclusion' WHEN source_type = 'academic_metadata' THEN 'catalogue' WHEN label IN ('wandjina', 'mimih', 'pangkarlangu', 'nargun') OR related THEN 'traditional' WHEN label IN ('yowie', 'hairy man', 'wild man', 'yahoo', 'unknown humanoid') OR yowie THEN 'encounter' ELSE 'pointer' END AS b FROM y)
    SELECT record_id, given AS label, {', '.join(f'{_OWN.get(c, "k_" + c)} AS {c}' for c in cl.FIELDS)} FROM z JOIN {_KINDS_SQL} USING (b)"""
)
def record_classification(a: Archive) -> DataFrame:
    """The 22 fields of every record; its flags joined."""
    return cl.classified(legacy_rows(a)).select("record_id", "label", *[F.array_join(c, ",").alias(c) if c == "review_flags" else c for c in cl.FIELDS])
