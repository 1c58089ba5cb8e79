"""Queries on what the archive gives out: review exports, public counts, summary and map layers, over all records and their classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeeper.operators import classification as cl
from lorekeeper.operators import exports as ex
from lorekeeper.operators.periods import bands_between
from lorekeeper.operators.rules import ladder
from lorekeeper.plans.coding import legacy_rows
from lorekeeper.registry import ORACLE_SQL, query
from lorekeeper.sources.archive import BANDS, Archive

#: Periods whose first and last follow the data.
PERIODS = [(band, None if n == 0 else first, None if n == len(BANDS) - 1 else last) for n, (band, first, last) in enumerate(BANDS)]
_TABLES_SQL = f"""WITH c AS MATERIALIZED ({ORACLE_SQL['record_classification']}), x AS MATERIALIZED (SELECT c.*, r.year, concat_ws(' ', 'Report', NULLIF(code, '')) AS title, CASE WHEN source_id % 5 = 0 THEN 'Australian Yowie Research ' || source_name ELSE source_name END AS organisation, source_type AS segment FROM c JOIN records r USING (record_id) JOIN sources USING (source_id)),
    n AS (SELECT record_id AS narrative_id, * FROM x WHERE primary_role = 'first-class narrative source'), p AS (SELECT location_id, place_name, region, CASE WHEN nation_id % 7 <> 0 THEN state END AS state_territory, lat AS latitude, lon AS longitude FROM places),
    l AS MATERIALIZED (SELECT narrative_id, location_id, priority, CASE relation WHEN 'R' THEN 'alleged_event_location' WHEN 'A' THEN 'publication_location' END AS location_role, narrative_type, display_mode, title, place_name, region, state_territory, latitude, longitude FROM n JOIN record_places USING (record_id) JOIN p USING (location_id)),
    m AS (SELECT doc_id AS candidate_id, CASE WHEN toxic = 1 THEN 'rejected' WHEN quality = 1 THEN 'accepted' END AS candidate_status FROM labels)"""
_COUNTS_SQL = """, counts AS (SELECT family, value, count(*) AS n FROM (SELECT unnest(['narrative_types', 'analysis_status', 'sensitivity', 'date_bands']) AS family, unnest([COALESCE(narrative_type, secondary_role, 'untyped'), analysis_status, cultural_sensitivity, CASE WHEN year IS NULL THEN 'undated' ELSE COALESCE(band, 'outside_scope') END]) AS value FROM n LEFT JOIN bands ON year BETWEEN first_year AND last_year
    UNION ALL SELECT unnest(['source_tiers', 'source_organisations']), unnest([source_tier, organisation]) FROM x UNION ALL SELECT unnest(['location_roles', 'states']), unnest([COALESCE(location_role, 'unknown'), COALESCE(state_territory, 'AU_UNSPECIFIED')]) FROM l UNION ALL SELECT 'collection_candidates', COALESCE(candidate_status, 'unknown') FROM m) GROUP BY 1, 2)"""


def tables(a: Archive) -> ex.Tables:
    """The relations of the normalised archive, an item for each record and a narrative for each first-class one."""
    x = cl.classified(legacy_rows(a))
    narratives = x.where("primary_role = 'first-class narrative source'").withColumn("narrative_id", F.col("record_id"))
    role = ladder([(F.col("relation") == "R", "alleged_event_location"), (F.col("relation") == "A", "publication_location")])
    bridge = a.record_places.join(narratives.select("record_id", "narrative_id"), "record_id").select("narrative_id", "location_id", "priority", role.alias("location_role"))
    return {
        "source_items": x.select(F.col("record_id").alias("source_item_id"), "title", "source_type", "source_tier", F.col("source_name").alias("publication_or_organisation")),
        "narrative_units": narratives.select("narrative_id", "narrative_type", "secondary_role", F.col("title").alias("working_title"), "analysis_status", "cultural_sensitivity", "ethics_review_status", "display_mode", F.col("year").cast("string").alias("earliest_attestation_start")),
        "legacy_record_mappings": x.select(F.col("record_id").alias("legacy_record_id"), F.col("record_id").alias("source_item_id"), F.when(F.col("primary_role") == "first-class narrative source", F.col("record_id")).alias("narrative_id"), F.col("primary_role").alias("primary_record_role"), F.col("classification_confidence").alias("migration_confidence"), F.to_json("review_flags").alias("review_flags")),
        "narrative_locations": bridge,
        "locations": a.places.select("location_id", "place_name", "region", F.when(F.col("nation_id") % 7 != 0, F.col("state")).alias("state_territory"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude")),
        "entity_labels": x.select("record_id", "label"),
        "entity_concepts": x.select("entity_concept_key").distinct(),
        "collection_candidates_v2": a.table("labels").select(F.col("doc_id").alias("candidate_id"), ladder([(F.col("toxic") == 1, "rejected"), (F.col("quality") == 1, "accepted")]).alias("candidate_status")),
    }


def _bands(a: Archive) -> list:
    """PERIODS between the years of all records."""
    return bands_between(PERIODS, *a.records.agg(F.min("year"), F.max("year")).first())


@query(
    _TABLES_SQL
    + """ SELECT record_id AS legacy_record_id, record_id AS source_item_id, n.narrative_id, x.primary_role AS primary_record_role, x.classification_confidence AS migration_confidence, CASE WHEN x.review_flags = '' THEN '[]' ELSE '["' || replace(x.review_flags, ',', '","') || '"]' END AS review_flags, x.title, CASE x.segment WHEN 'BUILDING' THEN 'trove_newspaper' WHEN 'AUTOMOBILE' THEN 'modern_web' WHEN 'MACHINERY' THEN 'academic_metadata' WHEN 'HOUSEHOLD' THEN 'internet_archive_metadata' WHEN 'FURNITURE' THEN 'andc' ELSE '' END AS source_type, x.source_tier,
    n.narrative_type, n.secondary_role, n.analysis_status, n.ethics_review_status, n.display_mode FROM x LEFT JOIN n USING (record_id) WHERE COALESCE(n.analysis_status, x.primary_role) IN ('display_ready_unreviewed', 'review_required', 'lead_only', 'exclusion', 'control') OR x.review_flags <> ''"""
)
def review_queue_rows(a: Archive) -> DataFrame:
    """What waits for a review."""
    t = tables(a)
    return ex.review_queue(t["legacy_record_mappings"], t["source_items"], t["narrative_units"])


@query(_TABLES_SQL + " SELECT narrative_id, location_id, priority, location_role, narrative_type, display_mode, title AS working_title, place_name, region, state_territory, latitude, longitude, COALESCE(location_role, 'uncertain_or_broad_location') AS layer FROM l WHERE COALESCE(location_role, '') <> 'publication_location'")
def map_layer_rows(a: Archive) -> DataFrame:
    return ex.map_layers(tables(a))


@query(_TABLES_SQL + _COUNTS_SQL + " SELECT * FROM counts")
def public_count_rows(a: Archive) -> DataFrame:
    """Counts of all families in one shuffle."""
    return ex.public_counts(tables(a), _bands(a))


@query(
    _TABLES_SQL
    + _COUNTS_SQL
    + f""" SELECT {', '.join(f"CAST(COALESCE(sum(n) FILTER (WHERE family = '{family}' AND value IN ({', '.join(repr(v) for v in values)})), 0) AS BIGINT) AS {name}" for name, (family, values) in ex.SUMMARY.items())},
    (SELECT count(*) FROM x) AS source_item_count, (SELECT count(*) FROM n) AS narrative_unit_count, (SELECT count(DISTINCT entity_concept_key) FROM x) AS entity_concept_count, (SELECT count(*) FROM x) AS source_label_count FROM counts"""
)
def public_summary_row(a: Archive) -> DataFrame:
    t = tables(a)
    return ex.public_summary(t, ex.public_counts(t, _bands(a)))


def record_tables(a: Archive) -> ex.Tables:
    """Records, their codes and places, with figures and sources, as the flat archive holds them; it has no queries, series or aliases."""
    r, none = a.records, lambda schema: a.spark.createDataFrame([], schema)
    return {
        "records": r.select("record_id", "year", F.col("date_text").alias("date_published"), F.concat(F.lit("Record "), F.col("record_id").cast("string")).alias("title"), F.col("level").alias("publicness_level")),
        "coding": r.where("relevance is not null").select("record_id", F.col("code").alias("publicness_code"), F.col("relevance").alias("relevance_code")),
        "figures": a.figures.select("figure_id", F.col("figure").alias("canonical_name"), "cluster", "tier"),
        "aliases": a.figures.select(F.col("figure_id").alias("alias_id"), "figure_id", F.col("label").alias("alias"), F.col("tier").alias("search_priority")),
        "sources": a.sources,
        "queries": none("query_id int, source_id int, figure_id int, query_string string, date_start string"),
        "attention_series": none("attention_id int, source_id int, figure_id int, term string, date string"),
        "record_locations": a.record_places.select("record_id", "location_id", F.col("relation").alias("relation_type"), F.col("kind").alias("confidence"), F.col("evidence").alias("evidence_text")),
        "locations": tables(a)["locations"],
    }


@query(
    """WITH s AS (SELECT record_id, string_agg(place_name || ' (' || CASE WHEN nation_id % 7 <> 0 THEN state ELSE region END || '): ' || kind, '; ' ORDER BY place_name, location_id, kind) AS location_summary FROM record_places JOIN places USING (location_id) GROUP BY 1)
    SELECT record_id, year, date_text AS date_published, 'Record ' || record_id AS title, location_summary, CASE WHEN relevance IS NOT NULL THEN code END AS publicness_code, relevance AS relevance_code FROM records LEFT JOIN s USING (record_id) WHERE COALESCE(level, '') <> 'restricted_excluded' AND COALESCE(relevance, '') <> 'scope_excluded'"""
)
def records_review_rows(a: Archive) -> DataFrame:
    """The review export of public records, with their places in words."""
    e = ex.record_exports(record_tables(a))["records_review"]
    return e.rows.select([c for c in e.fields if c in e.rows.columns])


@query("SELECT record_id, year, 'Record ' || record_id AS title, place_name, region, CASE WHEN nation_id % 7 <> 0 THEN state END AS state_territory, lat AS latitude, lon AS longitude, relation AS relation_type, evidence AS evidence_text, kind AS confidence FROM record_places JOIN places USING (location_id) JOIN records USING (record_id)")
def record_location_rows(a: Archive) -> DataFrame:
    e = ex.record_exports(record_tables(a))["record_locations"]
    return e.rows.select([c for c in e.fields if c in e.rows.columns])
