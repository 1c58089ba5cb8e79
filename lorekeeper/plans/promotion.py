"""Queries on promotion: the rows that accepted candidates add to each relation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeeper.operators.promotion import MEDIATION, OCR, RECORD_STATUS, REPRODUCTION, REVIEWED, TRACEABILITY, Promotion
from lorekeeper.registry import query
from lorekeeper.sources.archive import Archive

#: Orders as candidates: their customers as sources, priorities as runs, the customers' places in words.
_SQL = """WITH c AS MATERIALIZED (SELECT o_orderkey AS candidate_id, o_orderpriority AS run_id, c_name AS source_name, CASE WHEN c_custkey % 11 = 0 THEN 'public_web' ELSE c_mktsegment END AS source_type, c_custkey, 'https://example.org/' || c_custkey || '/' || o_orderkey AS url, 'Order ' || o_orderkey AS title,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS year, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'place ' || (o_custkey % 97) END AS place, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 400 AS DOUBLE) / 10 - 46 END AS lat, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'Clerk ' || (o_orderkey % 50) END AS label, CASE WHEN o_orderkey % 13 = 0 THEN 'high' ELSE 'low' END AS sensitivity, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'A' END AS quality FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'O'),
    tops AS (SELECT 100000000 AS records, 200000000 AS items, 300000000 AS narratives, 400000000 AS sources, 500000000 AS places, 600000000 AS runs),
    w AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY candidate_id) AS n, records, items, narratives FROM c, tops WHERE candidate_id % 7 <> 0),
    olds AS MATERIALIZED (SELECT c_custkey AS source_id, c_name AS source_name, CASE WHEN c_custkey % 11 = 0 THEN 'public_web' ELSE c_mktsegment END AS source_type FROM customer WHERE c_custkey % 3 = 0),
    news AS MATERIALIZED (SELECT 400000000 + row_number() OVER (ORDER BY candidate_id) AS source_id, * EXCLUDE candidate_id FROM (SELECT source_name, source_type, min(candidate_id) AS candidate_id, arg_min(url, candidate_id) AS url FROM w ANTI JOIN olds USING (source_name, source_type) GROUP BY 1, 2)),
    s AS MATERIALIZED (SELECT source_id, source_name, source_type FROM olds UNION ALL SELECT source_id, source_name, source_type FROM news),
    oldp AS MATERIALIZED (SELECT k AS location_id, 'place ' || k AS place_name, CASE WHEN k % 2 = 0 THEN CAST(k AS DOUBLE) END AS latitude FROM (SELECT DISTINCT o_custkey % 97 AS k FROM orders WHERE o_custkey % 97 < 20)),
    newp AS MATERIALIZED (SELECT 500000000 + row_number() OVER (ORDER BY candidate_id) AS location_id, place AS place_name, latitude FROM (SELECT place, min(candidate_id) AS candidate_id, arg_min(COALESCE(lat, -999), candidate_id) AS first_lat, NULL::DOUBLE AS latitude FROM w WHERE place IS NOT NULL GROUP BY 1) x WHERE place NOT IN (SELECT place_name FROM oldp)),
    fills AS (SELECT place AS place_name, arg_min(lat, candidate_id) FILTER (WHERE lat IS NOT NULL) AS fill FROM w WHERE place IS NOT NULL GROUP BY 1),
    p AS MATERIALIZED (SELECT location_id, place_name, COALESCE(latitude, fill) AS latitude, location_id >= 500000000 AS added FROM (SELECT * FROM oldp UNION ALL SELECT * FROM newp) JOIN fills USING (place_name)),
    r AS MATERIALIZED (SELECT run_id, 600000000 + row_number() OVER (ORDER BY min(candidate_id)) AS collection_run_id FROM w WHERE run_id <> '1-URGENT' GROUP BY 1 UNION ALL SELECT '1-URGENT', 1),
    k AS MATERIALIZED (SELECT w.*, records + n AS record_id, items + n AS source_item_id, CASE WHEN candidate_id % 10 = 1 THEN candidate_id ELSE narratives + row_number() OVER (PARTITION BY candidate_id % 10 = 1 ORDER BY candidate_id) END AS narrative_id, candidate_id % 10 = 1 AS told, source_id, location_id, collection_run_id FROM w JOIN s USING (source_name, source_type) JOIN r USING (run_id) LEFT JOIN (SELECT place_name AS place, location_id FROM p) USING (place)) """
_TOPS = {"records": 100_000_000, "source_items": 200_000_000, "narrative_units": 300_000_000, "sources": 400_000_000, "locations": 500_000_000, "collection_runs": 600_000_000}


def promotion(a: Archive, mapped: DataFrame | None = None) -> Promotion:
    key, customer = F.col("o_orderkey"), a.table("customer")
    kind = F.when(F.col("c_custkey") % 11 == 0, "").otherwise(F.col("c_mktsegment"))
    text = lambda v: F.lit(v).cast("string")
    orders = a.table("orders").join(customer, F.col("c_custkey") == F.col("o_custkey"))
    candidates = orders.select(
        key.alias("candidate_id"), F.when(F.col("o_orderstatus") == "O", "accepted").otherwise("lead_only").alias("candidate_status"), F.col("o_orderpriority").alias("run_id"), F.col("c_name").alias("source_name"), kind.alias("source_type"), text(None).alias("publication_or_organisation"), text("").alias("canonical_url"),
        F.concat_ws("/", F.lit("https://example.org"), F.col("c_custkey").cast("string"), key.cast("string")).alias("url"), F.concat(F.lit("Order "), key.cast("string")).alias("title"), F.when(key % 17 != 0, F.year("o_orderdate").cast("string")).alias("publication_date_text"), text(None).alias("external_id"), text("public_page").alias("publicness_status"),
        text(None).alias("rights_access_status"), F.when(key % 4 != 0, F.concat(F.lit(" place  "), (F.col("o_custkey") % 97).cast("string"))).alias("location_text"), F.when(key % 3 == 0, (key % 400).cast("double") / 10 - 46).alias("latitude"), F.when(key % 3 == 0, F.lit(140.0)).alias("longitude"), text(None).alias("state_territory"), text("town").alias("location_precision"), text(None).alias("geocode_source"), text("verified").alias("geocode_verification_status"),
        F.when(key % 5 == 0, " ").otherwise(F.concat(F.lit("Clerk "), (key % 50).cast("string"))).alias("source_label"), F.when(key % 13 == 0, "high").otherwise("low").alias("cultural_sensitivity"), text("reviewed_ok").alias("ethics_review_status"), F.col("o_orderpriority").alias("narrative_type"), text("body").alias("humanoid_basis"), F.when(key % 9 != 0, "A").alias("quality_class"), text("").alias("location_role"), text(None).alias("coordinate_evidence_note"), F.concat(F.lit("Evidence of "), F.col("c_name")).alias("evidence_summary"),
    )
    place = a.table("orders").select((F.col("o_custkey") % 97).alias("k")).where("k < 20").distinct()
    null = lambda c, kind="string": F.lit(None).cast(kind).alias(c)
    tables = {
        "sources": customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("source_id"), F.col("c_name").alias("source_name"), F.when(F.col("c_custkey") % 11 == 0, "public_web").otherwise(F.col("c_mktsegment")).alias("source_type")),
        "collection_runs": a.spark.createDataFrame([(1, "1-URGENT")], "collection_run_id long, run_name string"),
        "locations": place.select(F.col("k").alias("location_id"), F.concat(F.lit("place "), F.col("k").cast("string")).alias("place_name"), F.when(F.col("k") % 2 == 0, F.col("k").cast("double")).alias("latitude"), null("longitude", "double"), null("state_territory"), null("location_type"), null("geocode_source"), null("verification_status")),
        "narrative_units": a.table("orders").where("o_orderkey % 10 = 1").select(key.alias("narrative_id"), F.concat(F.lit("candidate:"), key.cast("string")).alias("migration_key")),
        "mappings": a.table("orders").where("o_orderkey % 7 = 0").select(key.alias("candidate_id")),
    }
    if mapped is not None:
        tables["mappings"] = tables["mappings"].union(mapped.select("candidate_id"))
    return Promotion(candidates, tables, _TOPS)


@query(_SQL + "SELECT source_id, source_name, source_type, regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1) AS base_url, 'public_page' AS publicness_level FROM news")
def promoted_sources(a: Archive) -> DataFrame:
    return promotion(a).new_sources


@query(_SQL + f"SELECT record_id, source_id, 'candidate-v2:' || candidate_id AS external_id, title, source_name AS publication, CAST(year AS VARCHAR) AS date_published, year, url, 'Evidence of ' || source_name AS snippet, CAST(NULL AS VARCHAR) AS access_status, 'public_page' AS publicness_level, '{RECORD_STATUS}' AS ingestion_status FROM k")
def promoted_records(a: Archive) -> DataFrame:
    return promotion(a).records


@query(_SQL + "SELECT record_id, CASE WHEN label = '' THEN ' ' ELSE label END AS figure_name_as_printed, run_id AS ontology_code, 'body' AS humanoid_degree_code, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE source_type END AS genre, 'public_page' AS publicness_code, 'relevant' AS relevance_code, 'reviewed_ok' AS ethics_flag, 'Promoted from accepted candidate ' || candidate_id || '; quality ' || COALESCE(quality, 'reviewed') || '.' AS notes, 'candidate_promotion' AS coded_by FROM k")
def promoted_codings(a: Archive) -> DataFrame:
    return promotion(a).coding


@query(_SQL + f"SELECT source_item_id, record_id AS legacy_record_id, source_id, 'candidate-v2:' || candidate_id AS external_id, title, CAST(year AS VARCHAR) AS publication_date_start, CASE WHEN year IS NULL THEN 'unknown' ELSE 'year' END AS publication_date_precision, url, url AS canonical_url, '{MEDIATION}' AS source_mediation, 'public_page' AS publicness_status, 'public_access_note_required' AS rights_access_status, '{REPRODUCTION}' AS reproduction_status, '{OCR}' AS text_or_ocr_status, '{TRACEABILITY}' AS source_traceability_status FROM k")
def promoted_source_items(a: Archive) -> DataFrame:
    return promotion(a).source_items


@query(_SQL + "SELECT narrative_id, 'candidate:' || candidate_id AS migration_key, run_id AS narrative_type, title AS working_title, 'Evidence of ' || source_name AS public_summary, CAST(year AS VARCHAR) AS earliest_attestation_start, CASE WHEN year IS NULL THEN 'unknown' ELSE 'year' END AS earliest_attestation_precision, CASE WHEN sensitivity = 'high' THEN 'summary_only' ELSE 'full' END AS display_mode, COALESCE(quality, 'reviewed') AS classification_confidence FROM k WHERE NOT told")
def promoted_narratives(a: Archive) -> DataFrame:
    """Narratives of candidates that have none yet."""
    return promotion(a).narratives


@query(_SQL + f"SELECT narrative_id, source_item_id, 'original_publication' AS relationship_type, COALESCE(quality, 'reviewed') AS confidence, '{REVIEWED}' AS human_review_status FROM k WHERE NOT told")
def promoted_source_links(a: Archive) -> DataFrame:
    return promotion(a).source_links


@query(_SQL + f"SELECT source_item_id, narrative_id, label AS label_text, lower(label) AS normalized_text, 'source_or_institution_label' AS label_type, '{REVIEWED}' AS review_status FROM k WHERE NOT told AND label <> ''")
def promoted_labels(a: Archive) -> DataFrame:
    return promotion(a).labels


@query(_SQL + "SELECT location_id, place_name, latitude, added FROM p")
def promoted_locations(a: Archive) -> DataFrame:
    """Places that candidates name, new or there before, with what the candidates fill in."""
    return promotion(a).locations.select("location_id", "place_name", "latitude", "added")


@query(_SQL + "SELECT record_id, location_id, 'uncertain_or_broad_location' AS relation_type, 'Evidence of ' || source_name AS evidence_text, COALESCE(quality, 'reviewed') AS confidence FROM k WHERE location_id IS NOT NULL")
def promoted_record_locations(a: Archive) -> DataFrame:
    return promotion(a).record_locations


@query(_SQL + f"SELECT narrative_id, location_id, source_item_id, 'uncertain_or_broad_location' AS location_role, replace(' ' || place, 'place ', 'place  ') AS location_text_as_printed, 'town' AS location_precision, 'verified' AS verification_status, COALESCE(quality, 'reviewed') AS confidence, '{REVIEWED}' AS review_status FROM k WHERE location_id IS NOT NULL")
def promoted_narrative_locations(a: Archive) -> DataFrame:
    return promotion(a).narrative_locations


@query(_SQL + "SELECT candidate_id, record_id, source_item_id, narrative_id, collection_run_id, 'promoted' AS promotion_status FROM k")
def promotion_mappings(a: Archive) -> DataFrame:
    return promotion(a).mappings


@query(_SQL + "SELECT 1 AS run, (SELECT count(*) FROM c) AS accepted_candidates, (SELECT count(*) FROM w) AS promoted, (SELECT count(*) FROM c WHERE candidate_id % 7 = 0) AS already_mapped UNION ALL SELECT 2, (SELECT count(*) FROM c), 0, (SELECT count(*) FROM c)")
def promotion_counters(a: Archive) -> DataFrame:
    """What the first run promotes, and the second, which finds all candidates mapped."""
    first = promotion(a)
    second = promotion(a, first.mappings)
    return first.counters.select(F.lit(1).alias("run"), "*").unionAll(second.counters.select(F.lit(2).alias("run"), "*"))


@query(_SQL + "SELECT v.relation, v.key, count(*) FILTER (WHERE k.record_id IS NULL) AS faults FROM (VALUES ('records', 'source_id'), ('coding', 'record_id'), ('source_items', 'source_id'), ('narrative_source_links', 'narrative_id'), ('narrative_source_links', 'source_item_id'), ('entity_labels', 'narrative_id'), ('record_locations', 'record_id'), ('record_locations', 'location_id'), ('narrative_locations', 'narrative_id'), ('narrative_locations', 'location_id'), ('mappings', 'record_id'), ('mappings', 'source_item_id'), ('mappings', 'narrative_id'), ('mappings', 'collection_run_id')) v(relation, key), k GROUP BY 1, 2")
def promotion_key_faults(a: Archive) -> DataFrame:
    """Keys of promoted rows that point to no row, by relation."""
    return promotion(a).key_faults()
