"""Queries on a release: its checks, forbidden words in nested values, and parity with what it was made from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeeper.operators.release import Release, parity, paths_with
from lorekeeper.registry import query
from lorekeeper.sources.archive import Archive

_RECORDS_SQL = """e AS MATERIALIZED (SELECT r.record_id, source_id, year, CASE WHEN record_id % 29 = 0 THEN ' ' ELSE 'Record ' || record_id END AS title, CASE WHEN source_id % 31 = 0 THEN NULL ELSE 's' || source_id END AS source_name, code AS ontology_code, level AS publicness_level, CASE WHEN record_id % 37 = 0 THEN 'Suppressed by review' END AS ethics_flag, CASE WHEN record_id % 41 <> 0 THEN 'u' || record_id END AS url FROM public_records r WHERE r.record_id % 13 <> 0 UNION ALL SELECT record_id, source_id, year, 'again', 's', code, level, NULL, 'u' FROM public_records WHERE record_id % 53 = 0 AND record_id % 13 <> 0),
    f AS MATERIALIZED (SELECT DISTINCT record_id FROM record_places WHERE relation = 'R' AND record_id % 3 = 0 AND record_id IN (SELECT record_id FROM records))"""


def _export(a: Archive) -> DataFrame:
    key, text = F.col("record_id"), lambda v: F.lit(v).cast("string")
    r = a.public_records.where(key % 13 != 0)
    one = r.select("record_id", "source_id", "year", F.when(key % 29 == 0, " ").otherwise(F.concat(F.lit("Record "), key.cast("string"))).alias("title"), F.when(F.col("source_id") % 31 != 0, F.concat(F.lit("s"), F.col("source_id").cast("string"))).alias("source_name"), F.col("code").alias("ontology_code"), F.col("level").alias("publicness_level"), F.when(key % 37 == 0, "Suppressed by review").alias("ethics_flag"), F.when(key % 41 != 0, F.concat(F.lit("u"), key.cast("string"))).alias("url"))
    two = r.where(key % 53 == 0).select("record_id", "source_id", "year", text("again").alias("title"), text("s").alias("source_name"), F.col("code").alias("ontology_code"), F.col("level").alias("publicness_level"), text(None).alias("ethics_flag"), text("u").alias("url"))
    return one.unionAll(two)


@query(
    f"""WITH {_RECORDS_SQL}, n AS (SELECT (SELECT count(*) FROM e) AS records, (SELECT count(*) FROM f) AS flags, (SELECT count(*) FROM public_records) AS said), o AS (
    SELECT 'public_records_unique_by_record_id' AS check_name, 'error' AS level, record_id FROM e GROUP BY record_id HAVING count(*) > 1
    UNION ALL SELECT 'every_map_flag_references_public_record', 'error', record_id FROM f WHERE record_id NOT IN (SELECT record_id FROM e)
    UNION ALL SELECT 'no_suppressed_rejected_restricted_records', 'error', record_id FROM e WHERE ethics_flag IS NOT NULL
    UNION ALL SELECT 'every_public_record_has_title', 'error', record_id FROM e WHERE trim(title) = ''
    UNION ALL SELECT 'every_public_record_has_source_name', 'error', record_id FROM e WHERE source_name IS NULL
    UNION ALL SELECT 'every_public_record_has_narrative_or_source_type', 'warning', record_id FROM e WHERE ontology_code = ''
    UNION ALL SELECT 'every_public_record_has_url_or_identifier', 'warning', record_id FROM e WHERE url IS NULL
    UNION ALL SELECT 'summary_record_count_reconciles', 'error', NULL FROM n WHERE records <> said UNION ALL SELECT 'source_rollups_reconcile', 'error', NULL FROM n WHERE records <> said
    UNION ALL SELECT 'source_page_source_totals_reconcile', 'error', record_id FROM e WHERE source_id % 7 = 0)
    SELECT v.check_name, v.level, count(o.check_name) AS failures, min(CAST(o.record_id AS VARCHAR)) AS first FROM (VALUES ('public_records_unique_by_record_id', 'error'), ('map_flags_unique_by_record_id', 'error'), ('map_points_unique_by_record_id', 'error'), ('every_map_flag_references_public_record', 'error'), ('map_flag_count_equals_mapped_record_count', 'error'), ('no_suppressed_rejected_restricted_records', 'error'), ('every_public_record_has_title', 'error'), ('every_public_record_has_source_name', 'error'), ('every_public_record_has_narrative_or_source_type', 'warning'), ('every_public_record_has_url_or_identifier', 'warning'), ('no_raw_internal_fields_in_public_records', 'error'), ('summary_record_count_reconciles', 'error'), ('date_band_totals_reconcile', 'error'), ('source_rollups_reconcile', 'error'), ('map_state_counts_reconcile', 'error'), ('source_page_source_totals_reconcile', 'error')) v(check_name, level) LEFT JOIN o USING (check_name) GROUP BY 1, 2"""
)
def release_checks(a: Archive) -> DataFrame:
    """All checks of a release whose records lack some and repeat some of what its summary counts."""
    records = _export(a)
    flags = a.record_places.where("relation = 'R' and record_id % 3 = 0").select("record_id").distinct().join(a.records.select("record_id"), "record_id", "left_semi")
    counted = lambda df, key: df.groupBy(key).agg(F.count("*").alias("n")).agg(F.map_from_entries(F.collect_list(F.struct(F.coalesce(F.col(key).cast("string"), F.lit("")), "n"))).alias("m"))  # noqa: E731  of bounded keys
    rollup, states = counted(a.public_records, "level").toDF("source_rollup"), counted(flags.withColumn("state", F.col("record_id") % 8), "state").toDF("mapped_state_counts")
    summary = a.public_records.agg(F.count("*").alias("record_count")).crossJoin(flags.agg(F.count("*").alias("mapped_record_count"))).crossJoin(rollup).crossJoin(states)  # of single rows
    bands = records.groupBy("year").agg(F.count("*").alias("record_count"))
    return Release(records, flags, flags, bands, a.sources.where("source_id % 7 <> 0"), summary).checks()


@query(
    f"""WITH {_RECORDS_SQL} SELECT record_id, path, word FROM (SELECT record_id, 'card.title' AS path, '9' AS word FROM e WHERE contains(title, '9') UNION ALL SELECT record_id, 'card.notes[].text', 'review' FROM e WHERE contains(ethics_flag, 'review') UNION ALL SELECT record_id, 'card.notes[].text', '9' FROM e WHERE contains(url, '9')
    UNION ALL SELECT record_id, 'extra{{keys}}', '9' FROM e WHERE contains(source_name, '9') UNION ALL SELECT record_id, 'extra{{}}[]', '9' FROM e WHERE contains(title, '9') OR contains(ontology_code, '9'))"""
)
def release_words(a: Archive) -> DataFrame:
    """Where forbidden words are in nested values: structs, arrays and maps, by path."""
    e = _export(a)
    notes = F.array(F.struct(F.lit("flag").alias("kind"), F.col("ethics_flag").alias("text")), F.struct(F.lit("url").alias("kind"), F.col("url").alias("text")))
    rows = e.select("record_id", F.struct("title", notes.alias("notes")).alias("card"), F.create_map(F.coalesce("source_name", F.lit("-")), F.array("title", "ontology_code")).alias("extra"))
    return paths_with(rows, ["record_id"], ["9", "review"])


@query(
    """WITH l AS (SELECT record_id, source_id, code, year FROM public_records), r AS (SELECT record_id, CASE WHEN record_id % 11 = 0 THEN source_id + 1 ELSE source_id END AS source_id, CASE WHEN record_id % 22 = 0 THEN NULL ELSE code END AS code, year FROM records WHERE record_id % 9 <> 0)
    SELECT record_id, CASE WHEN r.record_id IS NULL THEN 'missing' WHEN l.record_id IS NULL THEN 'extra' ELSE 'differs' END AS side, CASE WHEN r.record_id IS NULL OR l.record_id IS NULL THEN '' WHEN record_id % 22 = 0 THEN 'code,source_id' ELSE 'source_id' END AS columns FROM l FULL JOIN r USING (record_id) WHERE r.record_id IS NULL OR l.record_id IS NULL OR record_id % 11 = 0"""
)
def export_parity(a: Archive) -> DataFrame:
    """Public records against an export of them: keys on one side only, and the columns in which rows differ."""
    key = F.col("record_id")
    left = a.public_records.select("record_id", "source_id", "code", "year")
    right = a.records.where(key % 9 != 0).select("record_id", (F.col("source_id") + F.when(key % 11 == 0, 1).otherwise(0)).alias("source_id"), F.when(key % 22 != 0, F.col("code")).alias("code"), "year")
    return parity(left, right, ["record_id"]).withColumn("columns", F.array_join("columns", ","))


@query("SELECT record_id, level, code, relevance FROM records WHERE record_id % 9 <> 0 AND (level = 'restricted_excluded' OR code = 'restricted_excluded' OR relevance = 'scope_excluded')")
def suppressed_in_export(a: Archive) -> DataFrame:
    """Rows of an export that are marked as not public."""
    marked = (F.col("level") == "restricted_excluded") | (F.col("code") == "restricted_excluded") | (F.col("relevance") == "scope_excluded")
    return a.records.where((F.col("record_id") % 9 != 0) & marked).select("record_id", "level", "code", "relevance")
