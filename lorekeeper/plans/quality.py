"""Duplicates, structural checks, gates, queues and merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lorekeeper.operators import merge
from lorekeeper.operators.ranking import first_by
from lorekeeper.registry import query
from lorekeeper.sources.archive import Archive, is_public

def plain_url() -> Column:
    return F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), "/+$", "")


def duplicate_groups(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Groups of two and more rows with one key, every part of it told: (keys, canonical = least id, n)."""
    told = reduce(lambda x, y: x & y, [F.col(k).isNotNull() & (F.col(k).cast("string") != "") for k in keys])
    return df.where(told).groupBy(*keys).agg(F.min(id_col).alias("canonical"), F.count("*").alias("n")).where("n > 1")


@query("SELECT regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS key, min(page_id) AS canonical, count(*) AS n, string_agg(CAST(page_id AS VARCHAR), ',' ORDER BY page_id) AS members FROM pages GROUP BY 1 HAVING count(*) > 1")
def exact_url_dups(a: Archive) -> DataFrame:
    grouped = a.table("pages").groupBy(plain_url().alias("key")).agg(F.min("page_id").alias("canonical"), F.count("*").alias("n"), F.sort_array(F.collect_list("page_id")).alias("m")).where("n > 1")
    return grouped.select("key", "canonical", "n", F.array_join(F.col("m").cast("array<string>"), ",").alias("members"))


@query("SELECT code, year, source_id, min(record_id) AS canonical, count(*) AS n FROM records WHERE code <> '' AND year IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) > 1")
def title_year_pub_dups(a: Archive) -> DataFrame:
    return duplicate_groups(a.records, ["code", "year", "source_id"], "record_id")


@query(
    """SELECT basis, count(*) AS groups, CAST(sum(n) AS BIGINT) AS rows FROM (SELECT 'hash' AS basis, count(*) AS n FROM documents GROUP BY md5(text) HAVING count(*) > 1 UNION ALL SELECT 'source_head', count(*) FROM documents GROUP BY source || '|' || left(text, 40) HAVING count(*) > 1 UNION ALL SELECT 'lang_length', count(*) FROM documents GROUP BY lang || '|' || n_chars HAVING count(*) > 1) GROUP BY basis"""
)
def three_basis_dups(a: Archive) -> DataFrame:
    """Three keys of each row, unpivoted, so that all bases take one scan and one shuffle."""
    d = a.table("documents").select(F.md5(F.col("text").cast("binary")).alias("hash"), F.concat("source", F.lit("|"), F.left("text", F.lit(40))).alias("source_head"), F.concat("lang", F.lit("|"), F.col("n_chars").cast("string")).alias("lang_length"))
    groups = d.unpivot([], ["hash", "source_head", "lang_length"], "basis", "key").groupBy("basis", "key").agg(F.count("*").alias("n")).where("n > 1")
    return groups.groupBy("basis").agg(F.count("*").alias("groups"), F.sum("n").alias("rows"))


@query("SELECT md5(array_to_string(list_slice(string_split(trim(regexp_replace(lower(left(text, 900)), '[^a-z0-9]+', ' ', 'g')), ' '), 1, 160), ' ')) AS key, min(doc_id) AS canonical, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def prefix_dups(a: Archive) -> DataFrame:
    """Groups whose first 160 words of 900 characters are the same."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.left("text", F.lit(900))), "[^a-z0-9]+", " ")), " ")
    return a.table("documents").groupBy(F.md5(F.array_join(F.slice(words, 1, 160), " ").cast("binary")).alias("key")).agg(F.min("doc_id").alias("canonical"), F.count("*").alias("n")).where("n > 1")


@query("SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS survivor, count(*) AS n FROM events GROUP BY 1, 2")
def lead_dedupe(a: Archive) -> DataFrame:
    return a.table("events").groupBy("user_id", "event_type").agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("survivor"), F.count("*").alias("n"))


@query("SELECT regexp_replace(lower(p_type), '[^0-9a-z]', '', 'g') AS key, count(DISTINCT p_brand) AS names FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def name_fold_dups(a: Archive) -> DataFrame:
    return a.figures.groupBy(F.regexp_replace(F.lower("cluster"), "[^0-9a-z]", "").alias("key")).agg(F.countDistinct("figure").alias("names")).where("names > 1")


def checks(parts: dict[str, DataFrame]) -> DataFrame:
    """(check_name, failures): one count for each frame of offending rows."""
    counted = [df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check_name"), "failures") for name, df in parts.items()]
    return reduce(DataFrame.unionAll, counted)


@query(
    """SELECT 'duplicate_record_ids' AS check_name, count(*) AS failures FROM (SELECT 1 FROM records GROUP BY record_id HAVING count(*) > 1) UNION ALL SELECT 'orphan_label_rows', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
    UNION ALL SELECT 'orphan_place_links', count(*) FROM record_places WHERE record_id NOT IN (SELECT record_id FROM records) OR location_id NOT IN (SELECT location_id FROM places) UNION ALL SELECT 'orphan_figure_links', count(*) FROM record_places WHERE figure_id NOT IN (SELECT figure_id FROM figures)
    UNION ALL SELECT 'vectors_without_document', count(*) FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT 'sources_without_records', count(*) FROM sources WHERE source_id NOT IN (SELECT source_id FROM records)
    UNION ALL SELECT 'places_of_one_slot', count(*) FROM (SELECT 1 FROM record_places GROUP BY record_id, priority HAVING count(DISTINCT location_id) > 1) UNION ALL SELECT 'records_without_source', count(*) FROM records WHERE source_id NOT IN (SELECT source_id FROM sources)
    UNION ALL SELECT 'public_without_code', count(*) FROM public_records WHERE trim(COALESCE(code, '')) = '' UNION ALL SELECT 'public_without_date', count(*) FROM public_records WHERE trim(COALESCE(date_text, '')) = '' UNION ALL SELECT 'public_without_place', count(*) FROM public_records WHERE record_id NOT IN (SELECT record_id FROM record_places)
    UNION ALL SELECT 'public_without_relevance', count(*) FROM public_records WHERE trim(COALESCE(relevance, '')) = '' UNION ALL SELECT 'public_marked_suppressed', count(*) FROM public_records WHERE level = 'restricted_excluded' OR code = 'restricted_excluded' OR relevance = 'scope_excluded'"""
)
def structural_audit(a: Archive) -> DataFrame:
    """Thirteen counts of rows that shouldn't be: repeated and orphaned keys, and what public records lack."""
    r, public, links = a.records, a.public_records, a.record_places
    orphan = links.join(r.select("record_id"), "record_id", "left_anti").unionByName(links.join(r.select("record_id"), "record_id", "left_semi").select(links.columns).join(a.places.select("location_id"), "location_id", "left_anti"))
    lacks = lambda c: public.where(F.trim(F.coalesce(c, F.lit(""))) == "")
    docs = a.table("documents").select("doc_id")
    return checks({
        "duplicate_record_ids": r.groupBy("record_id").agg(F.count("*").alias("n")).where("n > 1"),
        "orphan_label_rows": a.table("labels").join(docs, "doc_id", "left_anti"),
        "orphan_place_links": orphan,
        "orphan_figure_links": links.join(a.figures.select("figure_id"), "figure_id", "left_anti"),
        "vectors_without_document": a.table("embeddings").select(F.col("vec_id").alias("doc_id")).join(docs, "doc_id", "left_anti"),
        "sources_without_records": a.sources.join(r.select("source_id"), "source_id", "left_anti"),
        "places_of_one_slot": links.groupBy("record_id", "priority").agg(F.min("location_id").alias("a"), F.max("location_id").alias("b")).where("a <> b"),
        "records_without_source": r.join(a.sources.select("source_id"), "source_id", "left_anti"),
        "public_without_code": lacks("code"),
        "public_without_date": lacks("date_text"),
        "public_without_place": public.join(links.select("record_id"), "record_id", "left_anti"),
        "public_without_relevance": lacks("relevance"),
        "public_marked_suppressed": public.where(~is_public()),
    })


@query(
    """SELECT name, failures = 0 AS passed, failures FROM (SELECT 'unique_record_ids' AS name, count(*) AS failures FROM (SELECT 1 FROM records GROUP BY record_id HAVING count(*) > 1) UNION ALL SELECT 'years_in_scope', count(*) FROM records WHERE year NOT BETWEEN 1995 AND 2001 UNION ALL SELECT 'restricted_in_public', count(*) FROM public_records WHERE level = 'restricted_excluded'
    UNION ALL SELECT 'contradiction', CAST(0 AS BIGINT) UNION ALL SELECT 'known_sources', count(*) FROM records WHERE source_id NOT IN (SELECT source_id FROM sources) UNION ALL SELECT 'blank_codes', count(*) FROM records WHERE code = '' UNION ALL SELECT 'unique_sources', count(*) FROM (SELECT 1 FROM sources GROUP BY source_id HAVING count(*) > 1)
    UNION ALL SELECT 'unique_links', count(*) FROM (SELECT 1 FROM record_places GROUP BY record_id, priority HAVING count(*) > 1) UNION ALL SELECT 'links_with_evidence', count(*) FROM record_places WHERE trim(evidence) = '' UNION ALL SELECT 'mapped_inside_bounds', count(*) FROM places WHERE lat NOT BETWEEN -46 AND -6 OR lon NOT BETWEEN 110 AND 156
    UNION ALL SELECT 'months_in_year', count(*) FROM records WHERE month NOT BETWEEN 1 AND 12 UNION ALL SELECT 'values_not_negative', count(*) FROM records WHERE value < 0 UNION ALL SELECT 'dates_agree_with_years', count(*) FROM records WHERE year IS NOT NULL AND left(date_text, 4) <> CAST(year AS VARCHAR))"""
)
def invariant_checks(a: Archive) -> DataFrame:
    """Thirteen named invariants with their verdicts. 'contradiction' (a column equal to one value and among others) can't fail and reads nothing."""
    repeated = lambda df, *keys: df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    out = checks({
        "unique_record_ids": repeated(a.records, "record_id"),
        "years_in_scope": a.records.where(~F.col("year").between(1995, 2001)),
        "restricted_in_public": a.public_records.where("level = 'restricted_excluded'"),
        "contradiction": a.spark.range(0),
        "known_sources": a.records.join(a.sources, "source_id", "left_anti"),
        "blank_codes": a.records.where("code = ''"),
        "unique_sources": repeated(a.sources, "source_id"),
        "unique_links": repeated(a.record_places, "record_id", "priority"),
        "links_with_evidence": a.record_places.where("trim(evidence) = ''"),
        "mapped_inside_bounds": a.places.where(~(F.col("lat").between(-46, -6) & F.col("lon").between(110, 156))),
        "months_in_year": a.records.where(~F.col("month").between(1, 12)),
        "values_not_negative": a.records.where("value < 0"),
        "dates_agree_with_years": a.records.where("year is not null and left(date_text, 4) <> cast(year as string)"),
    })
    return out.select(F.col("check_name").alias("name"), (F.col("failures") == 0).alias("passed"), "failures")


@query(
    """WITH b AS (SELECT COALESCE(band, 'undated') AS band, count(*) AS n FROM public_records LEFT JOIN bands ON year BETWEEN first_year AND last_year GROUP BY 1) SELECT 'bands_add_up' AS name, (SELECT sum(n) FROM b) = (SELECT count(*) FROM public_records) AS passed
    UNION ALL SELECT 'one_flag_a_record', NOT EXISTS (SELECT 1 FROM (SELECT record_id, arg_min(location_id, (priority, location_id)) FROM record_places GROUP BY 1) GROUP BY record_id HAVING count(*) > 1) UNION ALL SELECT 'no_withheld_words', NOT EXISTS (SELECT 1 FROM public_records WHERE contains(concat_ws('|', level, code, relevance), 'restricted'))"""
)
def release_validation(a: Archive) -> DataFrame:
    total = a.public_records.agg(F.count("*").alias("n"))
    by_band = a.public_records.groupBy("year").agg(F.count("*").alias("n")).agg(F.sum("n").alias("m"))
    flags = a.record_places.groupBy("record_id").agg(F.min(F.struct("priority", "location_id")).alias("f")).groupBy("record_id").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("n"))
    words = a.public_records.where(F.contains(F.to_json(F.struct("level", "code", "relevance")), F.lit("restricted"))).agg(F.count("*").alias("n"))
    ok = lambda df, name, c: df.select(F.lit(name).alias("name"), c.alias("passed"))
    return ok(total.crossJoin(by_band), "bands_add_up", F.col("n") == F.coalesce("m", F.lit(0))).unionAll(ok(flags, "one_flag_a_record", F.col("n") == 0)).unionAll(ok(words, "no_withheld_words", F.col("n") == 0))  # single rows meet


@query("SELECT l_suppkey AS location_id, count(*) AS orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1")
def fk_check(a: Archive) -> DataFrame:
    parents = a.table("orders").where("o_orderstatus <> 'P'").select("o_orderkey")
    l = a.table("lineitem")
    return l.join(parents, l["l_orderkey"] == parents["o_orderkey"], "left_anti").groupBy(F.col("l_suppkey").alias("location_id")).agg(F.count("*").alias("orphans"))


@query("SELECT 'missing' AS side, count(*) AS n FROM (SELECT DISTINCT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'extra', count(*) FROM (SELECT DISTINCT s_nationkey AS k FROM supplier EXCEPT SELECT c_nationkey FROM customer)")
def set_difference(a: Archive) -> DataFrame:
    c = a.table("customer").select(F.col("c_nationkey").alias("k")).distinct()
    s = a.table("supplier").select(F.col("s_nationkey").alias("k")).distinct()
    return checks({"missing": c.exceptAll(s), "extra": s.exceptAll(c)}).select(F.col("check_name").alias("side"), F.col("failures").alias("n"))


@query("SELECT issue, count(*) AS n FROM (SELECT unnest(CASE WHEN len(l) = 0 THEN ['ok'] ELSE l END) AS issue FROM (SELECT [x FOR x IN [CASE WHEN year IS NULL THEN 'undated' END, CASE WHEN code = '' THEN 'uncoded' END, CASE WHEN relevance IS NULL THEN 'unreviewed' END] IF x IS NOT NULL] AS l FROM public_records)) GROUP BY 1")
def card_issues(a: Archive) -> DataFrame:
    issues = F.array_compact(F.array(F.when(F.col("year").isNull(), "undated"), F.when(F.col("code") == "", "uncoded"), F.when(F.col("relevance").isNull(), "unreviewed")))
    return a.public_records.select(F.explode(F.when(F.size(issues) == 0, F.array(F.lit("ok"))).otherwise(issues)).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


@query("SELECT location_id, concat_ws(';', CASE WHEN lat NOT BETWEEN -44.5 AND -9.0 OR lon NOT BETWEEN 112.0 AND 154.5 THEN 'outside' END, CASE WHEN count(*) OVER (PARTITION BY round(lat), round(lon)) > 1 THEN 'crowded' END, CASE WHEN state LIKE 'UNITED%' THEN 'broad' END) AS issues FROM places")
def map_health(a: Archive) -> DataFrame:
    crowd = F.count("*").over(W.partitionBy(F.round("lat"), F.round("lon")))
    outside = ~F.col("lat").between(-44.5, -9.0) | ~F.col("lon").between(112.0, 154.5)
    return a.places.select("location_id", F.concat_ws(";", F.when(outside, "outside"), F.when(crowd > 1, "crowded"), F.when(F.startswith("state", F.lit("UNITED")), "broad")).alias("issues"))


@query("SELECT doc_id, concat_ws(';', CASE WHEN length(text) < 60 THEN 'thin_evidence' END, CASE WHEN contains(lower(text), 'password') OR contains(lower(text), 'token =') THEN 'sensitive' END, CASE WHEN toxic = 1 THEN 'tone' END, CASE WHEN quality IS NULL THEN 'unlabelled' END) AS queues FROM documents LEFT JOIN labels USING (doc_id) WHERE length(text) < 60 OR contains(lower(text), 'password') OR contains(lower(text), 'token =') OR toxic = 1 ORDER BY doc_id LIMIT 1000")
def review_queues(a: Archive) -> DataFrame:
    d = a.table("documents").join(a.table("labels"), "doc_id", "left")
    low = F.lower("text")
    thin, sensitive, tone = F.char_length("text") < 60, F.contains(low, F.lit("password")) | F.contains(low, F.lit("token =")), F.col("toxic") == 1
    return d.where(thin | sensitive | tone).select("doc_id", F.concat_ws(";", F.when(thin, "thin_evidence"), F.when(sensitive, "sensitive"), F.when(tone, "tone"), F.when(F.col("quality").isNull(), "unlabelled")).alias("queues")).orderBy("doc_id").limit(1000)


@query("WITH e AS (SELECT * FROM (VALUES ('BUILDING'),('MACHINERY'),('SHIPPING')) e(kind)), c AS (SELECT source_type AS kind, count(*) AS n FROM sources GROUP BY 1) SELECT COALESCE(e.kind, c.kind) AS kind, CASE WHEN c.kind IS NULL THEN 'missing' WHEN n > 0.2 * (SELECT count(*) FROM sources) THEN 'dominant' ELSE 'fine' END AS note FROM e FULL JOIN c ON e.kind = c.kind")
def imbalance_notes(a: Archive) -> DataFrame:
    expected = a.spark.createDataFrame([("BUILDING",), ("MACHINERY",), ("SHIPPING",)], "kind string")
    c = a.sources.groupBy(F.col("source_type").alias("kind")).agg(F.count("*").alias("n")).withColumn("all", F.sum("n").over(W.partitionBy()))
    return expected.join(c, "kind", "full").select("kind", F.when(F.col("n").isNull(), "missing").when(F.col("n") > 0.2 * F.col("all"), "dominant").otherwise("fine").alias("note"))


@query("SELECT location_id, CASE WHEN NOT (lat BETWEEN -44.5 AND -9.0 AND lon BETWEEN 112.0 AND 154.5) THEN 'outside_bounds' WHEN state LIKE 'UNITED%' THEN 'rejected_role' WHEN region = 'AFRICA' THEN 'unverified' WHEN place_name = '' THEN 'missing:place_name' ELSE '' END AS reason FROM places")
def strict_geo_gate(a: Archive) -> DataFrame:
    """The first check that a place fails, in their fixed order; empty for those that pass."""
    outside = ~(F.col("lat").between(-44.5, -9.0) & F.col("lon").between(112.0, 154.5))
    return a.places.select("location_id", F.when(outside, "outside_bounds").when(F.startswith("state", F.lit("UNITED")), "rejected_role").when(F.col("region") == "AFRICA", "unverified").when(F.col("place_name") == "", "missing:place_name").otherwise("").alias("reason"))


@query("SELECT record_id, CASE WHEN m <> '' THEN 'missing_required_fields:' || m WHEN level = 'restricted_excluded' THEN 'restricted_content' ELSE '' END AS reason FROM (SELECT record_id, level, concat_ws(',', CASE WHEN year IS NULL THEN 'year' END, CASE WHEN COALESCE(trim(code), '') = '' THEN 'code' END, CASE WHEN COALESCE(relevance, '') = '' THEN 'relevance' END) AS m FROM records)")
def required_field_gate(a: Archive) -> DataFrame:
    missing = F.concat_ws(",", F.when(F.col("year").isNull(), "year"), *[F.when(F.coalesce(F.trim(c), F.lit("")) == "", c) for c in ("code", "relevance")])
    return a.records.select("record_id", F.when(missing != "", F.concat(F.lit("missing_required_fields:"), missing)).when(F.col("level") == "restricted_excluded", "restricted_content").otherwise("").alias("reason"))


@query("SELECT p.page_id, CASE WHEN p.page_id > d.first THEN 'duplicate' WHEN length(html) > 3000 THEN 'accepted' WHEN p.page_id % 4 = 0 THEN 'lead_only' ELSE 'rejected' END AS decision FROM pages p JOIN (SELECT regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS u, min(page_id) AS first FROM pages GROUP BY 1) d ON d.u = regexp_replace(regexp_replace(p.url, '[?#].*$', ''), '/+$', '')")
def candidate_decision(a: Archive) -> DataFrame:
    p = a.table("pages").select("page_id", plain_url().alias("u"), F.char_length("html").alias("n"))
    first = p.groupBy("u").agg(F.min("page_id").alias("first"))
    decision = F.when(F.col("page_id") > F.col("first"), "duplicate").when(F.col("n") > 3000, "accepted").when(F.col("page_id") % 4 == 0, "lead_only").otherwise("rejected")
    return p.join(first, "u").select("page_id", decision.alias("decision"))


@query("SELECT record_id, location_id, priority FROM record_places JOIN places USING (location_id) WHERE relation NOT IN ('A') AND relation IN ('R','N') AND kind IN ('F','O') AND lat IS NOT NULL AND lon IS NOT NULL AND region <> 'ASIA' AND trim(COALESCE(evidence, '')) <> ''")
def map_eligibility(a: Archive) -> DataFrame:
    ok = ~F.col("relation").isin("A") & F.col("relation").isin("R", "N") & F.col("kind").isin("F", "O") & (F.trim(F.coalesce("evidence", F.lit(""))) != "")
    return a.record_places.where(ok).join(a.places.where("lat is not null and lon is not null and region <> 'ASIA'"), "location_id").select("record_id", "location_id", "priority")


@query("SELECT record_id, CASE WHEN r.record_id IS NULL THEN 'missing' WHEN m.record_id IS NOT NULL THEN 'already_mapped' WHEN level = 'restricted_excluded' THEN 'restricted' WHEN year IS NULL THEN 'no_text' ELSE 'applied' END AS decision FROM (SELECT i AS record_id FROM (SELECT unnest(range(1, 400)) AS i)) s LEFT JOIN records r USING (record_id) LEFT JOIN (SELECT DISTINCT record_id FROM record_places WHERE relation = 'R') m USING (record_id)")
def enrichment_decision(a: Archive) -> DataFrame:
    wanted = a.spark.range(1, 400).withColumnRenamed("id", "record_id")
    mapped = a.record_places.where("relation = 'R'").select("record_id").distinct().withColumn("m", F.lit(True))
    r = a.records.select("record_id", "level", "year", F.lit(True).alias("r"))
    j = wanted.join(r, "record_id", "left").join(mapped, "record_id", "left")
    return j.select("record_id", F.when(F.col("r").isNull(), "missing").when(F.col("m"), "already_mapped").when(F.col("level") == "restricted_excluded", "restricted").when(F.col("year").isNull(), "no_text").otherwise("applied").alias("decision"))


@query("SELECT event_type AS route, n, accepted, CASE WHEN accepted > 0.55 * n THEN 'productive' WHEN accepted > 0.45 * n THEN 'saturated' WHEN n > 0 THEN 'low_yield' ELSE 'untried' END AS capacity FROM (SELECT COALESCE(r.t, e.event_type) AS event_type, COALESCE(n, 0) AS n, COALESCE(accepted, 0) AS accepted FROM (VALUES ('click'),('view'),('unseen')) r(t) FULL JOIN (SELECT event_type, count(*) AS n, CAST(count_if(value > 50) AS BIGINT) AS accepted FROM events GROUP BY 1) e ON e.event_type = r.t)")
def route_capacity(a: Archive) -> DataFrame:
    """Classes of routes by their yield; routes that are configured but have no run come too."""
    configured = a.spark.createDataFrame([("click",), ("view",), ("unseen",)], "route string")
    e = a.table("events").groupBy(F.col("event_type").alias("route")).agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("accepted"))
    j = configured.join(e, "route", "full").na.fill(0)
    return j.withColumn("capacity", F.when(F.col("accepted") > 0.55 * F.col("n"), "productive").when(F.col("accepted") > 0.45 * F.col("n"), "saturated").when(F.col("n") > 0, "low_yield").otherwise("untried"))


@query("SELECT event_type, CAST(sum(n) AS BIGINT) AS n, CAST(sum(v) AS BIGINT) AS v, CAST(count(*) AS BIGINT) AS attempts FROM (SELECT event_type, ts < TIMESTAMP '2024-01-15' AS old, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS v FROM events GROUP BY 1, 2) GROUP BY 1")
def counter_merge(a: Archive) -> DataFrame:
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    totals = lambda df: df.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.floor("value")).alias("v"))
    return merge.merge_counters(totals(a.table("events").where(early)), totals(a.table("events").where(~early)), "event_type", ["n", "v"])


@query("SELECT source_id, source_name, COALESCE(NULLIF(source_type, ''), 'k' || nation_id) AS source_type FROM sources")
def coalesce_fill_update(a: Archive) -> DataFrame:
    old = a.sources.select("source_id", "source_name", F.nullif("source_type", F.lit("")).alias("source_type"))
    new = a.sources.select("source_id", F.concat(F.lit("k"), F.col("nation_id").cast("string")).alias("source_type"))
    return merge.fill_nulls(old, new, ["source_id"], ["source_type"])


@query("SELECT record_id, CASE WHEN relevance = 'in_scope' AND code = '' THEN 'lead_only' ELSE relevance END AS relevance, CASE WHEN relevance = 'in_scope' AND code = '' THEN trim(concat_ws(chr(10), level, 'downgraded')) ELSE level END AS level FROM records")
def conditional_update(a: Archive) -> DataFrame:
    met = (F.col("relevance") == "in_scope") & (F.col("code") == "")
    rows = a.records.select("record_id", "relevance", "level", met.alias("met"))
    return merge.update_where(rows, F.col("met"), relevance=F.lit("lead_only"), level=F.trim(F.concat_ws("\n", "level", F.lit("downgraded")))).drop("met")


@query("SELECT figure_id, figure FROM figures WHERE figure_id IN (SELECT figure_id FROM record_places WHERE quantity >= 49)")
def cleanup_unreferenced(a: Archive) -> DataFrame:
    return merge.delete_unreferenced(a.figures.select("figure_id", "figure"), a.record_places.where("quantity >= 49"), ["figure_id"])


@query("SELECT source_id, source_name, kind FROM (SELECT source_id, source_name, 'old' AS kind FROM sources WHERE source_id % 3 <> 0 UNION ALL SELECT source_id, source_name || '*', 'new' FROM sources WHERE source_id % 3 = 0)")
def upsert_state(a: Archive) -> DataFrame:
    """An upsert run twice: the second run changes nothing."""
    old = a.sources.select("source_id", "source_name", F.lit("old").alias("kind"))
    new = a.sources.where("source_id % 3 = 0").select("source_id", F.concat("source_name", F.lit("*")).alias("source_name"), F.lit("new").alias("kind"))
    return merge.upsert(merge.upsert(old, new, ["source_id"]), new, ["source_id"])


@query(
    """WITH c AS (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS u FROM pages WHERE page_id % 3 <> 0), f AS (SELECT u, min(page_id) AS candidate_id FROM c GROUP BY u)
    SELECT 'records' AS entity, count(*) AS n, CAST(max(id) AS BIGINT) AS top_id FROM (SELECT 1000 + row_number() OVER (ORDER BY candidate_id) AS id FROM f) UNION ALL SELECT 'mappings', count(*), max(candidate_id) FROM f UNION ALL SELECT 'second_run', CAST(0 AS BIGINT), CAST(0 AS BIGINT)"""
)
def promote_candidates(a: Archive) -> DataFrame:
    """Accepted candidates that have no mapping become records with new ids; a second run promotes none."""
    accepted = a.table("pages").where("page_id % 3 <> 0").select(F.col("page_id").alias("candidate_id"), plain_url().alias("u"))
    candidates = accepted.groupBy("u").agg(F.min("candidate_id").alias("candidate_id"))
    existing = a.spark.createDataFrame([(1000, "seed")], "record_id long, u string")
    mappings = a.spark.createDataFrame([], "candidate_id long, record_id long")

    def run(mapped: DataFrame) -> DataFrame:
        waiting = candidates.join(mapped.select("candidate_id"), "candidate_id", "left_anti")
        return merge.numbered_after(existing, waiting, "record_id", ["candidate_id"]).select("candidate_id", "record_id")

    first = run(mappings)
    second = run(merge.insert_missing(mappings, first, ["candidate_id"]))
    report = lambda name, df, c: df.agg(F.count("*").alias("n"), F.coalesce(F.max(c), F.lit(0)).cast("long").alias("top_id")).select(F.lit(name).alias("entity"), "n", "top_id")
    return report("records", first, "record_id").unionAll(report("mappings", first, "candidate_id")).unionAll(report("second_run", second, "record_id"))


@query(
    """WITH c AS (SELECT page_id, url, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS u, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title FROM pages WHERE page_id % 3 <> 0), f AS (SELECT u, min(page_id) AS candidate_id, arg_min(title, page_id) AS title FROM c GROUP BY u)
    SELECT candidate_id, 1000 + row_number() OVER (ORDER BY candidate_id) AS record_id, 'c' || CAST(candidate_id AS VARCHAR) AS external_id, COALESCE(NULLIF(title, ''), u) AS title, u AS url, 'public_page' AS publicness, left(sha256(u), 16) AS source_item FROM f"""
)
def promoted_rows(a: Archive) -> DataFrame:
    """The records, mappings and source items that accepted candidates become: one row each, with ids after those that are there."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    accepted = a.table("pages").where("page_id % 3 <> 0").select("page_id", plain_url().alias("u"), title.alias("title"))
    candidates = accepted.groupBy("u").agg(F.min("page_id").alias("candidate_id"), F.min_by("title", "page_id").alias("title"))
    existing = a.spark.createDataFrame([(1000,)], "record_id long")
    rows = merge.numbered_after(existing, candidates, "record_id", ["candidate_id"])
    told = F.coalesce(F.nullif("title", F.lit("")), "u")
    return rows.select("candidate_id", "record_id", F.concat(F.lit("c"), F.col("candidate_id").cast("string")).alias("external_id"), told.alias("title"), F.col("u").alias("url"), F.lit("public_page").alias("publicness"), F.left(F.sha2("u", 256), F.lit(16)).alias("source_item"))


@query(
    """SELECT 'source_items' AS entity, source_id AS parent, date_text AS value, min(record_id) AS first_record FROM records GROUP BY 2, 3 UNION ALL SELECT 'narratives', source_id, relevance, record_id FROM public_records UNION ALL SELECT 'exclusions', source_id, level, record_id FROM records WHERE record_id NOT IN (SELECT record_id FROM public_records)
    UNION ALL SELECT 'labels', record_id, code, record_id FROM public_records WHERE code <> '' UNION ALL SELECT 'mappings', record_id, 'r' || record_id, record_id FROM records"""
)
def migrated_rows(a: Archive) -> DataFrame:
    """Flat records taken apart into the normalised relations: source items, narratives, exclusions, labels and mappings, as rows."""
    rows = lambda df, entity, parent, value: df.select(F.lit(entity).alias("entity"), F.col(parent).cast("long").alias("parent"), value.alias("value"), F.col("record_id").alias("first_record"))
    items = a.records.groupBy("source_id", "date_text").agg(F.min("record_id").alias("record_id"))
    parts = [
        rows(items, "source_items", "source_id", F.col("date_text")),
        rows(a.public_records, "narratives", "source_id", F.col("relevance")),
        rows(a.records.where(~is_public()), "exclusions", "source_id", F.col("level")),
        rows(a.public_records.where("code <> ''"), "labels", "record_id", F.col("code")),
        rows(a.records, "mappings", "record_id", F.concat(F.lit("r"), F.col("record_id").cast("string"))),
    ]
    return reduce(DataFrame.unionAll, parts)


@query(
    """SELECT 'source_items' AS entity, count(*) AS n FROM (SELECT DISTINCT source_id, date_text FROM records) UNION ALL SELECT 'narratives', count(*) FROM public_records UNION ALL SELECT 'exclusions', count(*) FROM records WHERE record_id NOT IN (SELECT record_id FROM public_records) UNION ALL SELECT 'labels', count(*) FROM (SELECT DISTINCT record_id, code FROM public_records WHERE code <> '')"""
)
def migration_counts(a: Archive) -> DataFrame:
    """Flat records taken apart into the normalised relations: how many rows each gets."""
    return checks({
        "source_items": a.records.select("source_id", "date_text").distinct(),
        "narratives": a.public_records,
        "exclusions": a.records.where(~is_public()),
        "labels": a.public_records.where("code <> ''").select("record_id", "code").distinct(),
    }).select(F.col("check_name").alias("entity"), F.col("failures").alias("n"))


@query("SELECT record_id, CAST(greatest(1, least(5, 1 + CASE WHEN relevance = 'in_scope' THEN 2 ELSE 0 END + CASE WHEN code LIKE '1-%' THEN 2 WHEN code LIKE '2-%' THEN 1 ELSE 0 END - CASE WHEN level = 'restricted_excluded' THEN 4 ELSE 0 END)) AS INTEGER) AS priority FROM records")
def priority_score(a: Archive) -> DataFrame:
    points = F.lit(1) + F.when(F.col("relevance") == "in_scope", 2).otherwise(0) + F.when(F.startswith("code", F.lit("1-")), 2).when(F.startswith("code", F.lit("2-")), 1).otherwise(0) - F.when(F.col("level") == "restricted_excluded", 4).otherwise(0)
    return a.records.select("record_id", F.greatest(F.lit(1), F.least(F.lit(5), points)).alias("priority"))


@query("SELECT record_id, bool_or(trim(evidence) = '') AS needs_review, array_to_string(list_sort(list(DISTINCT relation)), '/') AS relations, CASE WHEN min(priority) = 1 THEN 'exact' WHEN min(priority) <= 3 THEN 'near' ELSE 'broad' END AS precision_label FROM record_places GROUP BY record_id")
def location_review(a: Archive) -> DataFrame:
    p = F.min("priority")
    return a.record_places.groupBy("record_id").agg(F.bool_or(F.trim("evidence") == "").alias("needs_review"), F.array_join(F.sort_array(F.collect_set("relation")), "/").alias("relations"), F.when(p == 1, "exact").when(p <= 3, "near").otherwise("broad").alias("precision_label"))


@query("SELECT record_id, location_id FROM (SELECT record_id, location_id, row_number() OVER (PARTITION BY record_id, location_id ORDER BY priority, figure_id, seen_at, quantity) AS k FROM record_places) WHERE k = 1")
def insert_or_ignore(a: Archive) -> DataFrame:
    return first_by(a.record_places, ["record_id", "location_id"], ["priority", "figure_id", "seen_at", "quantity"]).select("record_id", "location_id")
