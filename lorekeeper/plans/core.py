"""Scans, filters, joins and period queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lorekeeper.operators import periods
from lorekeeper.registry import query
from lorekeeper.sources.archive import BANDS, Archive, is_public


@query("SELECT record_id, source_id, year, level, code, relevance FROM public_records")
def public_filter(a: Archive) -> DataFrame:
    return a.public_records.select("record_id", "source_id", "year", "level", "code", "relevance")


@query("SELECT level, relevance, count(*) AS n FROM records WHERE COALESCE(level,'') = 'restricted_excluded' OR COALESCE(code,'') = 'restricted_excluded' OR COALESCE(relevance,'') = 'scope_excluded' GROUP BY ALL")
def restricted_complement(a: Archive) -> DataFrame:
    return a.records.where(~is_public()).groupBy("level", "relevance").agg(F.count("*").alias("n"))


@query("SELECT record_id, date_text FROM records WHERE trim(date_text) <> '' AND year IS NULL")
def unparsed_dates(a: Archive) -> DataFrame:
    return a.records.where((F.trim("date_text") != "") & F.col("year").isNull()).select("record_id", "date_text")


@query("SELECT source_type, count(*) AS n FROM sources WHERE source_type IN ('BUILDING','MACHINERY') AND source_id NOT IN (SELECT source_id FROM records WHERE relevance = 'scope_excluded') GROUP BY source_type")
def in_and_not_in(a: Archive) -> DataFrame:
    excluded = a.records.where("relevance = 'scope_excluded'").select("source_id")
    return a.sources.where(F.col("source_type").isin("BUILDING", "MACHINERY")).join(excluded, "source_id", "left_anti").groupBy("source_type").agg(F.count("*").alias("n"))


@query("SELECT doc_id, lang FROM documents WHERE text ILIKE 'the %' OR text ILIKE '%password%'")
def like_ci(a: Archive) -> DataFrame:
    return a.table("documents").where(F.col("text").ilike("the %") | F.col("text").ilike("%password%")).select("doc_id", "lang")


@query("SELECT record_id, CASE WHEN year IS NULL THEN 'undated' WHEN year BETWEEN 1995 AND 1996 THEN 'early' WHEN year BETWEEN 1997 AND 1999 THEN 'middle' ELSE 'late' END AS label FROM records")
def case_year_band(a: Archive) -> DataFrame:
    y = F.col("year")
    return a.records.select("record_id", F.when(y.isNull(), "undated").when(y.between(1995, 1996), "early").when(y.between(1997, 1999), "middle").otherwise("late").alias("label"))


@query("SELECT record_id, COALESCE(NULLIF(code,''), NULLIF(level,''), 'unknown') AS label FROM records")
def truthy_fallback(a: Archive) -> DataFrame:
    return a.records.select("record_id", truthy("code", "level").alias("label"))


def truthy(*columns: str, default: str = "unknown"):
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in columns], F.lit(default))


@query("SELECT source_id, source_name FROM sources WHERE contains(lower(concat_ws(' ', source_name, source_type, CAST(source_id AS VARCHAR))), 'build') ORDER BY source_id LIMIT 160")
def registry_search(a: Archive) -> DataFrame:
    text = F.lower(F.concat_ws(" ", "source_name", "source_type", F.col("source_id").cast("string")))
    return a.sources.where(F.contains(text, F.lit("build"))).orderBy("source_id").limit(160).select("source_id", "source_name")


@query("SELECT 'archive-v2' AS schema_version, source_id, source_name AS organisation FROM sources WHERE nation_id = 7")
def constant_columns(a: Archive) -> DataFrame:
    return a.spark.sql("SELECT :version AS schema_version, source_id, source_name AS organisation FROM {s} WHERE nation_id = :nation", args={"version": "archive-v2", "nation": 7}, s=a.sources)


@query("SELECT record_id, source_name, source_type, year, n_name AS jurisdiction FROM public_records JOIN sources USING (source_id) LEFT JOIN nation ON n_nationkey = nation_id")
def record_star_join(a: Archive) -> DataFrame:
    nation = F.broadcast(a.table("nation"))
    return a.public_records.join(a.sources, "source_id").join(nation, F.col("n_nationkey") == F.col("nation_id"), "left").select("record_id", "source_name", "source_type", "year", F.col("n_name").alias("jurisdiction"))


@query("SELECT rp.record_id, rp.location_id, priority, place_name, state, COALESCE(NULLIF(code,''), figure) AS label FROM record_places rp JOIN places USING (location_id) JOIN public_records USING (record_id) LEFT JOIN figures USING (figure_id)")
def location_bridge_join(a: Archive) -> DataFrame:
    joined = a.record_places.join(a.places, "location_id").join(a.public_records.select("record_id", "code"), "record_id").join(a.figures.select("figure_id", "figure"), "figure_id", "left")
    return joined.select("record_id", "location_id", "priority", "place_name", "state", F.coalesce(F.nullif("code", F.lit("")), "figure").alias("label"))


@query("SELECT record_id, source_name, n_name AS jurisdiction, r_name AS region, c AS places FROM records LEFT JOIN sources USING (source_id) LEFT JOIN nation ON n_nationkey = nation_id LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN (SELECT record_id, count(DISTINCT location_id) AS c FROM record_places GROUP BY 1) USING (record_id)")
def five_way_join(a: Archive) -> DataFrame:
    counts = a.record_places.groupBy("record_id").agg(F.countDistinct("location_id").alias("places"))
    out = a.records.join(a.sources, "source_id", "left").join(F.broadcast(a.table("nation")), F.col("n_nationkey") == F.col("nation_id"), "left").join(F.broadcast(a.table("region")), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return out.join(counts, "record_id", "left").select("record_id", "source_name", F.col("n_name").alias("jurisdiction"), F.col("r_name").alias("region"), "places")


@query("SELECT source_id, source_name, COALESCE(string_agg(CAST(record_id AS VARCHAR) || ':' || COALESCE(CAST(year AS VARCHAR),'?'), ';' ORDER BY record_id), '') AS children, count(record_id) AS n FROM sources LEFT JOIN public_records USING (source_id) GROUP BY 1, 2")
def nested_children(a: Archive) -> DataFrame:
    """Parents with their children as one ordered array, empty for the childless; flattened to text for comparison."""
    child = F.when(F.col("record_id").isNotNull(), F.struct("record_id", "year"))
    nested = a.sources.join(a.public_records, "source_id", "left").groupBy("source_id", "source_name").agg(F.sort_array(F.collect_list(child)).alias("c"))
    one = lambda x: F.concat_ws(":", x["record_id"].cast("string"), F.coalesce(x["year"].cast("string"), F.lit("?")))
    return nested.select("source_id", "source_name", F.array_join(F.transform("c", one), ";").alias("children"), F.size("c").cast("long").alias("n"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join_uncoded(a: Archive) -> DataFrame:
    return a.table("documents").join(a.table("labels"), "doc_id", "left_anti").select("doc_id", "lang")


@query("SELECT record_id, year FROM public_records r WHERE EXISTS (SELECT 1 FROM record_places p WHERE p.record_id = r.record_id AND p.relation = 'R') AND EXISTS (SELECT 1 FROM sources s WHERE s.source_id = r.source_id AND s.source_type <> '')")
def card_ready(a: Archive) -> DataFrame:
    return a.public_records.join(a.record_places.where("relation = 'R'"), "record_id", "left_semi").join(a.sources.where("source_type <> ''"), "source_id", "left_semi").select("record_id", "year")


@query("SELECT source_id, min(record_id) AS first_record FROM records WHERE level = 'public_page' GROUP BY source_id")
def first_match_lookup(a: Archive) -> DataFrame:
    return a.records.where("level = 'public_page'").groupBy("source_id").agg(F.min("record_id").alias("first_record"))


@query("SELECT record_id, string_agg(place_name || ' [' || relation || ']', '; ' ORDER BY priority, location_id, relation, place_name) AS summary FROM record_places JOIN places USING (location_id) GROUP BY record_id")
def location_summary(a: Archive) -> DataFrame:
    part = F.struct("priority", "location_id", "relation", "place_name")
    grouped = a.record_places.join(a.places, "location_id").groupBy("record_id").agg(F.sort_array(F.collect_list(part)).alias("p"))
    return grouped.select("record_id", F.array_join(F.transform("p", lambda x: F.concat(x["place_name"], F.lit(" ["), x["relation"], F.lit("]"))), "; ").alias("summary"))


@query("SELECT source_type || ':' || band AS plan, CASE WHEN n_name < 'F' THEN 'broad' ELSE 'exact' END AS mode, n_name AS term, first_year, last_year FROM (SELECT DISTINCT source_type FROM sources WHERE source_type <> '') CROSS JOIN bands CROSS JOIN nation")
def query_plan_expand(a: Archive) -> DataFrame:
    """Terms by bands by source types: the product of three fixed dimensions."""
    kinds = a.sources.where("source_type <> ''").select("source_type").distinct()
    product = F.broadcast(a.bands).crossJoin(F.broadcast(a.table("nation"))).crossJoin(F.broadcast(kinds))
    return product.select(F.concat_ws(":", "source_type", "band").alias("plan"), F.when(F.col("n_name") < "F", "broad").otherwise("exact").alias("mode"), F.col("n_name").alias("term"), "first_year", "last_year")


@query("SELECT band, count(*) AS queries FROM (SELECT source_id, min(year) AS y1, CASE WHEN source_id % 10 = 0 THEN 9999 ELSE max(year) END AS y2 FROM records GROUP BY source_id) JOIN bands ON y1 <= last_year AND COALESCE(y2, y1) >= first_year GROUP BY band")
def interval_overlap(a: Archive) -> DataFrame:
    spans = a.records.groupBy("source_id").agg(F.min("year").alias("y1"), F.max("year").alias("y2"))
    spans = spans.withColumn("y2", F.when(F.col("source_id") % 10 == 0, periods.PRESENT).otherwise(F.col("y2")))
    return periods.interval_overlaps(spans, a.bands, "y1", "y2").groupBy("band").agg(F.count("*").alias("queries"))


@query("SELECT record_id, COALESCE(band, CASE WHEN year IS NULL THEN 'undated' ELSE 'outside_scope' END) AS band FROM records LEFT JOIN bands ON year BETWEEN first_year AND last_year")
def year_to_band(a: Archive) -> DataFrame:
    return a.records.select("record_id", periods.band_of(F.col("year"), BANDS).alias("band"))


@query(
    """SELECT COALESCE(b.band, c.band) AS band, COALESCE(records, 0) AS records, COALESCE(mapped, 0) AS mapped, round(CASE WHEN records > 0 THEN mapped / records ELSE 0 END, 6) AS mapped_share,
    last_year - first_year + 1 AS span_years, round(COALESCE(records, 0) / (last_year - first_year + 1), 6) AS records_per_year
    FROM bands b FULL JOIN (SELECT COALESCE(band, CASE WHEN year IS NULL THEN 'undated' ELSE 'outside_scope' END) AS band, count(*) AS records, CAST(count_if(record_id IN (SELECT record_id FROM record_places WHERE relation = 'R')) AS BIGINT) AS mapped
      FROM public_records LEFT JOIN bands ON year BETWEEN first_year AND last_year GROUP BY 1) c ON b.band = c.band"""
)
def band_summary(a: Archive) -> DataFrame:
    return periods.band_summary(a.public_records.select("record_id", "year"), a.record_places.where("relation = 'R'"), BANDS)


@query("SELECT location_id, CASE WHEN lat BETWEEN -29 AND -10 AND lon BETWEEN 138 AND 154 THEN 'QLD' WHEN lat BETWEEN -37.6 AND -28 AND lon BETWEEN 141 AND 154 THEN 'NSW' WHEN lat BETWEEN -39.3 AND -34 AND lon BETWEEN 141 AND 150 THEN 'VIC' WHEN lat BETWEEN -44 AND -39.3 AND lon BETWEEN 143 AND 149 THEN 'TAS' WHEN lat BETWEEN -38 AND -26 AND lon BETWEEN 129 AND 141 THEN 'SA' WHEN lat BETWEEN -26 AND -10 AND lon BETWEEN 129 AND 138 THEN 'NT' WHEN lat BETWEEN -36 AND -13 AND lon BETWEEN 112 AND 129 THEN 'WA' END AS state_box FROM places")
def bbox_state(a: Archive) -> DataFrame:
    """The first of some overlapping boxes, in their fixed order, that holds a point."""
    boxes = [("QLD", -29, -10, 138, 154), ("NSW", -37.6, -28, 141, 154), ("VIC", -39.3, -34, 141, 150), ("TAS", -44, -39.3, 143, 149), ("SA", -38, -26, 129, 141), ("NT", -26, -10, 129, 138), ("WA", -36, -13, 112, 129)]
    ladder = F
    for name, s, n, w, e in boxes:
        ladder = ladder.when(F.col("lat").between(float(s), float(n)) & F.col("lon").between(float(w), float(e)), name)
    return a.places.select("location_id", ladder.alias("state_box"))


@query(
    """WITH k AS (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS u, page_id % 50 AS ext FROM pages)
    SELECT page_id, CASE WHEN EXISTS (SELECT 1 FROM k b WHERE b.u = k.u AND b.ext = k.ext AND b.page_id < k.page_id) THEN 'url_and_id' WHEN EXISTS (SELECT 1 FROM k b WHERE b.u = k.u AND b.page_id < k.page_id) THEN 'url_only' ELSE 'new' END AS verdict FROM k"""
)
def dup_candidate_probe(a: Archive) -> DataFrame:
    """Whether an earlier candidate has the same address and external id, or the address alone."""
    url = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), "/+$", "")
    k = a.table("pages").select("page_id", url.alias("u"), (F.col("page_id") % 50).alias("ext"))
    by_both = k.groupBy("u", "ext").agg(F.min("page_id").alias("first_both"))
    by_url = k.groupBy("u").agg(F.min("page_id").alias("first_url"))
    verdict = F.when(F.col("first_both") < F.col("page_id"), "url_and_id").when(F.col("first_url") < F.col("page_id"), "url_only").otherwise("new")
    return k.join(by_both, ["u", "ext"]).join(by_url, "u").select("page_id", verdict.alias("verdict"))


@query("SELECT i.id AS record_id, CASE WHEN r.record_id IS NULL THEN 'missing' WHEN level = 'restricted_excluded' THEN 'already_suppressed' ELSE 'suppress' END AS action FROM (VALUES (1),(2),(3),(4),(5),(6),(7),(8),(-1),(-2)) i(id) LEFT JOIN records r ON r.record_id = i.id")
def curated_suppression(a: Archive) -> DataFrame:
    ids = F.broadcast(a.spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6, 7, 8, -1, -2)], "id long"))
    found = ids.join(a.records, ids["id"] == F.col("record_id"), "left")
    action = F.when(F.col("record_id").isNull(), "missing").when(F.col("level") == "restricted_excluded", "already_suppressed").otherwise("suppress")
    return found.select(F.col("id").cast("int").alias("record_id"), action.alias("action"))


@query("SELECT record_id, TRY_CAST(substr(trim(date_text), 1, 4) AS INTEGER) AS safe_year, TRY_CAST(code AS INTEGER) AS bad_int, TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS safe_float FROM records")
def safe_cast(a: Archive) -> DataFrame:
    return a.records.select("record_id", periods.leading_year(F.col("date_text")).alias("safe_year"), F.col("code").try_cast("int").alias("bad_int"), F.col("value").cast("string").try_cast("double").alias("safe_float"))


@query("SELECT record_id, CASE WHEN t ~ '^[0-9]{4}-[0-9]{2}-[0-9]{2}' THEN 'exact_day' WHEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}') THEN 'month' WHEN regexp_full_match(t, '[0-9]{4}') THEN 'year' ELSE 'unknown' END AS date_precision, TRY_CAST(NULLIF(regexp_extract('c. ' || t, '\\b(1[7-9][0-9]{2}|20[0-9]{2})\\b', 1), '') AS INTEGER) AS parsed FROM (SELECT record_id, CASE record_id % 4 WHEN 0 THEN '' WHEN 1 THEN substr(date_text, 1, 4) WHEN 2 THEN substr(date_text, 1, 7) ELSE date_text END AS t FROM records)")
def date_precision(a: Archive) -> DataFrame:
    k = F.col("record_id") % 4
    t = a.records.select("record_id", F.when(k == 0, "").when(k == 1, F.substring("date_text", 1, 4)).when(k == 2, F.substring("date_text", 1, 7)).otherwise(F.col("date_text")).alias("t"))
    return t.select("record_id", periods.date_precision(F.col("t")).alias("date_precision"), periods.year_in(F.concat(F.lit("c. "), "t")).alias("parsed"))


@query("SELECT location_id, place_name, prev_name, next_name FROM (SELECT location_id, place_name, lag(place_name) OVER w AS prev_name, lead(place_name) OVER w AS next_name FROM places WINDOW w AS (PARTITION BY state ORDER BY place_name, location_id))")
def prev_next_nav(a: Archive) -> DataFrame:
    w = W.partitionBy("state").orderBy("place_name", "location_id")
    return a.places.select("location_id", "place_name", F.lag("place_name").over(w).alias("prev_name"), F.lead("place_name").over(w).alias("next_name"))
