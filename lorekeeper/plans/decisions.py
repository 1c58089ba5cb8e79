"""Queries of decisions on leads and candidates, over the driver's tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekeeper.functions import text as t
from lorekeeper.operators import decisions as d
from lorekeeper.registry import query
from lorekeeper.sources.archive import Archive


@query("SELECT event_id FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN 'planned_public_query' ELSE event_type END AS a, CASE WHEN user_id % 3 = 0 THEN 'ok_public_source' ELSE 'blocked' END AS b, CASE WHEN event_id % 4 = 0 THEN 'BLOCKED_BARE_QUERY' WHEN event_id % 4 = 1 THEN NULL ELSE 'ok' END AS c FROM events) WHERE a = 'planned_public_query' AND b = 'ok_public_source' AND c IS DISTINCT FROM 'BLOCKED_BARE_QUERY'")
def planned_lead_filter(a: Archive) -> DataFrame:
    e = a.table("events").select("event_id", F.when(F.col("event_type") == "view", "planned_public_query").otherwise(F.col("event_type")).alias("collection_action"), F.when(F.col("user_id") % 3 == 0, "ok_public_source").otherwise("blocked").alias("source_publicness_guard"), F.when(F.col("event_id") % 4 == 0, "BLOCKED_BARE_QUERY").when(F.col("event_id") % 4 != 1, "ok").alias("high_noise_guard"))
    return d.planned_leads(e).select("event_id")


@query("""SELECT figure_id, trim(lower(figure), '"') IN ('brand#11', 'brand#23') AS bare FROM figures""")
def bare_queries(a: Archive) -> DataFrame:
    return a.figures.select("figure_id", d.is_bare(F.concat(F.lit('"'), "figure", F.lit('"')), ["brand#11", "brand#23"]).alias("bare"))


def _lambert(lat: Column, lon: Column) -> Column:
    p1, p2, l0 = math.radians(-18), math.radians(-36), math.radians(132)
    n = math.log(math.cos(p1) / math.cos(p2)) / math.log(math.tan(math.pi / 4 + p2 / 2) / math.tan(math.pi / 4 + p1 / 2))
    f = math.cos(p1) * math.tan(math.pi / 4 + p1 / 2) ** n / n
    rho, theta = F.lit(f) * F.pow(F.tan(math.pi / 4 + F.radians(lat) / 2), F.lit(-n)), n * (F.radians(lon) - l0)
    return F.struct((rho * F.sin(theta)).alias("x"), (f - rho * F.cos(theta)).alias("y"))


@query(
    """WITH c AS (SELECT radians(-18.0) AS p1, radians(-36.0) AS p2, radians(132.0) AS l0), n AS (SELECT *, ln(cos(p1) / cos(p2)) / ln(tan(pi() / 4 + p2 / 2) / tan(pi() / 4 + p1 / 2)) AS n FROM c), f AS (SELECT *, cos(p1) * pow(tan(pi() / 4 + p1 / 2), n) / n AS f FROM n),
    g AS (SELECT location_id, lat, lon, CASE WHEN location_id % 5 = 0 THEN NULL WHEN location_id % 5 = 1 THEN lon * 2 ELSE lon END AS x, CASE WHEN location_id % 5 = 1 THEN -lat ELSE lat END AS y FROM places),
    h AS (SELECT *, CASE WHEN x BETWEEN 110 AND 160 AND y BETWEEN -45 AND -8 THEN 1 WHEN x BETWEEN 0 AND 1000 AND y BETWEEN 0 AND 800 THEN 2 ELSE 3 END AS way FROM g), i AS (SELECT *, CASE WHEN way = 1 THEN y ELSE lat END AS la, CASE WHEN way = 1 THEN x ELSE lon END AS lo FROM h)
    SELECT location_id, round(CASE WHEN way = 2 THEN x ELSE f * pow(tan(pi() / 4 + radians(la) / 2), -n) * sin(n * (radians(lo) - l0)) END, 6) AS x, round(CASE WHEN way = 2 THEN y ELSE f - f * pow(tan(pi() / 4 + radians(la) / 2), -n) * cos(n * (radians(lo) - l0)) END, 6) AS y FROM i, f"""
)
def map_positions(a: Archive) -> DataFrame:
    """Positions of flags: degrees, places of the picture, or the record's own coordinates."""
    k = F.col("location_id") % 5
    x, y = F.when(k == 1, F.col("lon") * 2).when(k != 0, F.col("lon")), F.when(k == 1, -F.col("lat")).otherwise(F.col("lat"))
    p = a.places.select("location_id", d.map_position(x, y, F.col("lat"), F.col("lon"), _lambert, 1000, 800).alias("p"))
    return p.select("location_id", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


@query(f"SELECT figure_id, 'The source reports or discusses ' || figure || ' in ''' || label || ''' (' || CASE WHEN figure_id % 7 = 0 THEN 'public source' ELSE cluster END || '). ' || CASE WHEN figure_id % 3 = 0 THEN '{d.NO_EXCERPT}' ELSE left(label, 360) END AS summary FROM figures")
def concise_summary(a: Archive) -> DataFrame:
    source, snippet = F.when(F.col("figure_id") % 7 != 0, F.col("cluster")), F.when(F.col("figure_id") % 3 == 0, " ").otherwise(F.col("label"))
    return a.figures.select("figure_id", d.summary(F.col("label"), F.col("figure"), source, snippet).alias("summary"))


@query(
    """WITH r(term, level, constraints) AS (VALUES ('brand#11', 'very_high', ['"Brand#11" AND tin', '"Brand#11" AND steel']), ('brand#23', NULL, ['"Brand#23" AND copper'])), a AS (SELECT DISTINCT figure AS alias FROM figures)
    SELECT alias, unnest(COALESCE(constraints, ['"' || alias || '"'])) AS query, CASE WHEN term IS NULL THEN 'exact_phrase' ELSE 'constrained_boolean' END AS kind, CASE WHEN term IS NOT NULL THEN COALESCE(level, 'high') WHEN length(alias) <= 5 THEN 'medium' ELSE 'low' END AS noise FROM a LEFT JOIN r ON term = lower(alias)"""
)
def planned_queries(a: Archive) -> DataFrame:
    rules = a.spark.createDataFrame([("Brand#11", "very_high", ['"Brand#11" AND tin', '"Brand#11" AND steel']), ("BRAND#23", None, ['"Brand#23" AND copper'])], "term string, level string, constraints array<string>")
    return d.planned_queries(a.figures.select(F.col("figure").alias("alias")).distinct(), rules)


@query("SELECT source_id, COALESCE(NULLIF(source_type, ''), CASE WHEN r THEN 'metadata' ELSE 'unspecified' END) AS tier, NOT o AS accepted, o AS discovery_only, r AS needs_review FROM (SELECT source_id, source_type, regexp_matches(x, 'build|000000007') AS o, regexp_matches(x, 'machin|9') AS r FROM (SELECT source_id, source_type, lower(concat_ws(' ', source_type, source_name)) AS x FROM sources))")
def source_tier_status(a: Archive) -> DataFrame:
    return a.sources.select("source_id", d.tier_status(F.col("source_type"), F.lit(None).cast("string"), F.col("source_name"), ["build", "000000007"], ["machin", "9"]).alias("s")).select("source_id", "s.*")


@query("SELECT doc_id, COALESCE(reason, '') = '' AS keep, COALESCE(reason, '') AS reason FROM (SELECT doc_id, CASE lang WHEN 'en' THEN CASE WHEN NOT regexp_matches(x, 'password|idiot') THEN 'ordinary_description' END WHEN 'de' THEN CASE WHEN NOT contains(x, 'schaft') THEN 'metaphor' END WHEN 'fr' THEN CASE WHEN regexp_matches(x, 'de (la|des)') THEN 'idiom' END END AS reason FROM (SELECT doc_id, lang, lower(trim(regexp_replace(COALESCE(text, ''), '\\s+', ' ', 'g'))) AS x FROM documents))")
def scope_decisions(a: Archive) -> DataFrame:
    """Labels (here languages) that need a strong word in the text, and one that must not be an idiom."""
    rules, idioms = [(["en"], ["password", "idiot"], "ordinary_description"), (["de"], ["schaft"], "metaphor")], [(["fr"], "de (la|des)", "idiom")]
    return a.table("documents").select("doc_id", d.scope_decision(F.col("lang"), F.col("text"), rules, idioms).alias("s")).select("doc_id", "s.keep", "s.reason")


@query(
    """WITH p AS (SELECT r.record_id, r.priority, r.location_id, lat, lon, state, region FROM record_places r JOIN places USING (location_id)), w AS (SELECT record_id, CASE WHEN record_id % 2 = 0 THEN 'CHINA' ELSE '' END AS wanted, count(*) AS n FROM record_places GROUP BY 1),
    f AS (SELECT p.record_id, arg_min(location_id, (priority, location_id)) AS location_id FROM p JOIN w USING (record_id) WHERE lat BETWEEN -45 AND -8 AND lon BETWEEN 110 AND 160 AND (wanted = '' OR state = wanted) AND region <> 'AFRICA' GROUP BY 1)
    SELECT w.record_id, f.location_id, CASE WHEN f.location_id IS NULL THEN 'no_result_matching_state_or_precision' ELSE 'accepted' END AS reason FROM w LEFT JOIN f USING (record_id)"""
)
def geocode_choice(a: Archive) -> DataFrame:
    """Of the results of each record, at most a few, the first that fits."""
    kind = F.when(F.col("region") == "AFRICA", "country").otherwise("site")
    found = a.record_places.select("record_id", "priority", "location_id").join(a.places, "location_id")
    results = found.groupBy("record_id").agg(F.sort_array(F.collect_list(F.struct("priority", "location_id", "lat", "lon", "state", kind.alias("kind")))).alias("results"))
    wanted = F.when(F.col("record_id") % 2 == 0, "CHINA").otherwise("")
    return results.select("record_id", d.choose_result(F.col("results"), wanted).alias("c")).select("record_id", F.col("c.result.location_id").alias("location_id"), "c.reason")


@query("SELECT location_id, unnest(CASE WHEN location_id % 3 = 0 THEN [place_name || ', ' || state || ', Australia', 'East, ' || state || ', Australia'] ELSE [place_name || ', ' || state || ', Australia'] END) AS query, unnest(CASE WHEN location_id % 3 = 0 THEN ['source_text_split', 'source_text_split'] ELSE ['source_text_cleaned'] END) AS reason FROM places WHERE location_id % 3 <> 0 AND location_id % 10 <> 0 UNION ALL SELECT location_id, unnest([place_name || '/East, ' || state || ', Australia', place_name || ', ' || state || ', Australia', 'East, ' || state || ', Australia']), unnest(['source_text_cleaned', 'source_text_split', 'source_text_split']) FROM places WHERE location_id % 3 = 0 AND location_id % 10 <> 0")
def geocode_queries(a: Archive) -> DataFrame:
    """What to ask a gazetteer for each place, places of two names also by each; what is no place gives nothing."""
    name = F.when(F.col("location_id") % 10 == 0, "unknown").when(F.col("location_id") % 3 == 0, F.concat("place_name", F.lit("/East"))).otherwise(F.col("place_name"))
    asked = d.query_variants(name, F.col("state"), F.lit(None).cast("array<string>"), ["unknown"])
    return a.places.select("location_id", F.explode(asked).alias("q")).select("location_id", "q.query", "q.reason")


@query("SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'rejected' WHEN n < 240 AND doc_id % 5 <> 0 THEN 'lead_only' WHEN NOT the OR NOT of_ THEN 'lead_only' ELSE 'accepted' END AS status, CASE WHEN doc_id % 11 = 0 THEN 'seed_missing_url' WHEN n < 240 AND doc_id % 5 <> 0 THEN 'public_text_too_short_for_acceptance' WHEN NOT the THEN 'expected_source_label_not_found_in_public_text' WHEN NOT of_ THEN 'expected_place_not_found_in_public_text' ELSE '' END AS reason FROM (SELECT doc_id, length(c) AS n, regexp_matches(c, '(?i)(^|[^\\p{L}\\p{N}_])the($|[^\\p{L}\\p{N}_])') AS the, regexp_matches(c, '(?i)(^|[^\\p{L}\\p{N}_])of($|[^\\p{L}\\p{N}_])') AS of_ FROM (SELECT doc_id, trim(regexp_replace(COALESCE(text, ''), '\\s+', ' ', 'g')) AS c FROM documents))")
def seed_acceptance(a: Archive) -> DataFrame:
    url, short = F.when(F.col("doc_id") % 11 != 0, "https://example.org"), F.col("doc_id") % 5 == 0
    none = F.lit(None).cast("string")
    return a.table("documents").select("doc_id", d.seed_decision(url, F.col("text"), F.lit("The"), F.lit("of"), none, short).alias("s")).select("doc_id", "s.status", "s.reason")


@query("SELECT page_id, CASE WHEN reason = '' THEN 'accepted' ELSE 'lead_only' END AS status, reason FROM (SELECT page_id, CASE WHEN contains(url, '?') THEN 'tourism_discovery_only' WHEN page_id % 7 = 0 THEN 'weak_or_ambiguous_supernatural_term_requires_manual_review' WHEN NOT regexp_matches(lower(title), 'the|und') THEN 'supernatural_term_only_in_navigation_or_page_boilerplate' WHEN length(html) < 3000 THEN 'requires_location_or_source_review' ELSE '' END AS reason FROM (SELECT page_id, url, html, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title FROM pages))")
def lead_promotion(a: Archive) -> DataFrame:
    p = a.table("pages").withColumn("title", F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    status, label = F.when(F.char_length("html") < 3000, "weak_lead").otherwise("review_candidate"), F.when(F.col("page_id") % 7 == 0, "Haunt").otherwise("Ghost")
    return p.select("page_id", d.lead_decision(status, label, F.col("title"), F.contains("url", F.lit("?")), ["Haunt"], ["the", "und"]).alias("s")).select("page_id", "s.status", "s.reason")


@query(
    r"""WITH p AS (SELECT doc_id AS page_id, source AS url, trim(regexp_replace(COALESCE(text, ''), '\s+', ' ', 'g')) AS text FROM documents), v(place, alias) AS (VALUES ('north', 'the'), ('south', 'und'), ('west', 'dans')),
    j AS (SELECT page_id, url, place, alias, text, length(regexp_extract(text, '(?is)^(.*?)\b' || alias || '\b', 1)) AS spot, length(regexp_extract(text, '(?s)^(.*?)password', 1)) AS near FROM p JOIN v ON regexp_matches(text, '(?i)\b' || alias || '\b') WHERE length(text) >= 120 AND contains(text, 'password')),
    w AS (SELECT *, CAST(greatest(0, least(spot, near) - 520) AS BIGINT) AS s, CAST(least(length(text), greatest(spot + length(alias), near + 8) + 520) AS BIGINT) AS e FROM j), x AS (SELECT *, substr(text, s + 1, e - s) AS evidence FROM w),
    y AS (SELECT page_id, place, s AS start, e AS "end", sha256(lower(trim(url || ':' || place || ':' || evidence))) AS digest FROM x WHERE contains(evidence, 'password') AND NOT contains(evidence, 'idiot'))
    SELECT page_id, place, start, "end", digest FROM (SELECT *, row_number() OVER (PARTITION BY digest ORDER BY page_id, place) AS k FROM y) WHERE k = 1"""
)
def place_evidence(a: Archive) -> DataFrame:
    """Hits of a strong word at named places, with their evidence, as the routes of pages and of search results collect them."""
    pages = a.table("documents").select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), "text")
    places = a.spark.createDataFrame([("north", "the"), ("south", "und"), ("west", "dans")], "place string, alias string")
    return d.placed_evidence(pages, places, "password", "idiot")


@query(
    r"""WITH l AS (SELECT doc_id, source, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS block FROM (SELECT doc_id, source, [x FOR x IN string_split(text, chr(10)) IF length(trim(x)) >= 90] AS ls FROM documents WHERE regexp_matches(lower(text), 'the|und')) WHERE len(ls) > 0),
    f AS (SELECT doc_id AS item_id, CAST(block AS BIGINT) AS block, CASE WHEN contains(lower(line), 'password') THEN 'password' WHEN contains(lower(line), 'idiot') THEN 'idiot' WHEN contains(lower(line), 'tion') THEN 'tion' END AS term, sha256(lower(trim(regexp_replace(source || ':' || line, '[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+', ' ', 'g')))) AS digest FROM l)
    SELECT item_id, block, term, digest FROM (SELECT *, row_number() OVER (PARTITION BY item_id, digest ORDER BY block) AS k FROM f WHERE term IS NOT NULL) WHERE k = 1"""
)
def ocr_blocks(a: Archive) -> DataFrame:
    items = a.table("documents").select(F.col("doc_id").alias("item_id"), F.col("source").alias("url"), "text")
    return d.first_term_blocks(items, ["password", "idiot", "tion"], ["the", "und"])


@query("SELECT CAST(page_id AS VARCHAR) AS external_id, 'lead_only' AS candidate_status, url, '' AS narrative_type, CAST(length(html) AS VARCHAR) AS evidence_summary FROM pages")
def candidate_rows(a: Archive) -> DataFrame:
    fields = ["external_id", "candidate_status", "url", "narrative_type", "evidence_summary"]
    return d.candidate_rows(a.table("pages"), fields, {"external_id": F.col("page_id"), "url": F.col("url"), "evidence_summary": F.char_length("html")}, {"candidate_status": "lead_only"})


@query(r"SELECT item_id, CASE WHEN regexp_matches(x, '\bthe\b') THEN contains(x, 'tion') ELSE regexp_matches(x, 'und|de') END AS regional FROM (SELECT item_id, lower(text) AS x FROM benchmark)")
def regional_signals(a: Archive) -> DataFrame:
    return a.table("benchmark").select("item_id", d.regional_signal(F.col("text"), ["und", "de"], "the", ["tion"]).alias("regional"))


@query("SELECT source_id, contains(lower(source_type), 'tourism') OR contains(lower(source_name), '00004') AS promoted, CASE WHEN contains(lower(source_name), '00004') THEN 'lead_only' ELSE 'accepted' END AS decision FROM sources")
def promotion_downgrade(a: Archive) -> DataFrame:
    from lorekeeper.operators.merge import update_where

    s = a.sources.select("source_id", d.only_promotion(F.col("source_type"), F.col("source_name"), F.lit(None).cast("string"), ["00004"], ["visit"]).alias("promoted"), F.lit("accepted").alias("decision"))
    return update_where(s, F.col("promoted"), decision=F.lit("lead_only"))


@query(
    r"""WITH h AS (SELECT doc_id, source, text, trim(regexp_replace(COALESCE(text, ''), '\s+', ' ', 'g')) AS flat FROM documents), c AS (SELECT doc_id, regexp_replace(flat, '(?i)\b(?:1[7-9][0-9]{2}|20[0-9]{2})\b|\([^)]*\)|\bAustralia\b|\bthe\b|\bof\b', '', 'g') AS c FROM h)
    SELECT doc_id, md5(COALESCE(NULLIF(trim(regexp_replace(regexp_extract(c, '(?s)^[ ,.-]*(.*?)(?:[ ,.-]*\s-\s|[ ,.-]*\s:|,|[ ,.-]*$)', 1), '\s+', ' ', 'g')), ''), 'the')) AS place FROM c"""
)
def inferred_places(a: Archive) -> DataFrame:
    """What texts, read as headings, are about, where "the" and "of" stand for a state's name and code."""
    flat = t.collapsed(F.col("text"))
    return a.table("documents").select("doc_id", F.md5(t.place_of(flat, F.lit("the"), F.lit("of")).cast("binary")).alias("place"))


@query("SELECT location_id, CASE WHEN location_id % 4 = 0 THEN NULL ELSE 'Bega' END AS place, CASE WHEN location_id % 4 = 0 THEN NULL WHEN location_id % 2 = 0 THEN 'NSW' ELSE 'VIC' END AS state, CAST(CASE WHEN location_id % 4 <> 0 THEN 1900 + location_id % 100 END AS INTEGER) AS year FROM places")
def title_places(a: Archive) -> DataFrame:
    k = F.col("location_id")
    title = F.concat(F.when(k % 4 == 0, "Local News, ").otherwise("Bega,  "), F.when(k % 2 == 0, "new south wales ").otherwise("VIC "), (F.lit(1900) + k % 100).cast("string"))
    found = t.place_state_year(title, {"New South Wales": "NSW", "Victoria": "VIC"}, ("article", "magazine", "news"))
    return a.places.select("location_id", found.alias("x")).select("location_id", "x.place", "x.state", "x.year")


@query("SELECT doc_id, md5(CASE WHEN q > 1 THEN left(c, q - 1) ELSE c END) AS h FROM (SELECT doc_id, c, instr(lower(c), 'idiot') AS q FROM (SELECT doc_id, CASE WHEN p > 0 THEN substr(text, p) ELSE text END AS c FROM (SELECT doc_id, text, instr(lower(text), 'password') AS p FROM documents)))")
def text_boundaries(a: Archive) -> DataFrame:
    return a.table("documents").select("doc_id", F.md5(t.cropped(F.col("text"), "Password", "Idiot").cast("binary")).alias("h"))


@query(r"SELECT item_id, left(CASE WHEN f <> '' THEN trim(f) ELSE c END, 520) AS evidence FROM (SELECT item_id, c, regexp_extract(c, '(?i)[^.?!]{0,180}tion[^.?!]{0,240}[.?!]?', 0) AS f FROM (SELECT item_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS c FROM benchmark))")
def sentence_evidence(a: Archive) -> DataFrame:
    return a.table("benchmark").select("item_id", t.sentence_around(F.col("text"), "tion").alias("evidence"))


@query(None)
def html_visible_lines(a: Archive) -> DataFrame:
    """Visible text of pages with its lines, without tables and what frames a page."""
    from lorekeeper.functions.html import visible_lines

    return a.table("pages").select("page_id", F.md5(visible_lines(F.col("html")).cast("binary")).alias("h"))
