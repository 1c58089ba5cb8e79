"""Queries over texts, pages, addresses and coordinates."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeeper.functions import text as t
from lorekeeper.operators.ranking import first_by
from lorekeeper.registry import query
from lorekeeper.sources.archive import Archive


@query(r"SELECT doc_id, md5(trim(regexp_replace(COALESCE(text, ''), '[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+', ' ', 'g'))) AS h FROM documents")
def ws_collapse(a: Archive) -> DataFrame:
    return a.table("documents").select("doc_id", F.md5(t.collapsed(F.col("text")).cast("binary")).alias("h"))


@query(None)
def normalise_text(a: Archive) -> DataFrame:
    return a.table("documents").select("doc_id", F.md5(t.normalised(F.col("text")).cast("binary")).alias("h"))


@query("SELECT figure_id, COALESCE(NULLIF(regexp_replace(regexp_replace(lower(label || ' / ' || figure), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'item') AS slug FROM figures")
def slugify(a: Archive) -> DataFrame:
    return a.figures.select("figure_id", t.slug(F.concat_ws(" / ", "label", "figure")).alias("slug"))


@query(r"SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)), '^www\.', '') AS host, left(sha256(url), 16) AS key FROM pages")
def url_host(a: Archive) -> DataFrame:
    return a.table("pages").select("page_id", t.host(F.col("url")).alias("host"), F.left(F.sha2("url", 256), F.lit(16)).alias("key"))


@query(
    r"""WITH p AS (SELECT page_id, regexp_replace(trim(url), '#.*$', '') AS u FROM pages), q AS (SELECT page_id, u, regexp_extract(u, '^[^:]+://[^/?]*([^?]*)', 1) AS path, array_to_string([replace(url_encode(url_decode(replace(regexp_extract(x, '^([^=]*)', 1), '+', ' '))), '%20', '+') || '=' || replace(url_encode(url_decode(replace(regexp_extract(x, '=(.*)$', 1), '+', ' '))), '%20', '+') FOR x IN string_split(regexp_extract(u, '\?(.*)$', 1), '&') IF x <> '' AND lower(regexp_extract(x, '^([^=]*)', 1)) NOT IN ('utm_source','utm_medium','utm_campaign','utm_term','utm_content','fbclid','gclid','mc_cid','mc_eid')], '&') AS ps FROM p)
    SELECT page_id, lower(regexp_extract(u, '^([^:]+)://', 1)) || '://' || regexp_replace(lower(regexp_extract(u, '^[^:]+://([^/?]*)', 1)), '^www\.', '') || CASE WHEN regexp_replace(path, '/+$', '') = '' THEN path ELSE regexp_replace(path, '/+$', '') END || CASE WHEN ps <> '' THEN '?' || ps ELSE '' END AS canonical FROM q"""
)
def canonical_url(a: Archive) -> DataFrame:
    return a.table("pages").select("page_id", t.canonical_url(F.col("url")).alias("canonical"))


@query("SELECT page_id, CASE WHEN host LIKE 'm.%' THEN 'mobile' WHEN host = 'example.com' OR host LIKE '%.example.com' THEN 'open' WHEN host = 'example.org' OR host LIKE '%.example.org' THEN 'library' ELSE 'default' END AS policy FROM (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)), '^www\\.', '') AS host FROM pages)")
def domain_policy(a: Archive) -> DataFrame:
    """The first policy whose domain is the host or a parent of it; fragments come before domains."""
    rules = F.broadcast(a.spark.createDataFrame([(0, "m.", True, "mobile"), (1, "example.com", False, "open"), (2, "example.org", False, "library")], "rank int, part string, prefix boolean, policy string"))
    p = a.table("pages").select("page_id", t.host(F.col("url")).alias("host"))
    meets = F.when(F.col("prefix"), F.startswith("host", "part")).otherwise((F.col("host") == F.col("part")) | F.endswith("host", F.concat(F.lit("."), "part")))
    found = p.join(rules, meets, "left").groupBy("page_id").agg(F.min_by("policy", "rank").alias("policy"))
    return found.select("page_id", F.coalesce("policy", F.lit("default")).alias("policy"))


@query(r"SELECT doc_id, sha256(c) AS hash, left(sha256(c), 16) AS short_hash, left(sha256(c), 20) AS id_hash FROM (SELECT doc_id, lower(trim(regexp_replace(COALESCE(text, ''), '[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+', ' ', 'g'))) AS c FROM documents)")
def evidence_hash(a: Archive) -> DataFrame:
    h = t.evidence_hash(F.col("text"))
    return a.table("documents").select("doc_id", h.alias("hash"), F.left(h, F.lit(16)).alias("short_hash"), F.left(h, F.lit(20)).alias("id_hash"))


@query(r"SELECT doc_id, CASE WHEN length(c) <= 200 THEN c ELSE regexp_replace(substr(c, 1, 200), '\s\S*$', '') || '.' END AS excerpt FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS c FROM documents)")
def excerpt(a: Archive) -> DataFrame:
    return a.table("documents").select("doc_id", t.excerpt(F.col("text"), 200).alias("excerpt"))


@query("SELECT doc_id, CASE WHEN p > 0 THEN substr(text, CAST(greatest(1, p - 90) AS BIGINT), CAST(p + 4 + 90 - greatest(1, p - 90) AS BIGINT)) ELSE '' END AS context FROM (SELECT doc_id, text, instr(lower(text), 'tion') AS p FROM documents)")
def context_window(a: Archive) -> DataFrame:
    return a.table("documents").select("doc_id", t.context(F.col("text"), F.instr(F.lower("text"), "tion"), 4, 90).alias("context"))


@query("SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS block, length(line) AS chars FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents) WHERE length(trim(line)) >= 90")
def block_split(a: Archive) -> DataFrame:
    """Lines of 90 characters and more, numbered in their document."""
    kept = F.filter(F.split("text", "\n"), lambda x: F.char_length(F.trim(x)) >= 90)
    return a.table("documents").select("doc_id", F.posexplode(kept).alias("at", "line")).select("doc_id", (F.col("at") + 1).cast("long").alias("block"), F.char_length("line").cast("long").alias("chars"))


@query(r'''SELECT doc_id, regexp_extract(text, '(?i)(?:password|token)\s*[:=]\s*"?([A-Za-z0-9]+)', 1) AS value FROM documents''')
def labelled_field(a: Archive) -> DataFrame:
    return a.table("documents").select("doc_id", F.regexp_extract("text", r'(?i)(?:password|token)\s*[:=]\s*"?([A-Za-z0-9]+)', 1).alias("value"))


@query("WITH w AS (SELECT item_id, list_distinct([w FOR w IN regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[a-z0-9]+') IF w NOT IN ('a','an','and','in','of','on','the','to')]) AS l FROM benchmark) SELECT item_id, array_to_string(list_sort(l), ' ') AS tokens, len(l) AS n FROM w")
def title_tokens(a: Archive) -> DataFrame:
    """Distinct words of the benchmark's items, read as titles."""
    tokens = t.title_tokens(F.col("text"))
    return a.table("benchmark").select("item_id", F.array_join(tokens, " ").alias("tokens"), F.size(tokens).cast("long").alias("n"))


@query(
    """WITH x AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM conversations)
    SELECT a.conv_id, a.turn, round(CASE WHEN len(list_distinct(list_concat(a.w, b.w))) > 0 THEN len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) ELSE 0 END, 6) AS similarity FROM x a JOIN x b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1"""
)
def token_jaccard(a: Archive) -> DataFrame:
    """The likeness of each turn's words to the next turn's."""
    w = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9]+)"), 1))
    x = a.table("conversations").select("conv_id", "turn", w.alias("w"))
    y = x.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("next"))
    return x.join(y, ["conv_id", "turn"]).select("conv_id", "turn", F.round(t.jaccard(F.col("w"), F.col("next")), 6).alias("similarity"))


@query("SELECT location_id, CASE WHEN contains(s, 'united') THEN 'union' WHEN contains(s, 'ia') THEN 'ia_states' WHEN contains(' ' || s || ' ', ' peru ') THEN 'peru' ELSE 'other' END AS label FROM (SELECT location_id, lower(state) AS s FROM places)")
def state_from_text(a: Archive) -> DataFrame:
    s = F.lower("state")
    return a.places.select("location_id", F.when(F.contains(s, F.lit("united")), "union").when(F.contains(s, F.lit("ia")), "ia_states").when(F.contains(F.concat(F.lit(" "), s, F.lit(" ")), F.lit(" peru ")), "peru").otherwise("other").alias("label"))


@query(
    r"""SELECT page_id, md5(trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>', ' ', 'g'), '(?i)<br\s*/?>|</(p|div|li|h[1-6]|tr)>', chr(10), 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '[ \t]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10))) AS h FROM pages"""
)
def html_strip_tags(a: Archive) -> DataFrame:
    return a.table("pages").select("page_id", F.md5(t.strip_tags(F.col("html")).cast("binary")).alias("h"))


@query(r"SELECT page_id, COALESCE(NULLIF(trim(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)), ''), NULLIF(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), ''), 'untitled') AS title FROM pages")
def page_title(a: Archive) -> DataFrame:
    found = [F.nullif(F.trim(F.regexp_extract("html", rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)), F.lit("")) for tag in ("h1", "title")]
    return a.table("pages").select("page_id", F.coalesce(*found, F.lit("untitled")).alias("title"))


@query(r"SELECT page_id, length(COALESCE(NULLIF(regexp_extract(html, '(?is)<div[^>]*class=.body.[^>]*>(.*?)</div>', 1), ''), NULLIF(regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1), ''), html)) AS body_chars FROM pages")
def body_cascade(a: Archive) -> DataFrame:
    found = [F.nullif(F.regexp_extract("html", p, 1), F.lit("")) for p in (r"(?is)<div[^>]*class=.body.[^>]*>(.*?)</div>", r"(?is)<article[^>]*>(.*?)</article>")]
    return a.table("pages").select("page_id", F.char_length(F.coalesce(*found, "html")).cast("long").alias("body_chars"))


@query(r'''SELECT page_id, link, CAST(min(pos) AS INTEGER) AS pos FROM (SELECT page_id, regexp_replace(unnest(l), '[?#].*$', '') AS link, unnest(range(0, len(l))) AS pos FROM (SELECT page_id, regexp_extract_all(html, '<a\s+href="([^"]+)"', 1) AS l FROM pages)) GROUP BY 1, 2''')
def page_links(a: Archive) -> DataFrame:
    """Links of a page without query and fragment, each at its first place."""
    links = F.regexp_extract_all("html", F.lit(r'<a\s+href="([^"]+)"'), F.lit(1))
    found = a.table("pages").select("page_id", F.posexplode(links).alias("pos", "raw"))
    return found.groupBy("page_id", F.regexp_replace("raw", r"[?#].*$", "").alias("link")).agg(F.min("pos").alias("pos"))


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.absent') AS absent FROM events")
def json_field(a: Archive) -> DataFrame:
    return a.table("events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"), F.get_json_object("props", "$.absent").alias("absent"))


@query("SELECT n_regionkey AS region_id, CASE WHEN len(l) > 4 THEN array_to_string(l[1:4], '; ') || ' et al.' ELSE array_to_string(l, '; ') END AS members FROM (SELECT n_regionkey, list_sort(list(n_name)) AS l FROM nation GROUP BY 1)")
def join_et_al(a: Archive) -> DataFrame:
    members = a.table("nation").groupBy(F.col("n_regionkey").alias("region_id")).agg(F.sort_array(F.collect_list("n_name")).alias("l"))
    return members.select("region_id", F.when(F.size("l") > 4, F.concat(F.array_join(F.slice("l", 1, 4), "; "), F.lit(" et al."))).otherwise(F.array_join("l", "; ")).alias("members"))


@query("SELECT item_id, array_to_string([w FOR w IN string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' ') IF w <> ''], ' ') AS text FROM benchmark")
def inverted_index_roundtrip(a: Archive) -> DataFrame:
    """Texts taken apart into word positions and put together again from the inverted index."""
    words = F.filter(F.split(F.regexp_replace("text", r"\s+", " "), " "), lambda w: w != "")
    index = a.table("benchmark").select("item_id", F.posexplode(words).alias("at", "word")).groupBy("item_id", "word").agg(F.collect_list("at").alias("positions"))
    back = index.select("item_id", "word", F.explode("positions").alias("at")).groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
    return back.select("item_id", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("text"))


@query("SELECT figure_id, COALESCE(NULLIF(trim(regexp_replace('-- ' || label, '^[\\s[:punct:]]+', '')), ''), figure, 'Untitled') AS title FROM figures")
def display_title(a: Archive) -> DataFrame:
    clean = F.trim(F.regexp_replace(F.concat(F.lit("-- "), "label"), r"^[\s\p{P}\p{S}]+", ""))
    return a.figures.select("figure_id", F.coalesce(F.nullif(clean, F.lit("")), "figure", F.lit("Untitled")).alias("title"))


@query("SELECT doc_id, CASE WHEN toxic = 1 THEN '[summary only]' ELSE left(text, 60) END AS shown FROM documents LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) USING (doc_id)")
def mask_sensitive(a: Archive) -> DataFrame:
    flags = a.table("labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return a.table("documents").join(flags, "doc_id", "left").select("doc_id", F.when(F.col("toxic") == 1, "[summary only]").otherwise(F.left("text", F.lit(60))).alias("shown"))


@query("SELECT location_id, round(2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h)), 4) AS km, 2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h)) > 1500 AS too_far FROM (SELECT location_id, pow(sin(radians(-25.0 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(-25.0)) * pow(sin(radians(135.0 - lon) / 2), 2) AS h FROM places)")
def haversine(a: Archive) -> DataFrame:
    km = t.haversine_km(F.col("lat"), F.col("lon"), F.lit(-25.0), F.lit(135.0))
    return a.places.select("location_id", F.round(km, 4).alias("km"), (km > 1500).alias("too_far"))


@query(
    """WITH c AS (SELECT radians(-18.0) AS p1, radians(-36.0) AS p2, radians(0.0) AS p0, radians(132.0) AS l0), n AS (SELECT *, ln(cos(p1) / cos(p2)) / ln(tan(pi() / 4 + p2 / 2) / tan(pi() / 4 + p1 / 2)) AS n FROM c), f AS (SELECT *, cos(p1) * pow(tan(pi() / 4 + p1 / 2), n) / n AS f FROM n)
    SELECT location_id, round(f * pow(tan(pi() / 4 + radians(lat) / 2), -n) * sin(n * (radians(lon) - l0)), 6) AS x, round(f * pow(tan(pi() / 4 + p0 / 2), -n) - f * pow(tan(pi() / 4 + radians(lat) / 2), -n) * cos(n * (radians(lon) - l0)), 6) AS y FROM places, f"""
)
def lambert_project(a: Archive) -> DataFrame:
    """Lambert's conformal conic projection with standard parallels at 18 and 36 degrees south."""
    p1, p2, l0 = math.radians(-18), math.radians(-36), math.radians(132)
    n = math.log(math.cos(p1) / math.cos(p2)) / math.log(math.tan(math.pi / 4 + p2 / 2) / math.tan(math.pi / 4 + p1 / 2))
    f = math.cos(p1) * math.tan(math.pi / 4 + p1 / 2) ** n / n
    rho = F.lit(f) * F.pow(F.tan(math.pi / 4 + F.radians("lat") / 2), F.lit(-n))
    theta = n * (F.radians("lon") - l0)
    return a.places.select("location_id", F.round(rho * F.sin(theta), 6).alias("x"), F.round(f * math.tan(math.pi / 4) ** -n - rho * F.cos(theta), 6).alias("y"))


@query("SELECT doc_id, term FROM (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS k FROM documents JOIN (VALUES (1,'idiot'),(2,'password'),(3,'token')) v(ord, term) ON contains(lower(text), term)) WHERE k = 1")
def noise_pattern(a: Archive) -> DataFrame:
    """The first of some literal patterns, in their order, that a text holds in any case: one pass over a text for all."""
    text = F.lower("text")
    ladder = F.coalesce(*[F.when(F.contains(text, F.lit(p)), p) for p in ("idiot", "password", "token")])
    return a.table("documents").select("doc_id", ladder.alias("term")).where("term is not null")


@query(r"SELECT doc_id, alias, CASE WHEN length(alias) <= 4 THEN 'low' WHEN kind = 'noise_sensitive' THEN 'medium' ELSE 'high' END AS confidence FROM documents JOIN (VALUES ('than','plain'),('idiot','noise_sensitive'),('pathetic','plain'),('the of','plain')) v(alias, kind) ON regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])' || replace(alias, ' ', '\s+') || '($|[^\p{L}\p{N}_])')")
def alias_match(a: Archive) -> DataFrame:
    """Word-bounded aliases of a small lexicon in texts, with the confidence of each: one expression an alias, no join."""
    lexicon = [("than", "plain"), ("idiot", "noise_sensitive"), ("pathetic", "plain"), ("the of", "plain")]
    held = lambda alias: F.contains(F.lower("text"), F.lit(alias.split()[0]))  # noqa: E731  a cheap test before the pattern
    found = [F.when(held(alias) & F.col("text").rlike(r"(?i)(?<![\p{L}\p{N}_])" + alias.replace(" ", r"\s+") + r"(?![\p{L}\p{N}_])"), F.struct(F.lit(alias).alias("alias"), F.lit(confidence(alias, kind)).alias("confidence"))) for alias, kind in lexicon]
    return a.table("documents").select("doc_id", F.explode(F.array_compact(F.array(*found))).alias("m")).select("doc_id", "m.alias", "m.confidence")


def confidence(alias: str, kind: str) -> str:
    return "low" if len(alias) <= 4 else "medium" if kind in ("noise_sensitive", "historical_descriptor") else "high"


@query(None)
def html_visible_text(a: Archive) -> DataFrame:
    """Visible text of pages by an HTML parser; without an equal in SQL."""
    from lorekeeper.functions.html import visible_text

    return a.table("pages").select("page_id", F.md5(visible_text(F.col("html")).cast("binary")).alias("h"))


@query(None)
def near_dup_titles(a: Archive) -> DataFrame:
    """Like titles of one year (null equals null): copies with their class, and pairs of classes."""
    from lorekeeper.operators.similar import near_titles

    titles = a.figures.select(F.col("figure_id").alias("id"), F.concat_ws(" ", "label", "figure", "cluster").alias("title"), F.col("tier").alias("year"))
    return near_titles(titles)


@query("SELECT event_id, event_type FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def first_seen_terms(a: Archive) -> DataFrame:
    return first_by(a.table("events"), ["event_type", "user_id"], ["ts", "event_id"]).select("event_id", "event_type")
