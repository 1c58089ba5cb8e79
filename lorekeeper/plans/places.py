"""Queries on places in texts: mentions as words, precedence of a gazetteer, and evidence near terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeeper.operators import gazetteer as g
from lorekeeper.operators.nearness import evidence_windows
from lorekeeper.registry import query
from lorekeeper.sources.archive import Archive

_FLAT = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
#: The benchmark's items as places: an item's own text, its first two words, and its last word with what closes it.
_CATALOGUE_SQL = f"""c AS MATERIALIZED (SELECT *, max(length(alias)) OVER (PARTITION BY place) AS longest, replace(regexp_escape(alias), '\\ ', '\\s+') AS form FROM (
    SELECT item_id AS place, item_id AS place_order, unnest([t, array_to_string(string_split(t, ' ')[1:2], ' '), string_split(t, ' ')[-1]]) AS alias, unnest([1, 2, 3]) AS alias_order FROM (SELECT item_id, {_FLAT.format('text')} AS t FROM benchmark)))"""
_EDGE = r"[^\p{L}\p{N}_]"
#: Every alias in every text, as words: letters before its first mention, and the letters of the mention. What contains it is tried first.
_FLAT_DOCS = rf"f AS MATERIALIZED (SELECT doc_id, text, lower({_FLAT.format('text')}) AS f FROM documents)"
_MENTIONS_SQL = rf"""{_FLAT_DOCS}, h AS MATERIALIZED (SELECT doc_id, text, c.* FROM f JOIN c ON contains(f.f, lower(c.alias))),
    o AS MATERIALIZED (SELECT *, '(?is)^(|.*?{_EDGE})(' || form || ')(?:{_EDGE}|$)' AS p FROM h), m AS MATERIALIZED (SELECT * EXCLUDE p, length(regexp_extract(text, p, 1)) AS s, length(regexp_extract(text, p, 1)) + length(regexp_extract(text, p, 2)) AS e FROM o WHERE regexp_matches(text, p))"""


def _catalogue(a: Archive) -> DataFrame:
    items = a.table("benchmark").select("item_id", F.trim(F.regexp_replace("text", r"\s+", " ")).alias("t"))
    words = F.split("t", " ")
    aliases = F.array("t", F.array_join(F.slice(words, 1, 2), " "), F.element_at(words, -1))
    return items.select(F.col("item_id").alias("place"), F.col("item_id").alias("place_order"), F.posexplode(aliases).alias("at", "alias")).select("place", "place_order", "alias", (F.col("at") + 1).alias("alias_order"))


@query(
    rf"""WITH n AS MATERIALIZED (SELECT item_id, alias, '(?is)^(|.*?{_EDGE})' || replace(regexp_escape(alias), '\ ', '\s+') || '(?:{_EDGE}|$)' AS p FROM (SELECT item_id, {_FLAT.format('text')} AS alias FROM benchmark)),
    {_FLAT_DOCS}, h AS MATERIALIZED (SELECT doc_id, text, item_id, p FROM f JOIN n ON contains(f.f, lower(n.alias)))
    SELECT doc_id, item_id, CAST(length(regexp_extract(text, p, 1)) + 1 AS INTEGER) AS p FROM h WHERE regexp_matches(text, p)"""
)
def gazetteer_match(a: Archive) -> DataFrame:
    """Names of any length in texts, as words: the place of each one's first mention."""
    names = a.table("benchmark").select("item_id", F.col("text").alias("name"))
    return g.first_mentions(a.table("documents"), names).select("doc_id", "item_id", (F.col("start") + 1).cast("int").alias("p"))


@query(
    rf"""WITH {_CATALOGUE_SQL}, {_MENTIONS_SQL}, b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY doc_id, place ORDER BY alias_order, s) = 1)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY longest DESC, place_order, place) AS INTEGER) AS rank, place, alias, s AS start, e AS "end", {_FLAT.format('substr(text, CAST(greatest(0, s - 90) + 1 AS BIGINT), CAST(e + 90 - greatest(0, s - 90) AS BIGINT))')} AS evidence FROM b"""
)
def places_named(a: Archive) -> DataFrame:
    """Every place that a text names, once, by the first of its aliases that the text holds; longest names first."""
    return g.places_named(a.table("documents"), _catalogue(a))


@query(
    rf"""WITH {_CATALOGUE_SQL}, {_MENTIONS_SQL}, b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY doc_id, place ORDER BY alias_order, s) = 1),
    w AS (SELECT *, {_FLAT.format('substr(text, CAST(greatest(0, s - 360) + 1 AS BIGINT), CAST(e + 360 - greatest(0, s - 360) AS BIGINT))')} AS evidence FROM b)
    SELECT doc_id, place, alias, evidence FROM w WHERE regexp_matches(evidence, '(?i)password|idiot|license|@') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY place_order, place) = 1"""
)
def catalogue_place(a: Archive) -> DataFrame:
    """The first place of the catalogue that a text names near certain words."""
    return g.first_place(a.table("documents"), _catalogue(a), F.col("evidence").rlike("(?i)password|idiot|license|@"))


#: Configured places with their aliases, in order, and terms.
PLACES, TERMS, RADIUS = [("north", ["nowhere at all", "the"]), ("south", ["und"]), ("west", ["dans", "el"])], "password|idiot|token", 120
_PLACES_SQL = "(VALUES ('north', 1, 'nowhere at all'), ('north', 2, 'the'), ('south', 1, 'und'), ('west', 1, 'dans'), ('west', 2, 'el')) v(place, alias_order, alias)"
_CLIP = "CASE WHEN length({0}) <= {1} THEN {0} ELSE regexp_replace(left({0}, {1} - 1), ' [^ ]*$', '') || '.' END"
_NEAR_SQL = rf"""d AS MATERIALIZED (SELECT doc_id, {_FLAT.format('text')} AS text FROM documents WHERE {_FLAT.format('text')} <> ''),
    p AS (SELECT doc_id, place, alias, text, length(regexp_extract(text, '(?is)^(|.*?{_EDGE})' || alias || '(?:{_EDGE}|$)', 1)) AS spot FROM d JOIN {_PLACES_SQL} ON regexp_matches(text, '(?i)(?:^|{_EDGE})' || alias || '(?:{_EDGE}|$)') QUALIFY row_number() OVER (PARTITION BY doc_id, place ORDER BY alias_order) = 1),
    t AS (SELECT doc_id, unnest(ms) AS x, unnest([list_sum([length(g) FOR g IN gaps[1:i]]) + COALESCE(list_sum([length(y) FOR y IN ms[1:i - 1]]), 0) FOR i IN range(1, len(ms) + 1)]) AS s FROM (SELECT doc_id, regexp_extract_all(text, '(?i){TERMS}') AS ms, string_split_regex(text, '(?i){TERMS}') AS gaps FROM d) WHERE len(ms) > 0)"""


@query(
    rf"""WITH {_NEAR_SQL}, j AS (SELECT p.*, s, length(x) AS n, abs(s - spot) AS distance FROM p LEFT JOIN t USING (doc_id) QUALIFY row_number() OVER (PARTITION BY doc_id, place ORDER BY abs(s - spot), s) = 1),
    w AS (SELECT *, COALESCE(distance <= 2 * {RADIUS}, FALSE) AS paired, CAST(greatest(0, CASE WHEN distance <= 2 * {RADIUS} THEN least(spot, s) ELSE spot END - {RADIUS}) AS BIGINT) AS lo, CAST(least(length(text), CASE WHEN distance <= 2 * {RADIUS} THEN greatest(spot + length(alias), s + n) ELSE spot + length(alias) END + {RADIUS}) AS BIGINT) AS hi FROM j),
    e AS (SELECT *, trim(substr(text, lo + 1, hi - lo)) AS evidence FROM w)
    SELECT doc_id, place, alias, lo AS start, hi AS "end", CAST(distance AS BIGINT) AS distance, paired, {_CLIP.format('evidence', 900)} AS evidence FROM e UNION ALL
    SELECT doc_id, NULL, NULL, 0, length(text), NULL, FALSE, {_CLIP.format('text', 760)} FROM d WHERE doc_id NOT IN (SELECT doc_id FROM p)"""
)
def nearest_evidence(a: Archive) -> DataFrame:
    """Configured places of every text with the nearest of some terms, and what surrounds both."""
    return evidence_windows(a.table("documents"), PLACES, TERMS, RADIUS)


@query(
    rf"""WITH {_NEAR_SQL}, j AS (SELECT p.*, s, length(x) AS n, abs(s - spot) AS distance FROM p LEFT JOIN t USING (doc_id) QUALIFY row_number() OVER (PARTITION BY doc_id, place ORDER BY s) = 1),
    w AS (SELECT *, s IS NOT NULL AS paired, CAST(greatest(0, least(spot, COALESCE(s, spot)) - {RADIUS}) AS BIGINT) AS lo, CAST(least(length(text), greatest(spot + length(alias), COALESCE(s + n, 0)) + {RADIUS}) AS BIGINT) AS hi FROM j),
    e AS (SELECT *, trim(substr(text, lo + 1, hi - lo)) AS evidence FROM w)
    SELECT doc_id, place, alias, lo AS start, hi AS "end", CAST(distance AS BIGINT) AS distance, paired, {_CLIP.format('evidence', 760)} AS evidence FROM e UNION ALL
    SELECT doc_id, NULL, NULL, 0, length(text), NULL, FALSE, {_CLIP.format('text', 760)} FROM d WHERE doc_id NOT IN (SELECT doc_id FROM p)"""
)
def spanning_evidence(a: Archive) -> DataFrame:
    """Configured places of every text with the first of some terms, however far, in a clipped excerpt."""
    return evidence_windows(a.table("documents"), PLACES, TERMS, RADIUS, nearest=False)
