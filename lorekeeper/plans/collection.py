"""Queries of the collection side: windows, staged dedupe, expansions and fills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lorekeeper.operators.periods import band_of
from lorekeeper.operators.ranking import spread
from lorekeeper.operators.sequential import first_by_either, term_windows
from lorekeeper.registry import query
from lorekeeper.sources.archive import BANDS, Archive


@query(None)
def overlap_windows(a: Archive) -> DataFrame:
    return term_windows(a.table("documents"), ["idiot", "password", "token"])


@query(
    """WITH RECURSIVE o AS (SELECT row_number() OVER (ORDER BY page_id) AS i, page_id, regexp_replace(url, '[?#].*$', '') AS u, length(html) AS n FROM pages),
    s(i, us, ns, page_id, k) AS (SELECT 0, CAST([] AS VARCHAR[]), CAST([] AS BIGINT[]), NULL::BIGINT, FALSE UNION ALL SELECT i, CASE WHEN k THEN list_append(us, u) ELSE us END, CASE WHEN k THEN list_append(ns, n) ELSE ns END, page_id, k FROM (SELECT o.*, us, ns, NOT list_contains(us, u) AND NOT list_contains(ns, n) AS k FROM s JOIN o ON o.i = s.i + 1))
    SELECT page_id FROM s WHERE k"""
)
def sequential_or_dedupe(a: Archive) -> DataFrame:
    """Pages kept in order of id unless an earlier kept one has their address or their length."""
    p = a.table("pages").select("page_id", F.regexp_replace("url", r"[?#].*$", "").alias("u"), F.char_length("html").alias("n"))
    return first_by_either(p, ["u"], ["n"], "page_id").select("page_id")


@query("SELECT n_name AS state, band, source_type, count(*) AS sources FROM sources JOIN nation ON n_nationkey = nation_id CROSS JOIN bands WHERE source_type <> '' AND NOT (source_type = 'BUILDING' AND band = 'b1995') GROUP BY 1, 2, 3")
def plan_support(a: Archive) -> DataFrame:
    """Terms by bands by types, with the sources that support each; pairs without support are filtered out."""
    s = a.sources.where("source_type <> ''").groupBy("nation_id", "source_type").agg(F.count("*").alias("sources"))
    named = s.join(F.broadcast(a.table("nation")), F.col("n_nationkey") == F.col("nation_id"))
    out = named.crossJoin(F.broadcast(a.bands)).where(~((F.col("source_type") == "BUILDING") & (F.col("band") == "b1995")))  # six bands
    return out.select(F.col("n_name").alias("state"), "band", "source_type", "sources")


@query("SELECT page_id, place, COALESCE(override, host) AS label FROM (SELECT page_id, regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1) AS host FROM pages) CROSS JOIN (VALUES ('north', NULL), ('south', 'south-site')) v(place, override)")
def page_places(a: Archive) -> DataFrame:
    """Each page once a configured place, the place's own fields before the page's."""
    places = F.array(F.struct(F.lit("north").alias("place"), F.lit(None).cast("string").alias("override")), F.struct(F.lit("south").alias("place"), F.lit("south-site").alias("override")))
    p = a.table("pages").select("page_id", F.regexp_extract("url", r"^[A-Za-z]+://([^/?#:]+)", 1).alias("host"), F.explode(places).alias("x"))
    return p.select("page_id", F.col("x.place").alias("place"), F.coalesce("x.override", "host").alias("label"))


@query(
    """WITH o AS (SELECT record_id, year, row_number() OVER (ORDER BY COALESCE(year, 9999), record_id) - 1 AS slot, count(*) OVER () AS n FROM public_records)
    SELECT record_id, year FROM o WHERE slot IN (SELECT CAST(round_even(i * (n - 1) / 39.0, 0) AS BIGINT) FROM (SELECT unnest(generate_series(0, 39)) AS i) CROSS JOIN (SELECT count(*) AS n FROM public_records))"""
)
def spread_select(a: Archive) -> DataFrame:
    """Forty records spread evenly over the order of years, undated ones last."""
    return spread(a.public_records.select("record_id", "year", F.coalesce("year", F.lit(9999)).alias("_year")), ["_year", "record_id"], 40).select("record_id", "year")


@query("SELECT COALESCE(band, CASE WHEN year IS NULL THEN 'undated' ELSE 'outside_scope' END) AS band, min(record_id) AS first_record, count(*) AS mapped FROM public_records LEFT JOIN bands ON year BETWEEN first_year AND last_year WHERE record_id IN (SELECT record_id FROM record_places WHERE relation = 'R') GROUP BY 1")
def mapped_by_band(a: Archive) -> DataFrame:
    mapped = a.public_records.join(a.record_places.where("relation = 'R'"), "record_id", "left_semi")
    return mapped.groupBy(band_of(F.col("year"), BANDS).alias("band")).agg(F.min("record_id").alias("first_record"), F.count("*").alias("mapped"))


@query("SELECT region, COALESCE(n, 0) AS n, ord FROM (VALUES ('ASIA', 0), ('EUROPE', 1), ('AMERICA', 2), ('AFRICA', 3)) v(region, ord) LEFT JOIN (SELECT region AS r, count(*) AS n FROM places GROUP BY 1) p ON p.r = region WHERE n > 0 ORDER BY ord")
def map_legend(a: Archive) -> DataFrame:
    order = F.broadcast(a.spark.createDataFrame([("ASIA", 0), ("EUROPE", 1), ("AMERICA", 2), ("AFRICA", 3)], "region string, ord int"))
    counts = a.places.groupBy("region").agg(F.count("*").alias("n"))
    return order.join(counts, "region").where("n > 0").select("region", "n", "ord").orderBy("ord")


@query("SELECT nation_id, source_id, n FROM (SELECT nation_id, source_id, count(*) AS n, row_number() OVER (PARTITION BY nation_id ORDER BY count(*) DESC, source_id) AS k FROM public_records JOIN sources USING (source_id) GROUP BY 1, 2) WHERE k <= 3")
def console_counts(a: Archive) -> DataFrame:
    n = a.public_records.groupBy("source_id").agg(F.count("*").alias("n")).join(a.sources.select("source_id", "nation_id"), "source_id")
    w = W.partitionBy("nation_id").orderBy(F.desc("n"), "source_id")
    return n.withColumn("k", F.row_number().over(w)).where("k <= 3").select("nation_id", "source_id", "n")


@query("SELECT f.record_id, p.location_id FROM (SELECT record_id, min(location_id) AS location_id FROM record_places WHERE relation = 'R' GROUP BY 1) f JOIN places p USING (location_id) JOIN public_records r ON r.record_id = f.record_id")
def mobile_flags(a: Archive) -> DataFrame:
    """Flags with their record: unmatched ones drop out."""
    f = a.record_places.where("relation = 'R'").groupBy("record_id").agg(F.min("location_id").alias("location_id"))
    return f.join(a.places.select("location_id"), "location_id").join(a.public_records.select("record_id"), "record_id").select("record_id", "location_id")


@query("SELECT f.record_id, f.location_id, COALESCE(CAST(year AS VARCHAR), 'undated') AS year_label FROM (SELECT record_id, min(location_id) AS location_id FROM record_places WHERE relation = 'R' GROUP BY 1) f LEFT JOIN public_records r USING (record_id)")
def map_flags(a: Archive) -> DataFrame:
    """Flags once a record, with fallbacks where the record isn't public."""
    f = a.record_places.where("relation = 'R'").groupBy("record_id").agg(F.min("location_id").alias("location_id"))
    return f.join(a.public_records.select("record_id", "year"), "record_id", "left").select("record_id", "location_id", F.coalesce(F.col("year").cast("string"), F.lit("undated")).alias("year_label"))


@query("SELECT source_id, CASE WHEN y1 IS NULL THEN 'unspecified' ELSE COALESCE(band, CAST(y1 AS VARCHAR) || '-' || CAST(y2 AS VARCHAR)) END AS band FROM (SELECT source_id, min(year) AS y1, max(year) AS y2 FROM records GROUP BY 1) LEFT JOIN bands ON first_year = y1 AND last_year = y2")
def query_band(a: Archive) -> DataFrame:
    """The band whose bounds a span has exactly, else the span itself."""
    spans = a.records.groupBy("source_id").agg(F.min("year").alias("y1"), F.max("year").alias("y2"))
    j = spans.join(F.broadcast(a.bands), (F.col("first_year") == F.col("y1")) & (F.col("last_year") == F.col("y2")), "left")
    return j.select("source_id", F.when(F.col("y1").isNull(), "unspecified").otherwise(F.coalesce("band", F.concat_ws("-", F.col("y1").cast("string"), F.col("y2").cast("string")))).alias("band"))


@query("SELECT min(year) AS first_year, max(year) AS last_year, count(DISTINCT year) AS years FROM public_records")
def band_bounds(a: Archive) -> DataFrame:
    return a.public_records.agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.countDistinct("year").alias("years"))


@query("SELECT s_suppkey AS location_id, url_like FROM (SELECT s_suppkey, 'https://example.org/search?q=' || replace(n_name, ' ', '+') AS url_like FROM supplier JOIN nation ON n_nationkey = s_nationkey)")
def query_urls(a: Archive) -> DataFrame:
    return a.places.select("location_id", F.concat(F.lit("https://example.org/search?q="), F.url_encode("state")).alias("url_like"))
