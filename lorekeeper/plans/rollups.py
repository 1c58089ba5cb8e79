"""Counts, shares and rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lorekeeper.operators.periods import share
from lorekeeper.operators.ranking import first_by, top_label
from lorekeeper.plans.core import truthy
from lorekeeper.registry import query
from lorekeeper.sources.archive import BANDS, Archive
from lorekeeper.operators.periods import band_of

def all_rows():
    """The window over all rows: used on small aggregates only."""
    return W.partitionBy()


def label_counts(df: DataFrame, label, name: str = "label") -> DataFrame:
    return df.groupBy(label.alias(name)).agg(F.count("*").alias("n"))


@query("SELECT (SELECT count(*) FROM records) AS records, (SELECT count(*) FROM public_records) AS public_records, (SELECT count(*) FROM sources) AS sources")
def scalar_counts(a: Archive) -> DataFrame:
    one = lambda df, n: df.agg(F.count("*").alias(n))
    return one(a.records, "records").crossJoin(one(a.public_records, "public_records")).crossJoin(one(a.sources, "sources"))  # of single rows


@query("SELECT COALESCE(relevance, 'uncoded') AS label, count(*) AS n FROM records GROUP BY 1 ORDER BY n DESC, label")
def count_by_label(a: Archive) -> DataFrame:
    return label_counts(a.records, F.coalesce("relevance", F.lit("uncoded"))).orderBy(F.desc("n"), "label")


@query("SELECT COALESCE(NULLIF(code,''), relevance, 'untyped') AS label, count(*) AS n FROM records GROUP BY 1")
def count_by_type_fallback(a: Archive) -> DataFrame:
    return label_counts(a.records, F.coalesce(F.nullif("code", F.lit("")), "relevance", F.lit("untyped")))


@query("SELECT state, count(DISTINCT record_id) AS records, count(DISTINCT figure_id) AS figures FROM record_places JOIN places USING (location_id) GROUP BY state")
def distinct_per_state(a: Archive) -> DataFrame:
    return a.record_places.join(a.places, "location_id").groupBy("state").agg(F.countDistinct("record_id").alias("records"), F.countDistinct("figure_id").alias("figures"))


@query("SELECT CASE WHEN code IS NULL THEN 'null' WHEN trim(code) = '' THEN 'blank' ELSE code END AS label, CASE WHEN code IS NULL THEN 2 WHEN trim(code) = '' THEN 1 ELSE 0 END AS ord, count(*) AS n FROM (SELECT CASE WHEN record_id % 13 = 0 THEN NULL ELSE code END AS code FROM records) GROUP BY 1, 2 ORDER BY 2, 1")
def state_null_blank_split(a: Archive) -> DataFrame:
    c = F.col("code")
    r = a.records.select(F.when(F.col("record_id") % 13 != 0, c).alias("code"))
    kind = F.when(c.isNull(), "null").when(F.trim(c) == "", "blank").otherwise(c)
    ord_ = F.when(c.isNull(), 2).when(F.trim(c) == "", 1).otherwise(0)
    return r.groupBy(kind.alias("label"), ord_.alias("ord")).agg(F.count("*").alias("n")).orderBy("ord", "label")


@query("SELECT count(*) AS groups, CAST(COALESCE(sum(n), 0) AS BIGINT) AS rows FROM (SELECT count(*) AS n FROM record_places GROUP BY record_id, priority HAVING count(*) > 1)")
def having_dups(a: Archive) -> DataFrame:
    return a.record_places.groupBy("record_id", "priority").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


@query("SELECT basis, count(*) AS groups FROM (SELECT 'url' AS basis FROM pages GROUP BY regexp_replace(url, '[?#].*$', '') HAVING count(*) > 1 UNION ALL SELECT 'text' AS basis FROM documents GROUP BY md5(text) HAVING count(*) > 1) GROUP BY basis")
def union_all_dups(a: Archive) -> DataFrame:
    dup = lambda df, key, basis: df.groupBy(key.alias("k")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(basis).alias("basis"))
    both = dup(a.table("pages"), F.regexp_replace("url", r"[?#].*$", ""), "url").unionAll(dup(a.table("documents"), F.md5(F.col("text").cast("binary")), "text"))
    return both.groupBy("basis").agg(F.count("*").alias("groups"))


@query("SELECT source_id, min(year) AS earliest, max(year) AS latest, count(record_id) AS records, max(date_text) AS updated FROM sources LEFT JOIN public_records USING (source_id) GROUP BY source_id")
def entity_span_summary(a: Archive) -> DataFrame:
    return a.sources.select("source_id").join(a.public_records, "source_id", "left").groupBy("source_id").agg(F.min("year").alias("earliest"), F.max("year").alias("latest"), F.count("record_id").alias("records"), F.max("date_text").alias("updated"))


@query("SELECT location_id, place_name, count(*) AS uses, min(record_id) AS sample_record FROM record_places JOIN places USING (location_id) WHERE lat > -20 AND trim(evidence) <> '' GROUP BY 1, 2")
def geocode_queue(a: Archive) -> DataFrame:
    waiting = a.record_places.where("trim(evidence) <> ''").groupBy("location_id").agg(F.count("*").alias("uses"), F.min("record_id").alias("sample_record"))
    return waiting.join(a.places.where("lat > -20"), "location_id").select("location_id", "place_name", "uses", "sample_record")


@query("SELECT level, code, relevance, year, count(*) AS n FROM records GROUP BY ALL")
def group_by_four(a: Archive) -> DataFrame:
    return a.records.groupBy("level", "code", "relevance", "year").agg(F.count("*").alias("n"))


@query("SELECT COALESCE(NULLIF(code,''), NULLIF(level,''), 'unknown') AS label, count(*) AS n FROM records GROUP BY 1")
def counter_fallback(a: Archive) -> DataFrame:
    return label_counts(a.records, truthy("code", "level"))


@query("SELECT state, count(DISTINCT record_id) AS records, arg_min(record_id, (COALESCE(year, 9999), record_id)) AS representative FROM record_places JOIN places USING (location_id) JOIN public_records USING (record_id) GROUP BY state")
def state_clusters(a: Archive) -> DataFrame:
    joined = a.record_places.select("record_id", "location_id").join(a.places.select("location_id", "state"), "location_id").join(a.public_records.select("record_id", "year"), "record_id")
    seen = joined.select("state", "record_id", "year").distinct()
    return seen.groupBy("state").agg(F.count("*").alias("records"), F.min_by("record_id", F.struct(F.coalesce("year", F.lit(9999)), "record_id")).alias("representative"))


@query("SELECT COALESCE(r.t, q.t) AS source_type, COALESCE(r.n, 0) AS record_count, COALESCE(q.n, 0) AS query_count FROM (SELECT source_type AS t, count(*) AS n FROM public_records JOIN sources USING (source_id) GROUP BY 1) r FULL JOIN (SELECT event_type AS t, count(*) AS n FROM events GROUP BY 1) q ON r.t = q.t")
def source_rollup(a: Archive) -> DataFrame:
    """Two counts by type from two tables, in one shuffle: rows tagged, united and summed."""
    r = a.public_records.join(a.sources, "source_id").select(F.col("source_type").alias("t"), F.lit(1).alias("r"), F.lit(0).alias("q"))
    q = a.table("events").select(F.col("event_type").alias("t"), F.lit(0).alias("r"), F.lit(1).alias("q"))
    return r.unionAll(q).groupBy(F.col("t").alias("source_type")).agg(F.sum("r").alias("record_count"), F.sum("q").alias("query_count"))


@query("SELECT figure, count(*) AS records, min(year) AS earliest, max(year) AS latest FROM (SELECT DISTINCT record_id, figure_id FROM record_places) JOIN figures USING (figure_id) JOIN public_records USING (record_id) GROUP BY figure")
def figure_rollup(a: Archive) -> DataFrame:
    pairs = a.record_places.select("record_id", "figure_id").distinct()
    return pairs.join(a.figures.select("figure_id", "figure"), "figure_id").join(a.public_records.select("record_id", "year"), "record_id").groupBy("figure").agg(F.count("*").alias("records"), F.min("year").alias("earliest"), F.max("year").alias("latest"))


@query("SELECT CASE best WHEN 3 THEN 'high' WHEN 2 THEN 'medium' WHEN 1 THEN 'low' ELSE 'unknown' END AS best_confidence, count(*) AS records FROM (SELECT record_id, max(CASE relation WHEN 'R' THEN 3 WHEN 'A' THEN 2 WHEN 'N' THEN 1 END) AS best FROM records LEFT JOIN record_places USING (record_id) GROUP BY record_id) GROUP BY 1")
def best_confidence(a: Archive) -> DataFrame:
    rank = F.when(F.col("relation") == "R", 3).when(F.col("relation") == "A", 2).when(F.col("relation") == "N", 1)
    best = a.record_places.groupBy("record_id").agg(F.max(rank).alias("best"))
    named = F.when(F.col("best") == 3, "high").when(F.col("best") == 2, "medium").when(F.col("best") == 1, "low").otherwise("unknown")
    return a.records.select("record_id").join(best, "record_id", "left").groupBy(named.alias("best_confidence")).agg(F.count("*").alias("records"))


@query("SELECT source_type, n, round(100.0 * n / sum(n) OVER (), 1) AS pct FROM (SELECT source_type, count(*) AS n FROM public_records JOIN sources USING (source_id) GROUP BY 1)")
def pct_share(a: Archive) -> DataFrame:
    counted = a.public_records.join(a.sources, "source_id").groupBy("source_type").agg(F.count("*").alias("n"))
    return counted.select("source_type", "n", F.round(100.0 * F.col("n") / F.sum("n").over(all_rows()), 1).alias("pct"))


@query("SELECT dim, value, count(*) AS n FROM (SELECT unnest(['level','code','relevance','year']) AS dim, unnest([COALESCE(level,'none'), COALESCE(code,'none'), COALESCE(relevance,'none'), COALESCE(CAST(year AS VARCHAR),'none')]) AS value FROM records) GROUP BY 1, 2")
def multi_counter(a: Archive) -> DataFrame:
    """Several counters in one scan and one shuffle: columns unpivoted, then counted."""
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(c)
    dims = ["level", "code", "relevance", "year"]
    return a.records.select(*map(none, dims)).unpivot([], dims, "dim", "value").groupBy("dim", "value").agg(F.count("*").alias("n"))


@query(
    """WITH c AS (SELECT n_name AS state, (n_nationkey + 3) * 100000 AS population, count(record_id) AS n FROM nation LEFT JOIN sources ON nation_id = n_nationkey LEFT JOIN public_records USING (source_id) GROUP BY 1, 2)
    SELECT state, n, round(n * 1e6 / population, 4) AS per_million, CAST(round_even(20000.0 * population / sum(population) OVER (), 0) AS BIGINT) AS target, greatest(0, CAST(round_even(20000.0 * population / sum(population) OVER (), 0) AS BIGINT) - n) AS gap FROM c"""
)
def population_gap(a: Archive) -> DataFrame:
    """Counts against targets in proportion to population; halves round to even."""
    states = a.table("nation").select(F.col("n_name").alias("state"), F.col("n_nationkey").alias("nation_id"), ((F.col("n_nationkey") + 3) * 100000).cast("long").alias("population"))
    n = a.public_records.select("source_id").join(a.sources.select("source_id", "nation_id"), "source_id").groupBy("nation_id").agg(F.count("*").alias("n"))
    c = states.join(n, "nation_id", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    target = F.bround(20000.0 * F.col("population") / F.sum("population").over(all_rows()), 0).cast("long")
    return c.select("state", "n", F.round(F.col("n") * 1e6 / F.col("population"), 4).alias("per_million"), target.alias("target"), F.greatest(F.lit(0), target - F.col("n")).cast("long").alias("gap"))


@query("SELECT source_name, count(*) AS n FROM public_records JOIN sources USING (source_id) GROUP BY 1 ORDER BY n DESC, source_name LIMIT 40")
def top_n_sources(a: Archive) -> DataFrame:
    return a.public_records.join(a.sources, "source_id").groupBy("source_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source_name").limit(40)


@query("SELECT source_type, count(*) AS sources, CAST(sum(n) AS BIGINT) AS records, max(n) AS largest, round(max(n) / sum(n), 6) AS largest_share, round(sum(n) / (SELECT count(*) FROM public_records), 6) AS share FROM (SELECT source_id, source_type, count(*) AS n FROM public_records JOIN sources USING (source_id) GROUP BY 1, 2) GROUP BY source_type")
def source_concentration(a: Archive) -> DataFrame:
    by_source = a.public_records.join(a.sources, "source_id").groupBy("source_id", "source_type").agg(F.count("*").alias("n"))
    out = by_source.groupBy("source_type").agg(F.count("*").alias("sources"), F.sum("n").alias("records"), F.max("n").alias("largest"))
    return out.select("source_type", "sources", "records", "largest", F.round(F.col("largest") / F.col("records"), 6).alias("largest_share"), F.round(F.col("records") / F.sum("records").over(all_rows()), 6).alias("share"))


@query(
    """SELECT source_id, min(year) AS first_year, max(year) AS last_year, COALESCE(array_to_string(list_sort(list(DISTINCT NULLIF(code, '')) FILTER (NULLIF(code, '') IS NOT NULL))[1:20], '; '), '') AS labels, count(*) AS records, count(*) > 0.002 * (SELECT count(*) FROM public_records) AS heavy FROM public_records GROUP BY source_id"""
)
def source_audit(a: Archive) -> DataFrame:
    total = a.public_records.agg(F.count("*").alias("total"))
    out = a.public_records.groupBy("source_id").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.array_join(F.slice(F.sort_array(F.collect_set(F.nullif("code", F.lit("")))), 1, 20), "; ").alias("labels"), F.count("*").alias("records"))
    return out.join(F.broadcast(total)).select("source_id", "first_year", "last_year", "labels", "records", (F.col("records") > 0.002 * F.col("total")).alias("heavy"))  # one row is broadcast


@query(
    """WITH g AS (SELECT source, count(*) AS n, avg(length(text)) AS len FROM documents GROUP BY 1), l AS (SELECT source, max(n) AS top FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY 1),
    h AS (SELECT source, sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS rep FROM (SELECT source, md5(text) AS h, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY 1)
    SELECT source, g.n AS items, round(top / g.n, 6) AS top_share, round(100.0 * rep / g.n, 4) AS repeated_pct, round(len, 4) AS avg_length, CASE WHEN rep > 0.1 * g.n THEN 'repeated' ELSE '' END AS warning FROM g JOIN l USING (source) JOIN h USING (source)"""
)
def section_split_audit(a: Archive) -> DataFrame:
    d = a.table("documents").select("source", "lang", F.md5(F.col("text").cast("binary")).alias("h"), F.char_length("text").alias("len"))
    one = d.groupBy("source").agg(F.count("*").alias("items"), F.avg("len").alias("len"))
    top = d.groupBy("source", "lang").agg(F.count("*").alias("n")).groupBy("source").agg(F.max("n").alias("top"))
    repeated = d.groupBy("source", "h").agg(F.count("*").alias("n")).groupBy("source").agg(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("rep"))
    j = one.join(top, "source").join(repeated, "source")
    return j.select("source", "items", F.round(F.col("top") / F.col("items"), 6).alias("top_share"), F.round(100.0 * F.col("rep") / F.col("items"), 4).alias("repeated_pct"), F.round("len", 4).alias("avg_length"), F.when(F.col("rep") > 0.1 * F.col("items"), "repeated").otherwise("").alias("warning"))


@query("SELECT regions, count(*) AS records FROM (SELECT record_id, array_to_string(list_sort(list(DISTINCT region)), '/') AS regions FROM record_places JOIN places USING (location_id) GROUP BY 1) GROUP BY 1")
def state_combo_counts(a: Archive) -> DataFrame:
    sets = a.record_places.select("record_id", "location_id").join(a.places.select("location_id", "region"), "location_id").groupBy("record_id").agg(F.array_join(F.sort_array(F.collect_set("region")), "/").alias("regions"))
    return sets.groupBy("regions").agg(F.count("*").alias("records"))


@query("SELECT c_custkey AS route_id, count(o_orderkey) AS processed, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS accepted, CASE WHEN count(o_orderkey) > 0 THEN round_even(CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS DOUBLE) / count(o_orderkey), 4) ELSE 0.0 END AS acceptance_rate FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def acceptance_rate(a: Archive) -> DataFrame:
    o = a.table("orders").groupBy("o_custkey").agg(F.count("*").alias("processed"), F.count_if(F.col("o_orderstatus") == "F").alias("accepted"))
    j = a.table("customer").select(F.col("c_custkey").alias("route_id")).join(o, F.col("o_custkey") == F.col("route_id"), "left").na.fill(0, ["processed", "accepted"])
    return j.select("route_id", "processed", "accepted", F.bround(share(F.col("accepted"), F.col("processed")), 4).alias("acceptance_rate"))


@query("SELECT CAST(count_if(level IS NULL) AS BIGINT) AS unlevelled, CAST(count_if(code = '') AS BIGINT) AS blank_code, CAST(sum(CASE WHEN relevance = 'scope_excluded' OR level = 'restricted_excluded' THEN 1 ELSE 0 END) AS BIGINT) AS withheld, CAST(count_if(year IS NOT NULL) AS BIGINT) AS dated FROM records")
def conditional_counts(a: Archive) -> DataFrame:
    withheld = (F.col("relevance") == "scope_excluded") | (F.col("level") == "restricted_excluded")
    return a.records.agg(F.count_if(F.col("level").isNull()).alias("unlevelled"), F.count_if(F.col("code") == "").alias("blank_code"), F.count_if(withheld).alias("withheld"), F.count_if(F.col("year").isNotNull()).alias("dated"))


@query("SELECT year, count(*) AS total, CAST(count_if(m.record_id IS NOT NULL) AS BIGINT) AS mapped FROM public_records LEFT JOIN (SELECT DISTINCT record_id FROM record_places WHERE relation = 'R') m USING (record_id) WHERE year IS NOT NULL GROUP BY year")
def annual_series(a: Archive) -> DataFrame:
    mapped = a.record_places.where("relation = 'R'").select("record_id").distinct().withColumn("m", F.lit(1))
    return a.public_records.where("year is not null").join(mapped, "record_id", "left").groupBy("year").agg(F.count("*").alias("total"), F.count("m").alias("mapped"))


@query("SELECT event_type, min(n) AS low, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.75) AS q3, max(n) AS high FROM (SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def period_boxplot(a: Archive) -> DataFrame:
    daily = a.table("events").groupBy("event_type", F.to_date("ts").alias("d")).agg(F.count("*").alias("n"))
    q = lambda x: F.percentile("n", F.lit(x))
    return daily.groupBy("event_type").agg(F.min("n").alias("low"), q(0.25).alias("q1"), q(0.5).alias("median"), q(0.75).alias("q3"), F.max("n").alias("high"))


@query(
    """WITH p AS (SELECT DISTINCT figure, record_id FROM record_places JOIN figures USING (figure_id) JOIN public_records USING (record_id)), s AS (SELECT figure, record_id, source_type, year, region FROM p JOIN public_records USING (record_id) JOIN sources USING (source_id) JOIN nation ON n_nationkey = nation_id JOIN region ON r_regionkey = n_regionkey JOIN (SELECT r_regionkey rk, r_name AS region FROM region) x ON x.rk = n_regionkey),
    t AS (SELECT figure, source_type, row_number() OVER (PARTITION BY figure ORDER BY count(*) DESC, source_type) AS k FROM s GROUP BY 1, 2), r AS (SELECT figure, region, row_number() OVER (PARTITION BY figure ORDER BY count(*) DESC, region) AS k FROM s GROUP BY 1, 2)
    SELECT figure, count(*) AS records, max(year) - min(year) AS span, any_value(t.source_type) AS top_source_type, any_value(r.region) AS top_region FROM s JOIN (SELECT * FROM t WHERE k = 1) t USING (figure) JOIN (SELECT * FROM r WHERE k = 1) r USING (figure) GROUP BY figure"""
)
def figure_density(a: Archive) -> DataFrame:
    pairs = a.record_places.select("record_id", "figure_id").join(a.figures.select("figure_id", "figure"), "figure_id").select("figure", "record_id").distinct()
    nation = a.table("nation").join(F.broadcast(a.table("region")), F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("n_nationkey").alias("nation_id"), F.col("r_name").alias("region"))
    s = pairs.join(a.public_records.select("record_id", "source_id", "year"), "record_id").join(a.sources, "source_id").join(F.broadcast(nation), "nation_id")
    counts = s.groupBy("figure").agg(F.count("*").alias("records"), (F.max("year") - F.min("year")).alias("span"))
    return counts.join(top_label(s, "figure", "source_type"), "figure").join(top_label(s, "figure", "region"), "figure")


@query("SELECT source_type, count(*) AS total, CAST(count_if(level = 'public_page') AS BIGINT) AS mapped FROM public_records JOIN sources USING (source_id) GROUP BY 1 ORDER BY total DESC, source_type LIMIT 8")
def source_composition(a: Archive) -> DataFrame:
    return a.public_records.join(a.sources, "source_id").groupBy("source_type").agg(F.count("*").alias("total"), F.count_if(F.col("level") == "public_page").alias("mapped")).orderBy(F.desc("total"), "source_type").limit(8)


@query("SELECT region, CAST(sum(t) AS BIGINT) AS total, CAST(sum(m) AS BIGINT) AS mapped FROM (SELECT r_name AS region, 1 AS t, 0 AS m FROM public_records JOIN sources USING (source_id) JOIN nation ON n_nationkey = nation_id JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT region, 0, 1 FROM record_places JOIN places USING (location_id) WHERE relation = 'R') GROUP BY region")
def region_concentration(a: Archive) -> DataFrame:
    nation = F.broadcast(a.table("nation").join(F.broadcast(a.table("region")), F.col("r_regionkey") == F.col("n_regionkey")))
    t = a.public_records.join(a.sources, "source_id").join(nation, F.col("n_nationkey") == F.col("nation_id")).select(F.col("r_name").alias("region"), F.lit(1).alias("t"), F.lit(0).alias("m"))
    m = a.record_places.where("relation = 'R'").join(a.places, "location_id").select("region", F.lit(0).alias("t"), F.lit(1).alias("m"))
    return t.unionAll(m).groupBy("region").agg(F.sum("t").alias("total"), F.sum("m").alias("mapped"))


def zero_filled(counts: DataFrame, rows: DataFrame, columns: DataFrame, keys: list[str]) -> DataFrame:
    """Every pair of two small label lists with its count, 0 where there is none."""
    grid = rows.crossJoin(F.broadcast(columns))
    return grid.join(counts, keys, "left").na.fill(0, ["n"])


@query(
    """WITH f AS (SELECT figure, COALESCE(band, CASE WHEN year IS NULL THEN 'undated' ELSE 'outside_scope' END) AS band FROM (SELECT DISTINCT figure, record_id FROM record_places JOIN figures USING (figure_id)) JOIN public_records USING (record_id) LEFT JOIN bands ON year BETWEEN first_year AND last_year),
    top AS (SELECT figure FROM f GROUP BY 1 ORDER BY count(*) DESC, figure LIMIT 7)
    SELECT figure, band, count(f2.figure) AS n FROM top CROSS JOIN bands LEFT JOIN (SELECT figure AS f2fig, band AS b2, figure FROM f) f2 ON f2.f2fig = top.figure AND f2.b2 = bands.band GROUP BY top.figure, bands.band"""
    .replace("SELECT figure, band, count(f2.figure)", "SELECT top.figure, bands.band, count(f2.figure)")
)
def figure_period_matrix(a: Archive) -> DataFrame:
    pairs = a.record_places.select("record_id", "figure_id").join(a.figures.select("figure_id", "figure"), "figure_id").select("figure", "record_id").distinct()
    f = pairs.join(a.public_records.select("record_id", "year"), "record_id").select("figure", band_of(F.col("year"), BANDS).alias("band"))
    counts = f.groupBy("figure", "band").agg(F.count("*").alias("n"))
    top = counts.groupBy("figure").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "figure").limit(7).select("figure")
    return zero_filled(counts, top, a.bands.select("band"), ["figure", "band"])


@query("SELECT code, bands.band, count(r.record_id) AS n FROM (SELECT DISTINCT code FROM records WHERE code <> '') CROSS JOIN bands LEFT JOIN (SELECT code AS c, record_id, year FROM public_records) r ON r.c = code AND year BETWEEN first_year AND last_year GROUP BY 1, 2")
def narrative_period_matrix(a: Archive) -> DataFrame:
    labels = a.records.where("code <> ''").select("code").distinct()
    counts = a.public_records.groupBy("code", band_of(F.col("year"), BANDS).alias("band")).agg(F.count("*").alias("n"))
    return zero_filled(counts, labels, a.bands.select("band"), ["code", "band"])


@query(
    """WITH x AS (SELECT source_type AS family, record_id, source_id, nation_id, code, year, band FROM public_records JOIN sources USING (source_id) LEFT JOIN bands ON year BETWEEN first_year AND last_year), b AS (SELECT family, band, count(*) AS n, row_number() OVER (PARTITION BY family ORDER BY count(*) DESC, band) AS k FROM x WHERE band IS NOT NULL GROUP BY 1, 2)
    SELECT x.family, count(*) AS records, count(DISTINCT source_id) AS organisations, count(DISTINCT NULLIF(code, '')) AS narratives, count(DISTINCT nation_id) AS jurisdictions, min(year) AS first_year, max(year) AS last_year, any_value(b.band) AS dominant, CAST(floor(100.0 * any_value(b.n) / count(*) + 0.5) AS BIGINT) AS dominant_pct FROM x JOIN b ON b.family = x.family AND k = 1 GROUP BY x.family"""
)
def family_aggregate(a: Archive) -> DataFrame:
    x = a.public_records.join(a.sources, "source_id").select(F.col("source_type").alias("family"), "source_id", "nation_id", F.nullif("code", F.lit("")).alias("code"), "year", band_of(F.col("year"), BANDS).alias("band"))
    main = x.groupBy("family").agg(F.count("*").alias("records"), F.countDistinct("source_id").alias("organisations"), F.countDistinct("code").alias("narratives"), F.countDistinct("nation_id").alias("jurisdictions"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    by_band = x.where(~F.col("band").isin("undated", "outside_scope")).groupBy("family", "band").agg(F.count("*").alias("n"))
    top = first_by(by_band, ["family"], [F.desc("n"), "band"]).select("family", F.col("band").alias("dominant"), "n")
    return main.join(top, "family").withColumn("dominant_pct", F.floor(100.0 * F.col("n") / F.col("records") + 0.5)).drop("n")


@query(
    """WITH s AS (SELECT min(year) AS lo, greatest(max(year) - min(year), 1) AS span FROM public_records), b AS (SELECT CAST(least(span - 1, floor((year - lo) / span * span)) AS INTEGER) AS bin, relevance FROM public_records, s WHERE year IS NOT NULL)
    SELECT CAST(g.bin AS INTEGER) AS bin, count(b.bin) AS n, count(DISTINCT relevance) AS labels FROM (SELECT unnest(generate_series(0, (SELECT span - 1 FROM s))) AS bin) g LEFT JOIN b ON b.bin = g.bin GROUP BY 1"""
)
def timeline_bins(a: Archive) -> DataFrame:
    """Equal bins over the span of years, as many as years at most; empty bins count 0."""
    s = a.public_records.agg(F.min("year").alias("lo"), F.greatest(F.max("year") - F.min("year"), F.lit(1)).alias("span"))
    bins = s.select(F.explode(F.sequence(F.lit(0), F.col("span") - 1)).alias("bin"))
    at = F.least(F.col("span") - 1, F.floor((F.col("year") - F.col("lo")) / F.col("span") * F.col("span"))).cast("int")
    counts = a.public_records.where("year is not null").join(F.broadcast(s)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.countDistinct("relevance").alias("labels"))
    return bins.join(counts, "bin", "left").na.fill(0)


@query("SELECT source_id, source_name, count(record_id) AS records, min(year) AS first_year, max(year) AS last_year, COALESCE(array_to_string(list_sort(list(DISTINCT relevance) FILTER (relevance IS NOT NULL)), ', '), '') AS labels FROM sources LEFT JOIN public_records USING (source_id) GROUP BY 1, 2")
def source_registry(a: Archive) -> DataFrame:
    by_source = a.public_records.groupBy("source_id").agg(F.count("*").alias("records"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.array_join(F.sort_array(F.collect_set("relevance")), ", ").alias("labels"))
    return a.sources.select("source_id", "source_name").join(by_source, "source_id", "left").na.fill({"records": 0, "labels": ""})


@query("SELECT CASE WHEN source_type IN ('BUILDING','HOUSEHOLD') THEN 'domestic' WHEN source_type = '' THEN 'unknown' ELSE 'industry' END AS family, count(DISTINCT source_id) AS sources, count(record_id) AS records, round(100.0 * count(record_id) / (SELECT count(*) FROM public_records), 4) AS pct FROM sources LEFT JOIN public_records USING (source_id) GROUP BY 1")
def family_rollup(a: Archive) -> DataFrame:
    family = F.when(F.col("source_type").isin("BUILDING", "HOUSEHOLD"), "domestic").when(F.col("source_type") == "", "unknown").otherwise("industry")
    n = a.public_records.groupBy("source_id").agg(F.count("*").alias("n"))
    out = a.sources.join(n, "source_id", "left").groupBy(family.alias("family")).agg(F.count("*").alias("sources"), F.coalesce(F.sum("n"), F.lit(0)).alias("records"))
    return out.withColumn("pct", F.round(100.0 * F.col("records") / F.sum("records").over(all_rows()), 4))


@query(
    """WITH x AS (SELECT 's:' || source_type AS s, 'p:' || band AS p, 'n:' || relevance AS n FROM public_records JOIN sources USING (source_id) JOIN bands ON year BETWEEN first_year AND last_year WHERE relevance IS NOT NULL),
    nodes AS (SELECT node FROM (SELECT node, row_number() OVER (PARTITION BY lane ORDER BY count(*) DESC, node) AS k FROM (SELECT 's' AS lane, s AS node FROM x UNION ALL SELECT 'p', p FROM x UNION ALL SELECT 'n', n FROM x) GROUP BY lane, node) WHERE k <= 4)
    SELECT a AS from_node, b AS to_node, count(*) AS weight FROM (SELECT s AS a, p AS b FROM x UNION ALL SELECT p, n FROM x) WHERE a IN (SELECT node FROM nodes) AND b IN (SELECT node FROM nodes) GROUP BY 1, 2"""
)
def relation_edges(a: Archive) -> DataFrame:
    """Edges between adjacent lanes, counted where both ends are among their lane's top nodes. Triples are counted once first."""
    tag = lambda lane, c: F.concat(F.lit(f"{lane}:"), c)
    x = a.public_records.where("relevance is not null").join(a.sources, "source_id").withColumn("band", band_of(F.col("year"), BANDS)).where(~F.col("band").isin("undated", "outside_scope"))
    x = x.groupBy(tag("s", F.col("source_type")).alias("s"), tag("p", F.col("band")).alias("p"), tag("n", F.col("relevance")).alias("n")).agg(F.count("*").alias("w"))
    lanes = x.select(F.lit("s").alias("lane"), F.col("s").alias("node"), "w").unionAll(x.select(F.lit("p"), "p", "w")).unionAll(x.select(F.lit("n"), "n", "w"))
    nodes = first_by(lanes.groupBy("lane", "node").agg(F.sum("w").alias("w")), ["lane"], [F.desc("w"), "node"], 4).select("node")
    edges = x.select(F.col("s").alias("from_node"), F.col("p").alias("to_node"), "w").unionAll(x.select("p", "n", "w")).groupBy("from_node", "to_node").agg(F.sum("w").alias("weight"))
    return edges.join(nodes, edges["from_node"] == nodes["node"], "left_semi").join(nodes, edges["to_node"] == nodes["node"], "left_semi")


@query("SELECT year, n, round(n / sum(n) OVER (), 6) AS share, round(n / max(n) OVER (), 6) AS relative FROM (SELECT year, count(*) AS n FROM public_records WHERE year IS NOT NULL GROUP BY year)")
def period_shares(a: Archive) -> DataFrame:
    counted = a.public_records.where("year is not null").groupBy("year").agg(F.count("*").alias("n"))
    return counted.select("year", "n", F.round(F.col("n") / F.sum("n").over(all_rows()), 6).alias("share"), F.round(F.col("n") / F.max("n").over(all_rows()), 6).alias("relative"))
