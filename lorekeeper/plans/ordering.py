"""Representatives, samples, quotas, navigation and jitter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lorekeeper.operators.periods import band_of
from lorekeeper.operators.ranking import even_positions, first_by, numbered
from lorekeeper.registry import query
from lorekeeper.sources.archive import BANDS, Archive

#: What breaks every tie between places of one record: (record, priority) is not unique.
TIES = ["priority", "location_id", "figure_id", "seen_at", "quantity"]


@query("SELECT record_id, location_id, figure_id, priority, relation FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY CASE kind WHEN 'F' THEN 0 ELSE 1 END, priority, location_id, figure_id, seen_at, quantity) AS k FROM record_places) WHERE k = 1")
def representative_location(a: Archive) -> DataFrame:
    rank = F.when(F.col("kind") == "F", 0).otherwise(1)
    return first_by(a.record_places.withColumn("rank", rank), ["record_id"], ["rank", *TIES]).select("record_id", "location_id", "figure_id", "priority", "relation")


@query("SELECT record_id, location_id, relation = 'R' AS upgraded FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY CASE WHEN relation = 'R' THEN 0 ELSE 1 END, priority, location_id, figure_id, seen_at, quantity) AS k FROM record_places) WHERE k = 1")
def first_location_upgrade(a: Archive) -> DataFrame:
    """The first place of a record, unless a later one is of the wanted relation."""
    better = F.when(F.col("relation") == "R", 0).otherwise(1)
    return first_by(a.record_places.withColumn("better", better), ["record_id"], ["better", *TIES]).select("record_id", "location_id", (F.col("relation") == "R").alias("upgraded"))


@query("SELECT figure, label AS alias FROM (SELECT figure, label, row_number() OVER (PARTITION BY figure ORDER BY tier DESC, length(label) DESC, label, figure_id) AS k FROM figures) WHERE k = 1")
def primary_alias(a: Archive) -> DataFrame:
    return first_by(a.figures, ["figure"], [F.desc("tier"), F.desc(F.char_length("label")), "label", "figure_id"]).select("figure", F.col("label").alias("alias"))


@query("SELECT record_id, year FROM public_records ORDER BY COALESCE(year, 9999), record_id")
def undated_last(a: Archive) -> DataFrame:
    return a.public_records.select("record_id", "year").orderBy(F.coalesce("year", F.lit(9999)), "record_id")


@query("SELECT source_id, source_type, n FROM (SELECT source_id, NULLIF(source_type, '') AS source_type, count(record_id) AS n FROM sources LEFT JOIN public_records USING (source_id) GROUP BY 1, 2) ORDER BY source_type ASC NULLS FIRST, n DESC, source_id")
def nulls_first_sort(a: Archive) -> DataFrame:
    n = a.public_records.groupBy("source_id").agg(F.count("*").alias("n"))
    out = a.sources.select("source_id", F.nullif("source_type", F.lit("")).alias("source_type")).join(n, "source_id", "left").na.fill(0, ["n"])
    return out.orderBy(F.asc_nulls_first("source_type"), F.desc("n"), "source_id")


@query(
    """WITH o AS (SELECT record_id, row_number() OVER (ORDER BY record_id) - 1 AS slot, count(*) OVER () AS n FROM public_records)
    SELECT record_id, CAST(slot AS BIGINT) AS slot FROM o WHERE slot IN (SELECT CAST(round_even(i * (n - 1) / 49.0, 0) AS BIGINT) FROM (SELECT unnest(generate_series(0, 49)) AS i) CROSS JOIN (SELECT count(*) AS n FROM public_records))"""
)
def even_sample(a: Archive) -> DataFrame:
    """Fifty rows spread evenly over the order of ids."""
    total = a.public_records.agg(F.count("*").alias("n"))
    wanted = total.select(F.explode(even_positions(F.col("n"), 50)).alias("slot"))
    return numbered(a.public_records.select("record_id"), ["record_id"], "slot").join(F.broadcast(wanted), "slot", "left_semi").select("record_id", "slot")


@query("SELECT location_id, state, turn FROM (SELECT location_id, state, row_number() OVER (PARTITION BY state ORDER BY location_id) AS turn FROM places) WHERE turn <= 3 ORDER BY turn, state LIMIT 40")
def round_robin(a: Archive) -> DataFrame:
    """Up to three places of each state, one of every state in each turn."""
    w = W.partitionBy("state").orderBy("location_id")
    return a.places.select("location_id", "state", F.row_number().over(w).cast("long").alias("turn")).where("turn <= 3").orderBy("turn", "state").limit(40)


@query(
    """WITH x AS (SELECT record_id, source_id, code, COALESCE(band, 'undated') AS band FROM public_records LEFT JOIN bands ON year BETWEEN first_year AND last_year),
    p AS (SELECT 1 AS pass, min(record_id) AS record_id FROM x GROUP BY band UNION ALL SELECT 2, min(record_id) FROM x GROUP BY code UNION ALL SELECT 3, min(record_id) FROM x GROUP BY source_id)
    SELECT record_id, min(pass) AS pass FROM p GROUP BY record_id ORDER BY pass, record_id LIMIT 60"""
)
def diversity_sample(a: Archive) -> DataFrame:
    """The first record of every band, then of every code, then of every source; a record counts in its first pass."""
    x = a.public_records.withColumn("band", F.regexp_replace(band_of(F.col("year"), BANDS), "outside_scope", "undated"))
    first = lambda k, c: x.groupBy(c).agg(F.min("record_id").alias("record_id")).select(F.lit(k).alias("pass"), "record_id")
    passes = first(1, "band").unionAll(first(2, "code")).unionAll(first(3, "source_id"))
    return passes.groupBy("record_id").agg(F.min("pass").alias("pass")).orderBy("pass", "record_id").limit(60)


@query("SELECT record_id FROM public_records ORDER BY md5('7:' || CAST(record_id AS VARCHAR)), record_id LIMIT 100")
def seeded_sample(a: Archive) -> DataFrame:
    """A repeatable sample of a hundred rows by the order of a seeded hash."""
    return a.public_records.select("record_id").orderBy(F.md5(F.concat(F.lit("7:"), F.col("record_id").cast("string")).cast("binary")), "record_id").limit(100)


@query("SELECT event_id, event_type FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM events) WHERE k <= 25")
def term_hit_cap(a: Archive) -> DataFrame:
    """A report of the first 25 hits of each term."""
    return first_by(a.table("events").select("event_id", "event_type", "ts"), ["event_type"], ["ts", "event_id"], 25).select("event_id", "event_type")


@query("SELECT record_id, CAST(row_number() OVER (ORDER BY COALESCE(year, 9999), record_id) - 1 AS BIGINT) AS growth_index FROM public_records")
def growth_order(a: Archive) -> DataFrame:
    rows = a.public_records.select("record_id", F.coalesce("year", F.lit(9999)).alias("y"))
    return numbered(rows, ["y", "record_id"], "growth_index").select("record_id", "growth_index")


@query("SELECT location_id, CAST(row_number() OVER w - 1 AS BIGINT) AS slot, count(*) OVER (PARTITION BY round(lat / 5), round(lon / 5)) AS crowd, round(CASE WHEN count(*) OVER (PARTITION BY round(lat / 5), round(lon / 5)) > 1 THEN 3 * sin((row_number() OVER w - 1) * 2.399963) ELSE 0 END, 4) AS dy FROM places WINDOW w AS (PARTITION BY round(lat / 5), round(lon / 5) ORDER BY location_id)")
def collision_jitter(a: Archive) -> DataFrame:
    """Places of one grid cell numbered, and turned by the golden angle so that they don't cover one another."""
    cell = [F.round(F.col("lat") / 5), F.round(F.col("lon") / 5)]
    slot, crowd = F.row_number().over(W.partitionBy(*cell).orderBy("location_id")) - 1, F.count("*").over(W.partitionBy(*cell))
    return a.places.select("location_id", slot.cast("long").alias("slot"), crowd.alias("crowd"), F.round(F.when(crowd > 1, 3 * F.sin(slot * 2.399963)).otherwise(0.0), 4).alias("dy"))


@query("SELECT source_id, CAST(CASE WHEN n >= 8 THEN 30 ELSE 0 END + CASE WHEN source_type = 'BUILDING' THEN 20 ELSE 0 END + CASE WHEN latest >= 2000 THEN 10 ELSE 0 END - CASE WHEN source_type = '' THEN 15 ELSE 0 END AS INTEGER) AS score FROM (SELECT source_id, source_type, count(record_id) AS n, max(year) AS latest FROM sources LEFT JOIN public_records USING (source_id) GROUP BY 1, 2) ORDER BY score DESC, source_id")
def route_rank(a: Archive) -> DataFrame:
    n = a.public_records.groupBy("source_id").agg(F.count("*").alias("n"), F.max("year").alias("latest"))
    j = a.sources.join(n, "source_id", "left")
    bonus = lambda c, x: F.when(c, x).otherwise(0)
    score = bonus(F.col("n") >= 8, 30) + bonus(F.col("source_type") == "BUILDING", 20) + bonus(F.col("latest") >= 2000, 10) - bonus(F.col("source_type") == "", 15)
    return j.select("source_id", score.alias("score")).orderBy(F.desc("score"), "source_id")


@query("SELECT conv_id, turn, role, prev_role, next_role, CAST(gap AS BIGINT) AS gap FROM (SELECT conv_id, turn, role, lag(role) OVER w AS prev_role, lead(role) OVER w AS next_role, turn - lag(turn) OVER w AS gap FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))")
def conversation_nav(a: Archive) -> DataFrame:
    w = W.partitionBy("conv_id").orderBy("turn")
    return a.table("conversations").select("conv_id", "turn", "role", F.lag("role").over(w).alias("prev_role"), F.lead("role").over(w).alias("next_role"), (F.col("turn") - F.lag("turn").over(w)).alias("gap"))
