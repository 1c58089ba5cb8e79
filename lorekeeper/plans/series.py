"""Time series of events and the batch forms of the streaming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lorekeeper.functions.dates import loose_date
from lorekeeper.operators.periods import band_of
from lorekeeper.registry import query
from lorekeeper.sources.archive import BANDS, Archive
from lorekeeper.streaming.events import windowed_counts


@query("SELECT event_type AS term, CAST(ts AS DATE) AS day, count(*) AS n, CAST(round(sum(CAST(value AS DECIMAL(18,4))), 4) AS DOUBLE) AS value FROM events GROUP BY 1, 2")
def attention_series(a: Archive) -> DataFrame:
    return a.table("events").groupBy(F.col("event_type").alias("term"), F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("decimal(18,4)")), 4).cast("double").alias("value"))


@query("SELECT date_trunc('day', ts) AS window_start, event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1, 2")
def windowed_events(a: Archive) -> DataFrame:
    return windowed_counts(a.table("events"))


@query("SELECT CAST(day AS VARCHAR) AS day, CAST(total AS BIGINT) AS total, CAST(floor(total / 250) > floor(COALESCE(prev, 0) / 250) AS BOOLEAN) AS due FROM (SELECT day, total, lag(total) OVER (ORDER BY day) AS prev FROM (SELECT day, sum(n) OVER (ORDER BY day) AS total FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)))")
def checkpoint_due(a: Archive) -> DataFrame:
    """Running totals by day, and whether a day crosses a multiple of 250. The window runs over days, not rows."""
    daily = a.table("events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    w = W.orderBy("day")
    total = daily.select("day", F.sum("n").over(w).alias("total"))
    return total.select(F.col("day").cast("string").alias("day"), "total", (F.floor(F.col("total") / 250) > F.floor(F.coalesce(F.lag("total").over(w), F.lit(0)) / 250)).alias("due"))


@query("SELECT event_id FROM events e WHERE ts >= TIMESTAMP '2024-01-15' AND NOT EXISTS (SELECT 1 FROM events h WHERE h.ts < TIMESTAMP '2024-01-15' AND h.user_id = e.user_id AND h.props = e.props)")
def cross_batch_new(a: Archive) -> DataFrame:
    """Rows of a later batch whose evidence no earlier batch has seen."""
    e = a.table("events")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    return e.where(F.col("ts") >= cut).join(e.where(F.col("ts") < cut).select("user_id", "props"), ["user_id", "props"], "left_anti").select("event_id")


@query(
    """WITH r AS (SELECT record_id, COALESCE(NULLIF(code, ''), 'uncoded') AS figure, COALESCE(band, CASE WHEN year IS NULL THEN 'undated' ELSE 'outside_scope' END) AS band, year, state FROM public_records LEFT JOIN bands ON year BETWEEN first_year AND last_year LEFT JOIN (SELECT record_id, min(location_id) AS location_id FROM record_places WHERE relation = 'R' GROUP BY 1) USING (record_id) LEFT JOIN places USING (location_id))
    SELECT 'band' AS part, band AS key, count(*) AS n, count(*) FILTER (WHERE year IS NULL) AS undated, count(state) AS mapped, min(record_id) AS first_record FROM r GROUP BY band UNION ALL SELECT 'figure', figure, count(*), count(*) FILTER (WHERE year IS NULL), count(state), min(record_id) FROM r GROUP BY figure
    UNION ALL SELECT 'state', state, count(*), count(*) FILTER (WHERE year IS NULL), count(state), min(record_id) FROM r WHERE state IS NOT NULL GROUP BY state UNION ALL SELECT 'all', NULL, count(*), count(*) FILTER (WHERE year IS NULL), count(state), min(record_id) FROM r"""
)
def derived_data(a: Archive) -> DataFrame:
    """What a reader of the release derives from it: counts, undated and mapped records and the first record by band, by figure, by state and over all, as grouping sets of one shuffle."""
    flags = a.record_places.where("relation = 'R'").groupBy("record_id").agg(F.min("location_id").alias("location_id"))
    r = a.public_records.join(flags, "record_id", "left").join(a.places.select("location_id", "state"), "location_id", "left")
    r = r.select("record_id", "year", F.coalesce(F.nullif("code", F.lit("")), F.lit("uncoded")).alias("figure"), band_of(F.col("year"), BANDS).alias("band"), "state")
    sets = r.groupingSets([["band"], ["figure"], ["state"], []], "band", "figure", "state")
    out = sets.agg(F.grouping_id().alias("g"), F.count("*").alias("n"), F.count_if(F.col("year").isNull()).alias("undated"), F.count("state").alias("mapped"), F.min("record_id").alias("first_record"))
    part = F.when(F.col("g") == 3, "band").when(F.col("g") == 5, "figure").when(F.col("g") == 6, "state").otherwise("all")
    return out.select(part.alias("part"), F.coalesce("band", "figure", "state").alias("key"), "n", "undated", "mapped", "first_record").where("part <> 'state' or key is not null")


@query(
    """WITH r AS (SELECT record_id, CAST(substr(date_text, 1, 4) AS INTEGER) AS y, CAST(substr(date_text, 6, 2) AS INTEGER) AS m, CAST(substr(date_text, 9, 2) AS INTEGER) AS d, record_id % 8 AS k FROM records)
    SELECT record_id, CASE k WHEN 5 THEN y // 10 * 10 WHEN 7 THEN NULL ELSE y END AS first, CASE k WHEN 4 THEN y + 3 WHEN 5 THEN y // 10 * 10 + 9 WHEN 7 THEN NULL ELSE y END AS last, CASE WHEN k IN (0, 1, 2, 3) THEN m END AS month, CASE WHEN k IN (0, 1, 2) THEN d END AS day, CASE k WHEN 3 THEN 'month' WHEN 4 THEN 'span' WHEN 5 THEN 'decade' WHEN 6 THEN 'year' WHEN 7 THEN NULL ELSE 'day' END AS precision, CASE WHEN k <> 7 THEN k = 6 END AS approximate FROM r"""
)
def loose_dates(a: Archive) -> DataFrame:
    """Dates of records written in eight ways, read back: days in three layouts, months, spans, decades, years with c., and texts without a year."""
    k, day = F.col("record_id") % 8, F.to_date("date_text")
    shown = lambda f: F.date_format(day, f)
    year = F.year(day)
    text = (
        F.when(k == 0, F.col("date_text")).when(k == 1, shown("d/M/yyyy")).when(k == 2, F.concat(F.lit("seen on "), shown("MMMM d, yyyy"))).when(k == 3, shown("MMM. yyyy")).when(k == 4, F.concat_ws(" to ", year.cast("string"), (year + 3).cast("string")))
        .when(k == 5, F.concat(F.lit("the "), (F.floor(year / 10) * 10).cast("string"), F.lit("s"))).when(k == 6, F.concat(F.lit("c. "), year.cast("string"))).otherwise("date unknown")
    )
    return a.records.select("record_id", loose_date(text).alias("d")).select("record_id", "d.first", "d.last", "d.month", "d.day", "d.precision", "d.approximate")
