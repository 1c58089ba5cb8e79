"""Years, period bands and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRESENT = 9999


def band_of(year: Column, bands: list[tuple[str, int, int]]) -> Column:
    """The first band that holds the year; ``undated`` for null, ``outside_scope`` for none. A chain of a few conditions, so no join."""
    out = F.when(year.isNull(), "undated")
    for band, first, last in bands:
        out = out.when(year.between(first, last), band)
    return out.otherwise("outside_scope")


def bands_between(periods: list[tuple[str, int | None, int | None]], earliest: int | None, latest: int | None) -> list[tuple[str, int | None, int | None]]:
    """Periods (band, first, last) as bands from the earliest to the latest year: a first or last of None stands for those.

    Without years no band has bounds. Bands have to follow one another without a gap, from the earliest year to the latest one; otherwise ValueError.
    """
    if earliest is None or latest is None:
        return [(band, None, None) for band, _, _ in periods]
    bands = [(band, earliest if first is None else first, latest if last is None else last) for band, first, last in periods]
    for (_, _, before), (band, first, _) in zip(bands, bands[1:]):
        if first != before + 1:
            raise ValueError(f"period {band} starts in {first}, after {before}")
    for band, first, last in bands:
        if last < first:
            raise ValueError(f"period {band} ends in {last}, before it starts in {first}")
    if bands and (bands[0][1], bands[-1][2]) != (earliest, latest):
        raise ValueError(f"periods from {bands[0][1]} to {bands[-1][2]} for years from {earliest} to {latest}")
    return bands


def leading_year(text: Column) -> Column:
    """The first four characters as a year, if they are digits."""
    head = F.substring(F.trim(text), 1, 4)
    return F.when(head.rlike("^[0-9]{4}$"), head.try_cast("int"))


def year_in(text: Column) -> Column:
    """The first whole number from 1700 to 2099 in a text."""
    return F.nullif(F.regexp_extract(text, r"\b(1[7-9][0-9]{2}|20[0-9]{2})\b", 1), F.lit("")).try_cast("int")


def date_precision(text: Column) -> Column:
    """How exact a date text is, by its shape."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), "exact_day").when(t.rlike("^[0-9]{4}-[0-9]{2}$"), "month").when(t.rlike("^[0-9]{4}$"), "year").otherwise("unknown")


def interval_overlaps(intervals: DataFrame, bands: DataFrame, start: str, end: str) -> DataFrame:
    """Intervals joined to every band that they touch. An open end reaches to now; a missing end is the start; a missing start touches none.

    bands is a dimension of a handful of rows, so a broadcast range join costs one comparison a band.
    """
    last = F.coalesce(F.col(end), F.col(start))
    return intervals.join(F.broadcast(bands), (F.col(start) <= F.col("last_year")) & (last >= F.col("first_year")))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 for an empty whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def band_summary(records: DataFrame, mapped: DataFrame, bands: list[tuple[str, int, int]]) -> DataFrame:
    """Records, mapped records and their shares by band, empty bands included; undated and outside rows only when there are any."""
    spark = records.sparkSession
    flags = mapped.select("record_id").distinct().withColumn("is_mapped", F.lit(1))
    counted = records.join(flags, "record_id", "left").groupBy(band_of(F.col("year"), bands).alias("band")).agg(F.count("*").alias("records"), F.count("is_mapped").alias("mapped"))
    dim = spark.createDataFrame(bands, "band string, first_year int, last_year int")
    all_bands = F.broadcast(dim).join(counted, "band", "full")
    span = F.col("last_year") - F.col("first_year") + 1
    records_n, mapped_n = F.coalesce("records", F.lit(0)), F.coalesce("mapped", F.lit(0))
    return all_bands.select("band", records_n.alias("records"), mapped_n.alias("mapped"), F.round(share(mapped_n, records_n), 6).alias("mapped_share"), span.alias("span_years"), F.round(records_n / span, 6).alias("records_per_year"))
