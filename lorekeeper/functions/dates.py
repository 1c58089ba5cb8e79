"""Dates as people write them, and publication dates in parts, as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lorekeeper.functions.text import collapsed

_Y, _D, _M = "(1[7-9][0-9]{2}|20[0-9]{2})", "(0?[1-9]|[12][0-9]|3[01])", "(0?[1-9]|1[0-2])"
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_NAME = r"\b(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\b\.?"
_ORD = "(?:st|nd|rd|th)?"
_TO = r"\s*(?:-|–|—|/|to|and|until)\s*"
#: Fields of a publication's metadata that hold its date in parts, in order, and the years that count (fixed values).
PARTS, FIRST_YEAR, LAST_YEAR = ("published-print", "published-online", "published", "issued", "created"), 1803, 2026


def loose_date(text: Column) -> Column:
    """struct<first, last, month, day, precision, approximate> of the date in a text; null where there is none of a year from 1700 to 2099.

    In this order: a day (2001-03-12, 12/3/2001 with the day first, 12 March 2001, March 12th, 2001), a span of years (1890-1895, 1890-95, between 1890 and 1895), a
    decade or a part of it (1890s, late 1890s), a month (March 2001, 2001-03), a century (19th century), a year. A number of two
    digits behind a year is a month up to 12 and the end of a span above. approximate tells of c., circa, about, around, perhaps and question marks.
    """
    t = F.lower(collapsed(text))
    part = lambda pattern, k: F.nullif(F.regexp_extract(t, pattern, k), F.lit(""))
    number = lambda pattern, k: part(pattern, k).try_cast("int")
    month = lambda pattern, k: F.when(part(pattern, k).isNotNull(), ((F.instr(F.lit(" ".join(_MONTHS)), F.left(part(pattern, k), F.lit(3))) + 3) / 4).cast("int"))
    about = t.rlike(r"\b(?:c|ca|circa|about|around|abt|approx\w*|perhaps|probably)\b|\?")
    null = F.lit(None).cast("int")

    def told(first: Column, last: Column, m: Column, d: Column, precision: str) -> Column:
        return F.struct(first.cast("int").alias("first"), last.cast("int").alias("last"), m.cast("int").alias("month"), d.cast("int").alias("day"), F.lit(precision).alias("precision"), about.alias("approximate"))

    iso, numeric = rf"\b{_Y}-{_M}-{_D}(?![0-9])", rf"(?<![0-9]){_D}[/.]{_M}[/.]{_Y}\b"
    named, american = rf"\b{_D}{_ORD}(?: of)? {_NAME},? {_Y}\b", rf"{_NAME} {_D}{_ORD},? {_Y}\b"
    span, short = rf"\b{_Y}{_TO}{_Y}\b", rf"\b{_Y}\s*[-–/]\s*(1[3-9]|[2-9][0-9])\b"
    decade, by_name, by_number = r"\b(early|mid|late)?[ -]*(1[7-9][0-9]|20[0-9])0'?s\b", rf"{_NAME},? {_Y}\b", rf"\b{_Y}-{_M}(?![0-9-])"
    century, year = r"\b(18|19|20|21)(?:st|nd|rd|th)[ -]century\b", rf"(?<![0-9]){_Y}(?![0-9])"
    tens = number(decade, 2) * 10
    low = F.when(part(decade, 1) == "mid", tens + 4).when(part(decade, 1) == "late", tens + 7).otherwise(tens)
    high = F.when(part(decade, 1) == "early", tens + 3).when(part(decade, 1) == "mid", tens + 6).otherwise(tens + 9)
    ends = F.floor(number(short, 1) / 100) * 100 + number(short, 2)
    return F.coalesce(
        F.when(t.rlike(iso), told(number(iso, 1), number(iso, 1), number(iso, 2), number(iso, 3), "day")),
        F.when(t.rlike(numeric), told(number(numeric, 3), number(numeric, 3), number(numeric, 2), number(numeric, 1), "day")),
        F.when(t.rlike(named), told(number(named, 3), number(named, 3), month(named, 2), number(named, 1), "day")),
        F.when(t.rlike(american), told(number(american, 3), number(american, 3), month(american, 1), number(american, 2), "day")),
        F.when(t.rlike(span) & (number(span, 2) >= number(span, 1)), told(number(span, 1), number(span, 2), null, null, "span")),
        F.when(t.rlike(short) & (ends > number(short, 1)), told(number(short, 1), ends, null, null, "span")),
        F.when(t.rlike(decade), told(low, high, null, null, "decade")),
        F.when(t.rlike(by_name), told(number(by_name, 2), number(by_name, 2), month(by_name, 1), null, "month")),
        F.when(t.rlike(by_number), told(number(by_number, 1), number(by_number, 1), number(by_number, 2), null, "month")),
        F.when(t.rlike(century), told((number(century, 1) - 1) * 100 + 1, number(century, 1) * 100, null, null, "century")),
        F.when(t.rlike(year), told(number(year, 1), number(year, 1), null, null, "year")),
    )


def _date_parts(item: Column) -> Column:
    """The first list of date parts of each of PARTS in a JSON item, as texts; an empty list where a field has none."""
    found = [F.from_json(F.get_json_object(item, f"$['{name}']['date-parts'][0]"), "array<string>") for name in PARTS]
    return F.array(*[F.coalesce(f, F.array().cast("array<string>")) for f in found])


def published_year(item: Column) -> Column:
    """The first year of an item's date parts, field by field, that lies between FIRST_YEAR and LAST_YEAR."""
    years = F.transform(_date_parts(item), lambda p: F.get(p, 0).try_cast("int"))
    return F.get(F.filter(years, lambda y: y.between(FIRST_YEAR, LAST_YEAR)), 0)


def published_date(item: Column) -> Column:
    """The parts of the first field that has any, joined by hyphens; else the published year."""
    full = F.filter(F.transform(_date_parts(item), lambda p: F.array_join(F.filter(p, lambda x: x.isNotNull() & ~x.isin("", "0")), "-")), lambda x: x != "")
    return F.coalesce(F.get(full, 0), published_year(item).cast("string"))
