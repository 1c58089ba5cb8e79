"""Text, address and number expressions, JVM-side. Python is used only where Spark has no equal."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Quotes and dashes and what they become (fixed values).
SMART = "‘’“”–—−"
PLAIN = "''\"\"---"
#: What a title's place looks like, and what surrounds a word within its sentence (fixed values).
TITLE_PLACE = "[A-Za-z][A-Za-z0-9'&./ -]{2,80}?"
SENTENCE_BEFORE, SENTENCE_AFTER = "[^.?!]{0,180}", "[^.?!]{0,240}[.?!]?"
#: Query parameters that don't belong to an address (fixed values).
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "mc_cid", "mc_eid")


def collapsed(text: Column) -> Column:
    """Runs of any white space as one space, ends trimmed, null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


@F.pandas_udf(StringType())
def _compatible(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


@F.pandas_udf(StringType())
def _folded(text: pd.Series) -> pd.Series:
    return text.map(str.casefold, na_action="ignore")


@F.pandas_udf(StringType())
def _bare(text: pd.Series) -> pd.Series:
    return text.map(lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)), na_action="ignore")


def _beyond_ascii(f, text: Column, ascii_form: Column) -> Column:
    """f where a text has characters beyond ASCII; Python workers are sent nulls for all others."""
    wide = F.when(text.rlike(r"[^\x00-\x7F]"), text)
    return F.coalesce(f(wide), ascii_form)


def normalised(text: Column) -> Column:
    """Compatibility form (NFKC), then plain quotes and dashes, case folded, white space collapsed; null as empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.translate(_beyond_ascii(_compatible, text, text), SMART, PLAIN)
    return collapsed(_beyond_ascii(_folded, plain, F.lower(plain)))


def slug(text: Column, fallback: str = "item", max_length: int | None = None) -> Column:
    """Lower-case ASCII letters and digits joined by hyphens, marks off their letters (NFKD); the first max_length characters if given."""
    plain = normalised(text)
    joined = F.regexp_replace(_beyond_ascii(_bare, plain, plain), "[^a-z0-9]+", "-")
    out = F.regexp_replace(joined, "^-+|-+$", "")
    if max_length is not None:
        out = F.regexp_replace(F.left(out, F.lit(max_length)), "-+$", "")
    return F.coalesce(F.nullif(out, F.lit("")), F.lit(fallback))


def host(url: Column) -> Column:
    """The host in lower case without a leading www."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)), r"^www\.", "")


def _quoted(part: Column) -> Column:
    """A name or value of a query, decoded where it can be and encoded again: spaces as plus, ~ and _.- as they are."""
    plain = F.coalesce(F.try_url_decode(part), part)
    return F.replace(F.replace(F.url_encode(plain), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """Scheme (https, if none) and host in lower case, without www, fragment, tracking parameters and closing slashes.

    Ports stay, and so does a path of nothing but slashes. Null gives the empty string.
    """
    bare = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "#.*$", "")
    full = F.when(bare.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), bare).otherwise(F.concat(F.lit("https://"), bare))
    place = F.regexp_replace(F.lower(F.regexp_extract(full, r"^[^:]+://([^/?]*)", 1)), r"^www\.", "")
    path = F.regexp_extract(full, r"^[^:]+://[^/?]*([^?]*)", 1)
    cut = F.regexp_replace(path, "/+$", "")
    parts = F.filter(F.split(F.regexp_extract(full, r"\?(.*)$", 1), "&"), lambda p: p != "")
    pairs = F.transform(parts, lambda p: F.struct(_quoted(F.regexp_extract(p, "^([^=]*)", 1)).alias("k"), _quoted(F.regexp_extract(p, "=(.*)$", 1)).alias("v")))
    query = F.array_join(F.transform(F.filter(pairs, lambda x: ~F.lower(x["k"]).isin(*TRACKING)), lambda x: F.concat(x["k"], F.lit("="), x["v"])), "&")
    address = F.concat(F.lower(F.regexp_extract(full, "^([^:]+)://", 1)), F.lit("://"), place, F.when(cut == "", path).otherwise(cut), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(bare == "", "").otherwise(address)


def excerpt(text: Column, limit: int) -> Column:
    """A text cut at the last space before the limit and closed by a full stop; shorter ones stay."""
    t = collapsed(text)
    return F.when(F.char_length(t) <= limit, t).otherwise(F.concat(F.regexp_replace(F.substring(t, 1, limit), r"\s\S*$", ""), F.lit(".")))


def context(text: Column, position: Column, length: int, width: int) -> Column:
    """The text around a 1-based position, ``width`` characters on each side, clamped; empty where position is 0."""
    begin = F.greatest(F.lit(1), position - width)
    return F.when(position > 0, F.substring(text, begin, position + length + width - begin)).otherwise("")


def strip_tags(html: Column) -> Column:
    """Text of HTML by patterns: scripts and styles and all other tags a space, block ends line ends, common references decoded, empty lines gone."""
    t = F.regexp_replace(html, r"(?is)<(script|style).*?</\1>", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)<br\s*/?>|</(p|div|li|h[1-6]|tr)>", "\n"), r"<[^>]+>", " ")
    for reference, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        t = F.replace(t, F.lit(reference), F.lit(char))
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def evidence_hash(text: Column) -> Column:
    """The digest of a text in lower case with white space collapsed."""
    return F.sha2(F.lower(collapsed(text)), 256)


def cropped(text: Column, start: str | None, end: str | None) -> Column:
    """A text from the first start marker on, then up to the first end marker that doesn't begin it; a marker that isn't there cuts nothing."""
    if start:
        at = F.instr(F.lower(text), start.lower())
        text = F.when(at > 0, F.substring(text, at, F.char_length(text))).otherwise(text)
    if end:
        at = F.instr(F.lower(text), end.lower())
        text = F.when(at > 1, F.substring(text, F.lit(1), at - 1)).otherwise(text)
    return text


def sentence_around(text: Column, word: str, limit: int = 520) -> Column:
    """What surrounds the first mention of a word within its sentence, else the text's beginning."""
    flat = collapsed(text)
    quoted = re.sub(r"([^A-Za-z0-9 ])", r"\\\1", word)
    found = F.regexp_extract(flat, f"(?i){SENTENCE_BEFORE}{quoted}{SENTENCE_AFTER}", 0)
    return F.left(F.when(found != "", F.trim(found)).otherwise(flat), F.lit(limit))


def place_of(text: Column, state: Column, code: Column | None = None, hints: list[tuple[str, str, str]] = (), country: str = "Australia") -> Column:
    """The place that a heading is about, else its state, else the country.

    hints (words, code of a state, place) come first, the longest words first: words that are in the heading, whatever letters don't touch, name the
    place if they are of the heading's state. Otherwise the heading is read as: noise (years, brackets, the state by name and code, the country) that may be
    anywhere and is skipped, then the place, up to the first comma, or to a dash or colon behind a space, without punctuation at its ends.
    """
    name = F.coalesce(state, F.lit(""))
    quoted = lambda c: F.when(c != "", F.concat(F.lit(r"|\b\Q"), c, F.lit(r"\E\b"))).otherwise("")
    noise = F.concat(F.lit(r"(?i)\b(?:1[7-9][0-9]{2}|20[0-9]{2})\b|\([^)]*\)" + rf"|\b{country}\b"), quoted(name), quoted(F.coalesce(code, F.lit(""))) if code is not None else F.lit(""))
    heading = F.replace(F.regexp_replace(text, noise, F.lit("")), F.lit("&amp;"), F.lit("&"))
    place = collapsed(F.regexp_extract(heading, r"(?s)^[ ,.-]*(.*?)(?:[ ,.-]*\s-\s|[ ,.-]*\s:|,|[ ,.-]*$)", 1))
    told = [F.when((code == of) & F.lower(text).rlike(rf"(?<![a-z])\Q{words.lower()}\E(?![a-z])"), known) for words, of, known in sorted(hints, key=lambda h: -len(h[0]))] if code is not None else []
    return F.coalesce(*told, F.nullif(place, F.lit("")), F.nullif(name, F.lit("")), F.lit(country))


def place_state_year(title: Column, states: dict[str, str], unwanted: tuple[str, ...]) -> Column:
    """struct<place, state, year> of a title "place, state year", the state by name or code; null for others and for places that hold an unwanted word."""
    t = collapsed(title)
    either = [rf"(?i)^({TITLE_PLACE}),\s*({'|'.join(given)})\s+([0-9]{{4}})$" for given in (states, states.values())]
    part = lambda k: F.coalesce(*[F.nullif(F.regexp_extract(t, pattern, k), F.lit("")) for pattern in either])
    codes = F.create_map(*[F.lit(x) for name, code in states.items() for x in (name.upper(), code)])
    place, state = F.trim(part(1)), F.upper(part(2))
    known = F.struct(place.alias("place"), F.coalesce(F.element_at(codes, state), state).alias("state"), part(3).cast("int").alias("year"))
    return F.when((place != "") & ~F.lower(place).rlike("|".join(unwanted)), known)


def title_tokens(text: Column, stop: tuple[str, ...] = ("a", "an", "and", "in", "of", "on", "the", "to")) -> Column:
    """Distinct words of a title, normalised, but for the most common ones, sorted."""
    words = F.regexp_extract_all(normalised(text), F.lit("([a-z0-9]+)"), 1)
    return F.array_sort(F.array_except(F.array_distinct(words), F.array(*map(F.lit, stop))))


def jaccard(a: Column, b: Column) -> Column:
    """Intersection over union of two arrays of distinct values; 0 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    d_lat, d_lon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.sin(d_lat) * F.sin(d_lat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(d_lon) * F.sin(d_lon)
    return F.lit(2 * 6371.0) * F.atan2(F.sqrt(h), F.sqrt(1 - h))
