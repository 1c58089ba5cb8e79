"""Evidence around a place and the term that is nearest to it."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Characters of an excerpt around a pair, and around one place or of a whole text (fixed values).
PAIR_CHARS, SINGLE_CHARS = 900, 760


def closest(places: np.ndarray, terms: np.ndarray) -> tuple[int, int] | None:
    """The pair of a place and a term that start nearest to each other, the first of equally near ones; both sorted, merged in one pass."""
    if not len(places) or not len(terms):
        return None
    after = np.searchsorted(terms, places)
    before, after = np.maximum(after - 1, 0), np.minimum(after, len(terms) - 1)
    near = np.where(np.abs(terms[before] - places) <= np.abs(terms[after] - places), before, after)
    at = int(np.argmin(np.abs(terms[near] - places)))
    return at, int(np.searchsorted(terms, terms[near[at]]))


def _bounded(word: str) -> str:
    """A term as a pattern: bounded by words' ends where it begins and ends in a letter or digit, over any white space."""
    word = " ".join(word.split())
    form = re.escape(word).replace(r"\ ", r"\s+")
    return rf"\b{form}\b" if word[0].isalnum() and word[-1].isalnum() else form


def evidence_windows(docs: DataFrame, places: list[tuple[str, list[str]]], terms: str, radius: int, nearest: bool = True, every_place: bool = False) -> DataFrame:
    """(doc_id, place, alias, start, end, distance, paired, evidence) for every text and every configured place that it names.

    A place is known by the first of its aliases that the text (doc_id, text; white space collapsed) holds. Of its first mention,
    or with ``every_place`` of any, and the matches of ``terms``, those two that start nearest to each other count, at a
    ``distance``. Up to 2 * radius apart they are a pair, whose window reaches from the first to the end of the last and radius more on
    each side; otherwise, or without any term (distance null), the window is around the place's first mention alone. The evidence is an excerpt of
    PAIR_CHARS. Without ``nearest`` the first mention and the first term are a pair however far apart, and the excerpt has SINGLE_CHARS.
    A text that names no place gives one row, without place, of its first SINGLE_CHARS; null and empty texts give none. start and end
    are in characters of the collapsed text, from 0, end exclusive.
    """
    known = [(place, alias, re.compile(_bounded(alias), re.I)) for place, aliases in places for alias in aliases if alias.strip()]
    wanted = re.compile(terms, re.I)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                spans, done = None, set()
                for place, alias, form in known:
                    if place in done or (first := form.search(text)) is None:
                        continue
                    done.add(place)
                    if spans is None:
                        spans = np.array([m.span() for m in wanted.finditer(text)], np.int64).reshape(-1, 2)
                    own = np.array([m.span() for m in form.finditer(text)] if every_place else [first.span()], np.int64)
                    pair = closest(own[:, 0], spans[:, 0]) if nearest or not len(spans) else (0, 0)
                    distance = None if pair is None else abs(int(own[pair[0], 0] - spans[pair[1], 0]))
                    paired = pair is not None and (not nearest or distance <= 2 * radius)
                    low, high = first.span()
                    if paired:
                        both = np.stack([own[pair[0]], spans[pair[1]]])
                        low, high = int(both[:, 0].min()), int(both[:, 1].max())
                    low, high = max(0, low - radius), min(len(text), high + radius)
                    out.append((doc, place, alias, low, high, distance, paired, text[low:high]))
                if not done:
                    out.append((doc, None, None, 0, len(text), None, False, text[: SINGLE_CHARS + 2]))
            told = pd.DataFrame(out, columns=["doc_id", "place", "alias", "start", "end", "distance", "paired", "evidence"])
            told["distance"] = told["distance"].astype("Int64")
            yield told

    kind = dict(docs.dtypes)["doc_id"]
    flat = docs.select("doc_id", F.trim(F.regexp_replace("text", r"(?U)\s+", " ")).alias("text")).where("text <> ''")
    found = flat.mapInPandas(run, f"doc_id {kind}, place string, alias string, start long, end long, distance long, paired boolean, evidence string")
    single = clipped(F.col("evidence"), SINGLE_CHARS)
    return found.withColumn("evidence", F.when(F.col("place").isNull(), single).otherwise(clipped(F.col("evidence"), PAIR_CHARS) if nearest else single))


def clipped(text: Column, limit: int) -> Column:
    """A text cut before its limit at the last space and closed by a full stop; shorter ones stay."""
    flat = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.when(F.char_length(flat) <= limit, flat).otherwise(F.concat(F.regexp_replace(F.left(flat, F.lit(limit - 1)), r" [^ ]*$", ""), F.lit(".")))
