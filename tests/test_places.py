"""Names in texts, their precedence, and evidence near terms, against plain Python."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorekeeper.operators import gazetteer as g
from lorekeeper.operators.nearness import closest, evidence_windows

DOCS = "doc_id long, text string"


def pattern(name):
    return re.compile(rf"(?<!\w){re.escape(name.strip()).replace(re.escape(' '), chr(92) + 's+')}(?!\w)", re.I)


def spans(texts, names, around=90):
    out = []
    for d, text in texts:
        for i, name in names:
            for m in pattern(name).finditer(text or "") if name and re.search(r"\w", name) else ():
                out.append((d, i, m.start(), m.end(), " ".join((text[max(0, m.start() - around) : m.end() + around]).split())))
    return sorted(out, key=repr)


NAMES = [(1, "Bega"), (2, "Wagga Wagga"), (3, "Foo bar baz"), (4, "é"), (5, "x" * 40), (6, None), (7, "Mt. Morgan"), (8, "bega"), (9, "St Mary's (Qld)"), (10, "one two three four five six"), (11, "one two three four five six seven eight nine ten"), (12, ""), (13, "--"), (14, "(The) Gap"), (15, "über"), (16, "one two three four")]
TEXTS = [
    (1, 'At "Foo bar baz", near Bega. BEGA'), (2, "Begans of Wagga \n\t Wagga"), (3, "café Foo bar baz_. é"), (4, None), (5, ""), (6, "Begatown, Mt.  Morgan and mt. morgan; Mt.Morgan"),
    (7, "ONE  two three four five six seven eight nine ten" * 2), (8, "in St Mary's (Qld) and St Mary's"), (9, "the Gap, (the) gap"), (10, "Über den Fluss" + "y " * 3000 + "Bega"), (11, "one two three\nfour five six" + " z" * 50), (12, "x" * 41 + " " + "x" * 40),
]


def test_every_mention(spark, monkeypatch):
    docs, names = spark.createDataFrame(TEXTS, DOCS), spark.createDataFrame(NAMES, "item_id long, name string")
    got = sorted((tuple(r) for r in g.mentions(docs, names, every=True).collect()), key=repr)
    assert got == spans(TEXTS, NAMES) and len(got) > 15
    first = {}
    for d, i, s, e, x in sorted(spans(TEXTS, NAMES), key=lambda r: r[2]):
        first.setdefault((d, i), (s, e, x))
    assert {(r.doc_id, r.item_id): (r.start, r.end, r.evidence) for r in g.first_mentions(docs, names).collect()} == first


@pytest.mark.parametrize("size", [1 << 20, 64])
def test_random_names_and_texts(spark, monkeypatch, size):
    monkeypatch.setattr(g, "SLICE_BYTES", size)
    rng = random.Random(3)
    words = ["the", "of", "Bega", "wagga", "St.", "Mary's", "é", "big-river", "x"]
    texts = [(k, "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", ", ", "-"]) for _ in range(rng.randint(0, 60)))) for k in range(40)]
    names = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([1, 1, 2, 3, 5, 7])))) for k in range(60)]
    got = sorted((tuple(r) for r in g.mentions(spark.createDataFrame(texts, DOCS).coalesce(2), spark.createDataFrame(names, "item_id long, name string"), 7, every=True).collect()), key=repr)
    want = spans(texts, names, 7)
    # A pattern's own search skips mentions that overlap; every place where it matches is a mention here.
    assert set(want) <= set(got)
    for d, i, s, e, _ in got:
        assert (m := pattern(dict(names)[i]).match(dict(texts)[d], s)) and m.end() == e


CATALOGUE = [("Bega", 2, "Bega Valley", 1), ("Bega", 2, "Bega", 2), ("Gap", 1, "The Gap", 1), ("Gap", 1, "Gap", 2), ("Wagga Wagga", 3, "Wagga Wagga", 1), ("Wagga Wagga", 3, "Wagga", 2), ("Far", 4, None, 1)]


def test_precedence(spark):
    texts = [(1, "Bega, then the Bega Valley; Wagga"), (2, "Gap and The  Gap " + "y" * 100 + " Wagga ghost"), (3, "Begatown"), (4, "a ghost of Wagga Wagga"), (5, None)]
    docs, catalogue = spark.createDataFrame(texts, DOCS), spark.createDataFrame(CATALOGUE, "place string, place_order int, alias string, alias_order int")
    got = [tuple(r)[:6] for r in g.places_named(docs, catalogue).orderBy("doc_id", "rank").collect()]
    # The longest alias of any of a place's puts it first; the alias told is the first in its own order.
    assert got == [(1, 1, "Bega", "Bega Valley", 15, 26), (1, 2, "Wagga Wagga", "Wagga", 28, 33), (2, 1, "Wagga Wagga", "Wagga", 118, 123), (2, 2, "Gap", "The Gap", 8, 16), (4, 1, "Wagga Wagga", "Wagga Wagga", 11, 22)]
    near = {r.doc_id: r.place for r in g.first_place(docs, catalogue, F.col("evidence").rlike("(?i)ghost"), 20).collect()}
    assert near == {2: "Wagga Wagga", 4: "Wagga Wagga"}
    assert {r.doc_id: r.place for r in g.first_place(docs, catalogue).collect()} == {1: "Bega", 2: "Gap", 4: "Wagga Wagga"}


def test_no_names_and_no_texts(spark):
    docs, names = spark.createDataFrame(TEXTS, DOCS), spark.createDataFrame(NAMES, "item_id long, name string")
    assert g.mentions(docs, names.limit(0)).count() == g.mentions(docs.limit(0), names).count() == 0


def test_closest():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = (np.sort(rng.choice(60, rng.integers(0, 9), replace=False)) for _ in range(2))
        got = closest(a, b)
        if not len(a) or not len(b):
            assert got is None
        else:
            assert abs(a[got[0]] - b[got[1]]) == min(abs(x - y) for x in a for y in b)


def windows(texts, places, terms, radius, nearest):
    """As a loop over texts, places and matches."""
    clip = lambda t, n: t if len(t) <= n else t[: n - 1].rsplit(" ", 1)[0] + "."
    out = []
    for d, text in texts:
        text, some = " ".join((text or "").split()), False
        for place, aliases in places:
            alias = next((a for a in aliases if re.search(rf"\b{a}\b", text, re.I)), None)
            if alias is None:
                continue
            some = True
            m = re.search(rf"\b{alias}\b", text, re.I)
            found = list(re.finditer(terms, text, re.I))
            t = (min(found, key=lambda x: abs(x.start() - m.start())) if nearest else found[0]) if found else None
            distance = None if t is None else abs(t.start() - m.start())
            paired = t is not None and (not nearest or distance <= 2 * radius)
            low, high = (min(m.start(), t.start()), max(m.end(), t.end())) if paired else m.span()
            low, high = max(0, low - radius), min(len(text), high + radius)
            out.append((d, place, alias, low, high, distance, paired, clip(" ".join(text[low:high].split()), 900 if nearest else 760)))
        if text and not some:
            out.append((d, None, None, 0, len(text), None, False, clip(text, 760)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("nearest", [True, False])
def test_evidence_windows(spark, nearest):
    far = "Bega " + "y " * 50_000 + "ghost"
    texts = [(1, "a ghost at Bega, a ghost"), (2, far), (3, "ghost " * 3 + "z " * 400 + "Bega " + "w " * 300 + "yowie"), (4, "nothing " * 200), (5, None), (6, " "), (7, "Bega and Gap  without"), (8, "Begatown ghost The Gap"), (9, "ghost" + " q" * 30 + " Bega" + " q" * 30 + " ghost")]
    places = [("bega", ["Bega Valley", "Bega"]), ("gap", ["The Gap", "Gap"])]
    got = [tuple(r) for r in evidence_windows(spark.createDataFrame(texts, DOCS), places, "ghost|yowie", 100, nearest=nearest).collect()]
    assert sorted(got, key=repr) == windows(texts, places, "ghost|yowie", 100, nearest)


def test_any_mention_of_a_place(spark):
    texts = [(1, "Bega " + "y " * 400 + "Bega ghost")]
    df = spark.createDataFrame(texts, DOCS)
    one, every = (evidence_windows(df, [("bega", ["Bega"])], "ghost", 100, every_place=e).first() for e in (False, True))
    assert (one.distance, one.paired, one.start) == (810, False, 0) and (every.distance, every.paired, every.end) == (5, True, 815)
