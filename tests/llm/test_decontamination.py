"""op3 against brute-force local alignment of every document with every item."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.decontamination import align, find_leaks, without_leaking_texts


def words(text):
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def score(a, b):
    held, best = [0] * (len(b) + 1), 0
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, held[j] + (2 if x == y else -1), held[j + 1] - 1, new[j] - 1))
        held, best = new, max(best, max(new))
    return best


def corpus():
    rng = random.Random(4)
    vocabulary = [f"word{k}" for k in range(3000)] + ["the", "of", "and"] * 200
    sentence = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [sentence(rng.randint(10, 40)) for _ in range(12)]
    docs = [sentence(rng.randint(0, 200)) for _ in range(60)]
    for k in range(40):
        copy = list(rng.choice(items))
        for _ in range(int(len(copy) * rng.choice([0, 0.1, 0.2, 0.3, 0.6]))):
            what = rng.random()
            at = rng.randrange(len(copy))
            copy[at : at + 1] = [rng.choice(vocabulary)] if what < 0.6 else [] if what < 0.8 and len(copy) > 2 else [copy[at], "new"]
        at = rng.randint(0, len(docs[k]))
        docs[k][at:at] = copy
    text = lambda x: rng.choice([" ", ", ", "\n"]).join(x).capitalize()
    return [(k, text(d)) for k, d in enumerate(docs)] + [(100, None), (101, "")], [(k, text(x)) for k, x in enumerate(items)] + [(50, None), (51, "")]


def test_align_is_smith_waterman():
    rng = random.Random(1)
    pairs = [([rng.randint(2, 9) for _ in range(rng.randint(1, 12))], [rng.randint(2, 9) for _ in range(rng.randint(1, 30))]) for _ in range(300)]
    scores, _ = align([np.array(a, np.uint64) for a, _ in pairs], [np.array(b, np.uint64) for _, b in pairs])
    assert scores.tolist() == [score(a, b) for a, b in pairs]


@pytest.mark.parametrize("block", [500_000, 60])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr("llm.decontamination.BLOCK_WORDS", block)
    docs, items = corpus()
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string")
    leaks = find_leaks(d, spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r for r in leaks.collect()}
    want = {}
    for i, t in docs:
        for k, x in items:
            if words(x) and (s := score(words(x), words(t)) / (2 * len(words(x)))) >= 0.5:
                want[i, k] = s
    assert got.keys() == want.keys() and len(want) > 20
    for key, r in got.items():
        assert r.score == pytest.approx(want[key])
        span = words(dict(docs)[r.doc_id][r.start : r.end])
        assert score(words(dict(items)[r.item_id]), span) / (2 * len(words(dict(items)[r.item_id]))) == pytest.approx(r.score)
    kept = {r.doc_id for r in without_leaking_texts(d, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert find_leaks(none[0], some[1]).collect() == find_leaks(some[0], none[1]).collect() == []
    assert [(r.doc_id, r.score) for r in find_leaks(*some).collect()] == [(1, 1.0)]


def test_rows_go_by_their_own_text(spark):
    """Null and shared ids: what leaks goes, what doesn't stays."""
    item = " ".join(f"rare{k}" for k in range(20))
    rows = [(None, f"before {item} after"), (None, "clean text"), (None, None), (7, item), (7, "clean too"), (8, ""), (9, "x " * 400_000 + item)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _digest string")
    docs = docs.withColumn("digest", F.lit(1)).withColumn("m", F.create_map(F.lit("a"), F.lit(1))).withColumn("a.b", F.lit(2))
    got = without_leaking_texts(docs, spark.createDataFrame([(1, item), (1, item), (None, None)], "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(i, t, "x", 1, {"a": 1}, 2) for i, t in [(None, "clean text"), (None, None), (7, "clean too"), (8, "")]], key=repr)


def test_ties(spark):
    """Two places with the same score: the first is told; both of two equal items are."""
    docs = spark.createDataFrame([(1, "one two three four. x y z q r s t u v w x one two three four.")], "doc_id long, text string")
    got = find_leaks(docs, spark.createDataFrame([(1, "one two three four"), (2, "one two three four")], "item_id long, text string")).collect()
    assert sorted((r.item_id, r.score, r.start, r.end) for r in got) == [(1, 1.0, 0, 18), (2, 1.0, 0, 18)]


def test_repetitive_items_and_texts():
    """A seed that an item holds many times is one hit for each place of the text."""
    import tracemalloc

    import pyarrow as pa

    from llm.decontamination import Seeds
    from llm.words import PUNCTUATION, Words

    def found(item, text):
        w = Words(pa.array([item]), PUNCTUATION)
        return Seeds([w.hashes], lambda x: np.ones(len(x)), 1e12).leaks(Words(pa.array([text]), PUNCTUATION), 0.5)

    assert found("ha " * 30, "x " * 50 + "ha " * 20 + "y") == [(0, 0, 20 / 30, 50, 69)]
    assert found("ha ho " * 9, "ho ha " * 9)[0][2] == 17 / 18
    tracemalloc.start()
    assert found("ha " * 1000, "ha " * 200_000) == [(0, 0, 1.0, 0, 999)]
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()


def test_repeated_benchmark_rows(spark, monkeypatch):
    """Each equal row of the benchmark gives rows, but is aligned once; few windows are held at a time."""
    monkeypatch.setattr("llm.decontamination.HITS", 3)
    docs = spark.createDataFrame([(1, "x y one two three four"), (1, "x y one two three four"), (2, "one two")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "one two three four")] * 3 + [(None, "one two three four"), (6, None)], "item_id long, text string")
    got = find_leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id is None, r.score) for r in got) == [(1, False, 1.0)] * 6 + [(1, True, 1.0)] * 2
