"""op9: held-out accuracy, located sentences, and rows without text."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from llm import toxicity
from llm.toxicity import bags, fit, noisy_or, score_documents, train, training_sample, without_toxic


def corpus(n, seed):
    rng = random.Random(seed)
    clean = [f"{a}{b}" for a in ("th", "er", "on", "in", "ti") for b in ("ing", "ed", "ly", "and", "es", "or")]
    rows = []
    for _ in range(n):
        sentences = [" ".join(rng.choice(clean) for _ in range(rng.randint(8, 14))) + "." for _ in range(rng.randint(1, 25))]
        y = int(rng.random() < 0.3)
        if y:
            k = rng.randrange(len(sentences))
            sentences[k] = sentences[k].replace(" ", rng.choice([" vilething ", " scumword ", f" lowei{rng.choice(clean)} "]), 1)
        rows.append((" ".join(sentences), y))
    return rows


def test_learns_documents_and_locates_sentences():
    rows, held = corpus(800, 1), corpus(300, 2)
    m = train(pa.array([t for t, _ in rows]), np.array([y for _, y in rows]))
    b = bags(pa.array([t for t, _ in held]))
    z = m.sentence_logits(b)
    score = noisy_or(z, b.documents)
    assert np.mean((score >= 0.5) == [y for _, y in held]) > 0.97
    hot = np.flatnonzero(z >= 0)
    words = [b.words.data[b.words.starts[b.sentences[s]] : b.words.ends[(list(b.sentences[1:]) + [len(b.words.starts)])[s] - 1]].tobytes().decode() for s in hot]
    assert len(words) and np.mean([any(w in x for w in ("vilething", "scumword", "lowei")) for x in words]) > 0.95


def test_noisy_or():
    z = np.array([0.0, 0.0, -50.0, -5.0])
    leak = np.exp(toxicity.LEAK)
    assert noisy_or(z, np.array([0, 2, 3, 4, 4])) == pytest.approx([1 - 0.25 * leak, 1 - 1 / leak, 1 - 1 / leak, 1 - 1 / leak])
    assert noisy_or(np.full(100_000, -5.0), np.array([0, 100_000])) < 0.01  # length alone


def brute(text, weights):
    """Sentences, features and noisy-or word by word."""
    data = (text or "").encode()
    found = [(m.start(), m.end()) for m in re.finditer(rb"(?:[A-Za-z0-9]|[\x80-\xff])+", data)]
    sentences, block = [], None
    for k, (a, b) in enumerate(found):
        if not k or any(c in b".!?\n" for c in data[found[k - 1][1] : a]):
            if k // 8 != block:  # the first end in each eight words
                sentences.append([])
            block = k // 8
        sentences[-1].append(data[a:b])
    total = toxicity.LEAK
    for words in sentences:
        z = toxicity.NEUTRAL
        for w in {x.lower(): x for x in words}.values():
            z += weights[bags(pa.array([w.decode()])).features[0]].sum() if w.isascii() else 0
        total += max(math.log1p(math.exp(z)) - math.log1p(math.exp(toxicity.NEUTRAL)), 0)
    return 1 - math.exp(-total)


def test_scores_against_brute_force(spark):
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "vilething", "Delta", "eps"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", ". ", "! ", "\n", ", "]) for _ in range(rng.randint(0, 60))) for _ in range(200)] + [None, "", "?!"]
    model = toxicity.Model(np.random.default_rng(0).normal(0, 1.2, 1 << 20).astype(np.float32))
    got = {r.doc_id: r for r in score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for k, t in enumerate(texts):
        assert got[k].score == pytest.approx(brute(t, model.weights), abs=1e-6), t


def test_gradient_is_that_of_the_scored_function(monkeypatch):
    """One step of training moves the loss of what is scored down, from the start and from anywhere else."""
    rows = corpus(200, 4)
    column, y = pa.array([t for t, _ in rows]), np.array([y for _, y in rows])
    b = bags(column)
    loss = lambda m: -np.mean(np.log(np.where(y == 1, p := noisy_or(m.sentence_logits(b), b.documents), 1 - p)))
    monkeypatch.setattr(toxicity, "STEPS", 0)
    losses = [loss(toxicity.Model(np.zeros(1 << 20, np.float32))), *(loss(train(column, y, epochs=k)) for k in (4, 8, 16))]
    assert losses[0] > losses[1] > losses[2] > losses[3] and losses[3] < 0.15


def test_repeated_and_null_ids(spark, monkeypatch):
    """An id that many rows share takes its part of the bound; null ids are neither held out nor trained on."""
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    rows = [(ids[0], f"text number {k}") for k in range(500)] + [(ids[0], "same")] * 50 + [(i, "other text") for i in ids[1:40]] + [(None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 1) for i in ids[:40]] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 100)
    sample = training_sample(docs, labels).collect()
    assert len(sample) == 100 and len({(r.doc_id, r.text) for r in sample}) == 100 and all(r.doc_id is not None for r in sample)
    got = score_documents(docs, train(pa.array(["a"]), np.array([1]))).where("doc_id is null").collect()
    assert [r.held_out for r in got] == [False, False] and got[0].score < 0.01


def test_rows(spark):
    rows = [(i, t, y) for i, (t, y) in enumerate(corpus(400, 3))]
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if i % 4] + [(5, 1, None), (99_999, 1, 1)], "doc_id long, quality int, toxic int")
    extra = [(1000, None), (1001, ""), (1002, "?!"), (1003, "vilething scumword. " * 3), (1003, "vilething scumword. " * 3), (1004, "thing andly " * 30_000)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(*r, "x") for r in extra], "doc_id long, text string, score string")
    model = fit(docs, labels)
    got = score_documents(docs, model).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows) + 6 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert by_id[1000].score == by_id[1001].score == by_id[1002].score < 0.01 and by_id[1003].predicted == 1 and by_id[1003].offending and by_id[1004].predicted == 0
    assert {r.doc_id for r in without_toxic(docs, model).collect()} == {r.doc_id for r in got if not r.predicted}


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert score_documents(docs, model).first().score < 0.01
    assert score_documents(docs.limit(0), model).collect() == []


def test_whole_texts_are_trained_on(spark, monkeypatch):
    """Long documents whose offending sentence comes last; and a class ends where its bytes are full."""
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    filler = "thing andly tion ering. " * 2200
    rows = [(i, filler + ("vilething scumword here." if i % 2 else "thing here."), i % 2) for i in ids[:40]]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    sample = {r.doc_id: r.text for r in training_sample(docs, labels).collect()}
    assert sample == {i: t for i, t, _ in rows}
    got = score_documents(docs, fit(docs, labels)).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
    monkeypatch.setattr(toxicity, "MAX_BYTES", 3 * len(filler))
    few = training_sample(docs, labels).groupBy("toxic").count().collect()
    assert {r.toxic: r["count"] for r in few} == {0: 3, 1: 3}
