"""op8: base scores and counts against brute force, normalised probabilities, and gain on held-out texts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm import language_model as lm
from llm.words import Words

SCHEMA = "doc_id long, text string, score string"


def corpus():
    rng = random.Random(2)
    languages = [[f"{''.join(rng.choice(letters) for _ in range(rng.randint(1, 6)))}" for _ in range(300)] for letters in ("abcde", "mnopq", "vwxyz")]
    rows = []
    for k in range(300):
        words = rng.choice(languages)
        rows.append((k, " ".join(rng.choice(words[: rng.choice([20, 300])]) for _ in range(rng.randint(0, 120)))))
    return rows + [(1001, None), (1002, ""), (1003, "Same TEXT"), (1003, "Same TEXT")]


def brute(rows):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + [None]
    out = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, t in rows if not out(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    return sorted((i, out(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t)), 6)) for i, t in rows)


@pytest.mark.parametrize("common", [1 << 20, 50])
def test_scores(spark, monkeypatch, common):
    monkeypatch.setattr(lm, "COMMON", common)
    rows = corpus()
    got = lm.score_documents(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(2, "doc_id")).collect()
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == brute(rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_are_normalised():
    """Over all outputs, and within a class over its words and the unknown one."""
    rng = np.random.default_rng(0)
    v = lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0), 10, 5, rng.integers(0, 50, lm.OUTPUTS), np.zeros(lm.CLASSES, np.int64))
    p = lm.fresh(v)
    w = Words(pa.array(["a b c d e f"], pa.large_string()))
    t = lm.tokens(w, v)
    total = np.zeros(len(t.outputs))
    for y in range(lm.OUTPUTS):
        z = lm.Context(p, t, 0, len(t.outputs)).h @ p["t"].T + p["b"]
        total += np.exp(z[:, y] - np.log(np.exp(z).sum(1)))
    assert total == pytest.approx(1)
    assert lm.log_probabilities(p, t) == pytest.approx([z[k, y] - math.log(np.exp(z[k]).sum()) for k, y in enumerate(t.outputs)], abs=1e-4)


def test_gradients():
    rng = np.random.default_rng(3)
    v = lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0), 10, 5, rng.integers(1, 50, lm.OUTPUTS), np.zeros(lm.CLASSES, np.int64))
    p = {k: x.astype(np.float64) for k, x in lm.fresh(v).items()}
    t = lm.tokens(Words(pa.array(["a b c d e f " * 5, "x y z"], pa.large_string())), v)
    n = len(t.outputs)
    out = rng.normal(size=(n, lm.DIM))
    dq, dc = lm.Context(p, t, 0, n).gradients(p, out)
    for name, g in (("q", dq), ("c", dc)):
        for _ in range(6):
            at = tuple(rng.integers(s) for s in p[name].shape)
            at = (t.outputs[3], at[1]) if name == "q" else at
            value = []
            for e in (1e-2, -1e-2):
                p[name][at] += e
                value.append((lm.Context(p, t, 0, n).h * out).sum())
                p[name][at] -= e
            assert g[at] == pytest.approx((value[0] - value[1]) / 2e-2, rel=1e-2, abs=1e-3)


def test_empty(spark):
    assert lm.score_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_contexts_of_words_outside_the_outputs(spark):
    """Words of one class and like counts: only vectors of their own tell the pairs that go together from others."""
    rng = random.Random(4)
    name = lambda side, i: f"{side}{i}xx"
    text = lambda pairs: " ".join(f"{name('a', i)} {name('b', j)}" for i, j in pairs)
    frequent, others = range(100), range(100, 160)
    rows = [(k, text([(i, i) for i in rng.choices([*frequent] * 3 + [*others], k=60)])) for k in range(1500)]
    ids = [i for i in range(10_000, 20_000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    right = [(i, text([(x, x) for x in rng.sample(others, 30)])) for i in ids]
    away = [i for i in range(20_000, 40_000) if zlib.crc32(str(i).encode()) % 10 == 0]
    wrong = [(i, " ".join(w[0] + str((int(w[1:-2]) - 100 + 7 * (w[0] == "b")) % 60 + 100) + "xx" for w in t.split())) for i, (_, t) in zip(away, right)]
    got = {r.doc_id: r for r in lm.score_documents(spark.createDataFrame([(*r, "x") for r in rows + right + wrong], SCHEMA).coalesce(1)).collect()}
    mean = lambda some: np.mean([got[i].score - got[i].base_score for i, _ in some]) / 60
    assert all(got[i].held_out for i, _ in right + wrong) and mean(right) > mean(wrong) + 0.1


def test_leaves_of_a_class_add_up_to_one():
    rng = np.random.default_rng(1)
    classes, counts = rng.integers(0, 5, 400), rng.integers(1, 1000, 400)
    rest = np.full(lm.CLASSES, 0.1)
    tree = lm.tree(np.arange(lm.CLASSES, lm.CLASSES + 400), classes, counts, rest)
    v = lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0), 10, 5, rng.integers(1, 50, lm.OUTPUTS), np.zeros(lm.CLASSES, np.int64), tree)
    p = lm.fresh(v)
    at_start = lm.paths(p, leaves_as_tokens(tree), 0, np.zeros((tree.n, lm.DIM)))
    share = np.exp(-np.bincount(at_start.rows, np.logaddexp(0, np.where(at_start.left, -at_start.z, at_start.z)), tree.n))
    weight, leaf_class = np.concatenate([rest, counts + 0.1]), np.concatenate([np.arange(lm.CLASSES), classes])
    assert share == pytest.approx(weight / np.bincount(leaf_class, weight)[leaf_class], rel=1e-4)  # the counts' shares
    p["u"] += rng.normal(size=p["u"].shape)
    way = lm.paths(p, leaves_as_tokens(tree), 0, np.tile(rng.normal(size=lm.DIM), (tree.n, 1)))
    share = np.exp(-np.bincount(way.rows, np.logaddexp(0, np.where(way.left, -way.z, way.z)), tree.n))
    assert np.bincount(leaf_class, share) == pytest.approx(1)


def leaves_as_tokens(tree):
    none = np.zeros(0, np.int64)
    return lm.Tokens(none, none, none, none, none, np.arange(tree.n), none, none, tree)


@pytest.mark.parametrize("common", [1 << 20, 50, 4])
def test_every_word_has_its_share(spark, monkeypatch, common):
    """After two contexts, the probabilities of all words, of one unknown word of each class and of the end add up to one."""
    monkeypatch.setattr(lm, "COMMON", common)
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choice([f"word{rng.randrange(600)}", f"w{rng.randrange(100)}q", "the"]) for _ in range(40))) for k in range(120)]
    docs = spark.createDataFrame([(False, t) for _, t in rows], "held_out boolean, text string")
    counts = lm.stored(lm.word_counts(docs), "counts")
    v = lm.vocabulary(counts)
    p = lm.train(docs, v)
    c = Counter(w for _, t in rows for w in t.split())
    unknown = {}
    while len(unknown) < lm.CLASSES:
        x = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5))
        unknown.setdefault(int(lm.word_classes(Words(pa.array([x], pa.large_string())))[0]), x)
    for context in ("", "the word3 word77 w5q "):
        total = 0.0
        words = [*c, *unknown.values()]
        w = Words(pa.array([context + x for x in words], pa.large_string()))
        t = lm.tokens(w, v)
        last = t.bounds[1:] - 2
        log = lm.log_probabilities(p, t)[last] / math.log(10)
        at = w.at[1:] - 1
        rest = (t.classes[at] >= 0) & ~t.common[at]
        n = np.array([c[x] for x in words])
        total = np.sum(10 ** (log + np.where(rest, np.log10(n + 0.1) - v.tree.log_rest[t.classes[at]], 0)))
        end = lm.tokens(Words(pa.array([context], pa.large_string())), v)
        total += np.exp(lm.log_probabilities(p, end)[-1])
        assert total == pytest.approx(1, abs=2e-3)
        assert common > 4 or not rest.all()


def test_scores_add_up_from_their_tokens(spark):
    """score of whole texts against the model's own token probabilities, text by text."""
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).coalesce(1)
    got = sorted((r.doc_id, r.score) for r in lm.score_documents(docs).collect())
    from pyspark.sql import functions as F

    kept = docs.select(lm.held_out(F.col("doc_id")).alias("held_out"), "text")
    counts = lm.stored(lm.word_counts(kept), "counts")
    v = lm.vocabulary(counts)
    p, n_of = lm.train(kept, v), {r.h: r.n for r in counts.collect()}
    want = []
    for i, text in rows:
        w = Words(pa.array([text or ""], pa.large_string()))
        t = lm.tokens(w, v)
        score = lm.log_probabilities(p, t).sum() / math.log(10)
        for h, klass, common in zip(w.hashes.view(np.int64).tolist(), t.classes, t.common):
            score += 0 if klass < 0 or common else math.log10(n_of.get(h, 0) + 0.1) - v.tree.log_rest[klass]
        want.append((i, score))
    assert [i for i, _ in got] == [i for i, _ in sorted(want)] and [s for _, s in got] == pytest.approx([s for _, s in sorted(want)], rel=1e-4, abs=1e-3)


def test_very_long_texts(spark):
    rows = [(k, f"a{k} b c " * 20) for k in range(40)] + [(100, "word " * 300_000), (101, "x" * 1_000_000), (102, "\n" * 1_000_000)]
    got = {r.doc_id: r for r in lm.score_documents(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()}
    assert got[100].n_tokens == 300_001 and got[101].n_tokens == 2 and got[102].n_tokens == 1 and all(np.isfinite(r.score) for r in got.values())


@pytest.mark.parametrize("common", [1 << 20, 300])
def test_score_of_a_text_word_by_word(spark, monkeypatch, common):
    """The model's log-probability by plain loops over tokens, outputs and paths, from the trained parameters alone."""
    monkeypatch.setattr(lm, "COMMON", common)
    rows = [*corpus(), (2000, "never seen words"), (2001, "abc " * 40)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).coalesce(1)
    got = {r.doc_id: r.score for r in lm.score_documents(df).collect()}
    held = df.select(df.doc_id.alias("id"), lm.held_out(df.doc_id).alias("held_out"), "text")
    counted = lm.word_counts(held)
    count = {r.h: r.n for r in counted.collect()}
    v = lm.vocabulary(counted)
    p = {k: x.astype(float) for k, x in lm.train(held, v).items()}
    frequent, place = dict(zip(v.words.tolist(), v.outputs.tolist())), {h: k for k, h in enumerate(v.common.tolist())}
    for i, text in rows[::37] + rows[-6:]:
        w = Words(pa.array([text or ""], pa.large_string()))
        tokens, score = [], 0.0
        for h, c in zip(w.hashes.tolist(), lm.word_classes(w).tolist()):
            own = v.tree.of_common[place[h]] if h in place else c
            tokens.append((frequent[h], v.tree.n) if h in frequent else (lm.END + 1 + c, int(own)))
            if h not in frequent and h not in place:  # a share of its class's rest
                score += math.log10(count.get(int(np.uint64(h).view(np.int64)), 0) + 0.1) - v.tree.log_rest[c]
        tokens.append((lm.END, v.tree.n))
        vectors = [p["q"][y] + p["e"][leaf] for y, leaf in tokens]
        for k, (y, leaf) in enumerate(tokens):
            before = vectors[max(k - lm.MEAN, 0) : k]
            h = (sum(before) / len(before) if before else np.zeros(lm.DIM)) @ p["c"][lm.LAST]
            for back in range(lm.LAST):
                h = h + (vectors[k - 1 - back] if k > back else p["q"][lm.OUTPUTS]) @ p["c"][back]
            z = p["t"] @ h + p["b"]
            score += (z[y] - np.logaddexp.reduce(z)) / math.log(10)
            for at in range(v.tree.begins[leaf], v.tree.begins[leaf + 1]) if leaf < v.tree.n else ():
                node = p["u"][v.tree.nodes[at]]
                logit = node[: lm.STEER] @ h[: lm.STEER] + node[lm.STEER]
                score -= np.logaddexp(0, -logit if v.tree.left[at] else logit) / math.log(10)
        assert got[i] == pytest.approx(score, rel=2e-4, abs=2e-3), text


def test_paths_share_their_nodes():
    """Vectors are gathered once for each node of a tile, not for every step; scores and gradients are those of the single steps."""
    rng = np.random.default_rng(5)
    classes, counts = rng.integers(0, 7, 300), rng.integers(1, 1000, 300)
    tree = lm.tree(np.arange(lm.CLASSES, lm.CLASSES + 300), classes, counts, np.full(lm.CLASSES, 0.1))
    leaves, none = rng.choice(tree.n + 1, 900, p=np.r_[np.full(tree.n, 0.7 / tree.n), 0.3]), np.zeros(0, np.int64)
    t, p = lm.Tokens(none, none, none, none, none, leaves, none, none, tree), {"u": rng.normal(size=(len(tree.bias), lm.STEER + 1))}
    h = rng.normal(size=(900, lm.DIM + 1))
    h[:, lm.DIM] = 1
    way = lm.paths(p, t, 0, h)
    assert len(way.u) < 0.6 * len(way.z)
    told, nodes, made, times = way.gradients(d := rng.normal(size=len(way.z)))
    plain, most = np.zeros((900, lm.STEER + 1)), {}
    z, at = {}, 0
    for row in way.tokens:
        a, b = tree.begins[leaves[row]], tree.begins[leaves[row] + 1]
        for node, left in zip(tree.nodes[a:b][::-1], tree.left[a:b][::-1]):  # from the root down
            read = np.r_[h[row, : lm.STEER], 1]
            assert way.z[at] == pytest.approx(p["u"][node] @ read) and way.left[at] == left
            plain[row] += d[at] * p["u"][node]
            g, n = most.get(node, (0, 0))
            most[node] = g + d[at] * read, n + 1
            at += 1
    assert at == len(way.z) and sorted(way.tokens) == np.flatnonzero(leaves < tree.n).tolist()
    assert told == pytest.approx(plain[way.tokens])
    assert nodes.tolist() == sorted(most) and made == pytest.approx(np.stack([most[n][0] for n in nodes])) and times.tolist() == [most[n][1] for n in nodes]
    rows, _, s = lm.steps(p, t, 0, h)
    assert np.bincount(rows, s, 900) == pytest.approx(np.bincount(way.rows, way.z, 900))


def test_row_sums():
    rng = np.random.default_rng(6)
    rows, values = rng.zipf(1.5, 4000) % 500, rng.normal(size=(4000, 5))
    found, sums, n = lm.row_sums(rows, values)
    assert found.tolist() == sorted(set(rows.tolist())) and n.tolist() == np.bincount(rows)[found].tolist()
    assert sums == pytest.approx(np.stack([values[rows == r].sum(0) for r in found]))
