"""op13 against all pairs."""

import math

import numpy as np
import pytest

from llm import hard_negatives
from llm.hard_negatives import LIMIT, Approximation

SCHEMA = "vec_id long, embedding array<double>, label int, row string, score int, i int"


def brute(rows):
    kept = []
    for at, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) or abs(256 * x) >= LIMIT for x in v):
            continue
        kept.append((at, i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for at, i, q, label in kept:
        if i is None or i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, w)), j is None, j or 0, k, l == label) for k, j, w, l in kept if k != at and len(w) == len(q))
        for s, gone, p, _, _ in [r for r in scored if r[4]][:5]:
            inside = [r for r in scored if not r[4] and 30 * -s <= 100 * -r[0] <= 90 * -s][:10]
            out += [(i, None if gone else p, n + 1, None if r[1] else r[2], -s, -r[0]) for n, r in enumerate(inside)]
    return sorted(out, key=repr)


def vectors(n, dim=16, seed=1, step=7):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    return [(k * step % n if step else k, [float(x) for x in centres[k % 5] * rng.choice([0.3, 1.0]) + rng.normal(size=dim) * 0.6], int(k % 4)) for k in range(n)]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    out = hard_negatives.hard_negatives(df)
    assert [t for _, t in out.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("size, anchors, at_once", [(16_384, 1024, 128), (120, 3, 2)])
def test_against_all_pairs(spark, monkeypatch, size, anchors, at_once):
    for name, value in {"ROWS": size, "ANCHORS": anchors, "AT_ONCE": at_once}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(901, step=7)
    hot = rows[0][1]
    rows += [(2000 + k, hot, k % 2) for k in range(300)]  # one vector holds a quarter of the rows: ties go by id
    rows += [(100, rows[4][1], 2), (100, rows[4][1], 2), (None, rows[8][1], 1), (None, rows[9][1], 2)]  # repeated and null ids
    rows += [(3000, None, 1), (3100, hot, None), (3200, [float("nan")] + hot[1:], 1), (3300, [None] + hot[1:], 1), (3400, [1e300] + hot[1:], 1)]
    rows += [(4000, [], 1), (4001, [], 1), (4002, [], 2), (5000, [1.0, 2.0], 3), (5001, [1.0, 2.5], 3), (5002, [0.7, 0.5], 1), (6000, [0.0] * 16, 6), (6001, hot, 6)]
    got = run(spark, rows)
    assert got == brute(rows) and len(got) > 300


def test_edges(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [0.5], 2)]) == []  # no anchor
    assert run(spark, [(100, [1.0], 1), (2, [0.5], 2)]) == []  # no positive
    assert run(spark, [(100, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]) == []  # a negative score leaves no window
    # The window's ends belong to it: scores 30 and 90 of 100, not 29 or 91.
    rows = [(100, [10 / 256], 1), (1, [10 / 256], 1)] + [(k, [x / 256], 2) for k, x in [(2, 2), (3, 3), (4, 9), (5, 10)]]
    assert run(spark, rows) == [(100, 1, 1, 4, 100, 90), (100, 1, 2, 3, 100, 30)] == brute(rows)


def test_bounds_hold_and_are_close():
    rng = np.random.default_rng(2)
    q = rng.normal(size=(4000, 64)).round(2) * 32
    file, anchors = Approximation(q.astype(np.int64)), (rng.normal(size=(5, 64)) * 32).astype(np.int64)
    lower, upper = file.bounds(anchors)
    exact = q.astype(np.int64) @ anchors.T
    assert (lower <= exact).all() and (exact <= upper).all()
    assert (upper - lower).mean() < exact.std()
    large = rng.integers(-LIMIT + 1, LIMIT, (300, 64))
    file = Approximation(large)
    lower, upper = file.bounds(large[:3])
    i, j = np.nonzero(np.ones((300, 3), bool))
    exact = np.array([sum(int(a) * int(b) for a, b in zip(large[x], large[y])) for x, y in zip(i, j)])
    assert (file.exact(large[:3], i, j) == exact).all()
    assert (lower[i, j] <= exact).all() and (exact <= upper[i, j]).all()


def test_few_rows_are_scored_exactly():
    """What the bounds leave of rows that share nothing with the anchor but noise."""
    rng = np.random.default_rng(4)
    q = np.floor(rng.normal(size=(8000, 64)) * 32).astype(np.int64)
    lower, upper = Approximation(q).bounds(q[:20])
    left = (upper >= hard_negatives._threshold(lower, np.ones_like(lower, bool), 6)).mean()
    assert left < 0.02
