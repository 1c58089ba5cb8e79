"""op6 against brute force."""

import numpy as np
import pyarrow as pa
import pytest

from llm import embeddings
from llm.components import components
from llm.embeddings import collision_rule, near_vectors, table_rule


def brute(rows, cosine):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    links = [0] * len(rows)
    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            _, b, lb = rows[j]
            if la is not None and la == lb and ok(a) and ok(b) and len(a) == len(b):
                x, y = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted((r[0], links[i], least[find(i)], least[find(i)] == r[0]) for i, r in enumerate(rows))


def vectors(n, dim=24, groups=12, seed=1):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for g in range(groups):
        base = rng.normal(size=dim)
        for _ in range(n // groups):
            v = base + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.25, 0.4, 3.0])
            rows.append((k, [float(x) for x in v], int(g % 3)))
            k += 1
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("cell", [16_384, 24])
def test_against_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(embeddings, "CELL", cell)
    rows = vectors(240)
    rows += [(1000, None, 1), (1001, [0.0] * 24, 1), (1002, [float("nan")] * 24, 1), (1003, rows[0][1], None), (1004, rows[5][1], rows[5][2]), (1004, rows[5][1], rows[5][2]), (1005, [1.0, 2.0], 1), (1006, [2.0, 4.0], 1), (1007, [None, 1.0], 1), (1008, [], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in near_vectors(df).collect())
    want = brute(rows, 0.93)
    if cell > 24:
        assert got == want
    else:  # cells are cut: recall is what was asked for, and no link is made up
        assert sum(r[1] for r in got) >= 0.98 * sum(r[1] for r in want)
        assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_rules():
    width, least = collision_rule(0.93)
    assert 0.7 < width < 0.8 and 24 <= least <= 31
    assert table_rule(1000, 0.93) == (0, 1) and table_rule(2 * embeddings.CELL, 0.93) == (0, 1)
    cuts, tables = table_rule(1_000_000, 0.93)
    assert cuts >= 5 and tables > 10


def test_empty(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("kind", ["array<double>", "array<int>", "array<decimal(10,3)>"])
def test_number_types(spark, kind):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [2.0, 4.0, 6.0], 1), (3, [3.0, 2.0, -1.0], 1), (3, None, 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id", f"cast(embedding as {kind}) as embedding", "label", "'x' as cls")
    assert sorted(map(tuple, near_vectors(df).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (3, 0, 3, True)]


def planted(n, pairs, dim=64, seed=5):
    """n random unit vectors and, beside them, a partner with a cosine just over the threshold for some."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1)[:, None]
    other = rng.normal(size=(pairs, dim))
    other -= (other * v[:pairs]).sum(1)[:, None] * v[:pairs]
    other /= np.linalg.norm(other, axis=1)[:, None]
    c = rng.uniform(0.931, 0.94, pairs)[:, None]
    return np.concatenate([v, c * v[:pairs] + np.sqrt(1 - c * c) * other]).astype(np.float32)


def test_recall_of_a_label_that_is_cut(spark):
    """Production settings: one label of 40,000 vectors is cut into cells and tables; pairs just over the threshold are found."""
    n, pairs = 36_000, 4_000
    assert table_rule(n + pairs, 0.93)[0] >= 1
    x = planted(n, pairs)
    table = pa.table({"vec_id": np.arange(n + pairs), "embedding": pa.FixedSizeListArray.from_arrays(x.ravel(), 64).cast(pa.list_(pa.float32())), "label": np.zeros(n + pairs, np.int32)})
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(table)).where("n_links > 0").collect()}
    found = sum(n + k in got and got[n + k].component_id == k for k in range(pairs))
    assert found >= 0.995 * pairs


def test_pairs_of_a_tile():
    """All pairs of a tile, of one block and across two, and the components of what is left of them."""
    x = np.array([v for _, v, _ in vectors(600, groups=4)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.93, 1)))}
    for across in (0, 1, 250, 599):
        parts = list(embeddings.linked(x, across, 0.93))
        got = {(i, j) for a, b in parts for i, j in zip(a, b)}
        expected = {(i, j) for i, j in want if not across or i < across <= j}
        assert got <= expected and len(got) >= 0.99 * len(expected)
        i, j = (np.concatenate(y) for y in zip(*parts))
        fewer = [embeddings._spanning(a, b) for a, b in parts]
        assert (embeddings._roots(600, i, j) == embeddings._roots(600, *(np.concatenate(y) for y in zip(*fewer)))).all()


def test_components_of_hubs(spark):
    """Two stars of thousands of edges that share one leaf, a long path, and edges given twice."""
    edges = [(0, k) for k in range(10, 3000)] + [(1, k) for k in range(2999, 6000)] + [(k, k + 1) for k in range(7000, 7100)] + [(7100, 7100), (9, 9), (8000, 7999), (7999, 8000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{k: 0 for k in [0, 1, *range(10, 6000)]}, **{k: 7000 for k in range(7000, 7101)}, 8000: 7999, 7999: 7999}
    assert got == want
