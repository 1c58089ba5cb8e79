"""op11 against a plain Lloyd over every vector."""

import hashlib
import math

import numpy as np

from llm.clustering import LIMIT, cluster, nearest

SCHEMA = "vec_id long, embedding array<double>, label int, cls string, degree int"


def plain(rows, k=8, rounds=10, scale=1024, dim=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) and abs(x * scale) < LIMIT for x in v)]
    hashed = lambda i: (i is None, "" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest())
    centroids = [q for _, q in sorted(kept, key=lambda r: (hashed(r[0]), r[1]))[:k]]
    assign = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(assign(q)[1], []).append(q)
        for n, qs in groups.items():
            centroids[n] = [sum(x) // len(qs) for x in zip(*qs)]
    told = [(i, *assign(q)[::-1]) for i, q in kept]
    own = {n: sum(d for _, m, d in told if m == n) for _, n, _ in told}
    name = lambda n: hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()
    return sorted((i is None, i or 0, n, d, own[n], sum(own.values()), name(n)) for i, n, d in told)


def rows(n, dim=64, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim))
    return [(i, [float(x) for x in centres[i % 9] + rng.normal(size=dim) * 0.5]) for i in range(n)]


def run(spark, data, **options):
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in data], SCHEMA)
    out = cluster(df, **options)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((r[0] is None, r[0] or 0, *r[1:]) for r in out.collect())


def test_against_plain_rounds(spark):
    data = rows(150)
    copy = data[4][1]
    data += [(1000 + i, copy) for i in range(200)]  # one vector holds most rows
    data += [(2, data[2][1]), (None, data[3][1]), (None, data[9][1])]  # repeated and null ids
    data += [(2000, None), (2001, []), (2002, copy[:63]), (2003, copy + [0.0]), (2004, [None] + copy[1:]), (2005, [float("nan")] + copy[1:]), (2006, [float("inf")] + copy[1:]), (2007, [1e300] + copy[1:])]
    assert run(spark, data) == plain(data)


def test_ties_empty_clusters_and_few_vectors(spark):
    same = [(i, [0.5] * 64) for i in range(12)]
    got = run(spark, same)
    assert got == plain(same) and {r[2] for r in got} == {0}
    few = rows(3)
    assert run(spark, few) == plain(few) and len({r[2] for r in run(spark, few)}) == 3
    # Halfway between two centroids, and means of negative numbers.
    line = [(i, [(-1) ** i * i / 1024 / 3] + [0.0] * 63) for i in range(40)]
    assert run(spark, line) == plain(line)


def test_no_vectors(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (2, [1.0])]) == []


def test_hot_classes_and_others_meet_their_assignment(spark, monkeypatch):
    import llm.components

    monkeypatch.setattr(llm.components, "HUB_DEGREE", 1)
    data = rows(60)
    data += [(100 + i, data[i % 3][1]) for i in range(30)]
    monkeypatch.setattr(llm.components, "HUBS", 60)
    assert run(spark, data) == plain(data)


def test_large_components_stay_exact():
    rng = np.random.default_rng(5)
    q, c = (rng.integers(-LIMIT + 1, LIMIT, (20, 64)) for _ in range(2))
    who, distance = nearest(q, c[:6])
    for v, w, d in zip(q, who, distance):
        assert (d, w) == min((sum((int(a) - int(b)) ** 2 for a, b in zip(v, x)), n) for n, x in enumerate(c[:6]))
