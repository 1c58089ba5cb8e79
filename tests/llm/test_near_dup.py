"""op5 against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from llm import near_dup
from llm.near_dup import near_duplicates, one_of_each

SCHEMA = "doc_id long, text string, cls string"


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def brute(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)], least[find(i)] == d) for i, (d, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = [(900, None), (901, ""), (902, " \t\n"), (903, "a b"), (904, "A  b"), (905, "a b c é"), (906, "a b c É")]
    k = 0
    for n_copies in [1] * 60 + [2] * 20 + [6] * 6 + [90]:
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 30, 60, 150]))]
        for _ in range(n_copies):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((k, rng.choice([" ", "\n", "  "]).join(words)))
            k += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("node, levels", [(512, 10), (8, 3)])
def test_against_brute_force(spark, monkeypatch, node, levels):
    monkeypatch.setattr(near_dup, "NODE", node)
    monkeypatch.setattr(near_dup, "LEVELS", levels)
    rows = corpus(3)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert sorted(tuple(r) for r in near_duplicates(df, 4, 80).collect()) == brute(rows, 4, 80)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rows_that_share_an_id_but_no_text(spark):
    text = lambda k, n=40: " ".join(f"{k}w{i}" for i in range(n))
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (None, text("c") + " end"), (None, None), (None, ""), (2, text("c")), (3, text("d")), (7, text("d") + " more"), (7, text("zz")), (7, text("e")), (8, text("f")), (8, text("f")), (9, text("e") + " too"), (5, None), (5, None)]
    got = one_of_each(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA))
    want = [(None, text("a")), (None, text("b")), (None, None), (None, ""), (2, text("c")), (3, text("d")), (7, text("zz")), (7, text("e")), (8, text("f")), (5, None)]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr) and got.columns == ["doc_id", "text", "cls"]


def test_extra_columns_keep_their_names_and_values(spark):
    """Columns that are named as those within, and columns that can't be ordered; of equal rows one stays."""
    rows = [(1, "a b c d e f", "k1", {"x": 1}, ("s", 2)), (1, "a b c d e f", "k1", {"x": 1}, ("s", 2)), (1, "a b c d e f", "k0", {"x": 9}, ("s", 2)), (2, "a b c d e f", "k2", None, None), (3, "g h", None, {}, ("t", None))]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string, cls map<string,int>, row struct<p:string,_lost:int>").selectExpr("*", "1 as `key`", "2 as lost", "3 as `_rank`", "4 as `_place`", "5 as `a.b`")
    got = one_of_each(df)
    assert got.columns == df.columns and got.schema.simpleString() == df.schema.simpleString()
    assert sorted((r.doc_id, r._key, r.cls, r["row"] and tuple(r["row"]), r.key, r.lost, r["a.b"]) for r in got.collect()) == [(1, "k0", {"x": 9}, ("s", 2), 1, 2, 5), (3, None, {}, ("t", None), 1, 2, 5)]


@pytest.mark.parametrize("members", [1, 200, 2000])
def test_groups_whose_sets_are_cut_into_blocks(spark, monkeypatch, members):
    monkeypatch.setattr(near_dup, "SET_MEMBERS", members)
    monkeypatch.setattr(near_dup, "GROUP_BYTES", 1 << 12)
    rows = corpus(4)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert sorted(tuple(r) for r in near_duplicates(df, 4, 80).collect()) == brute(rows, 4, 80)


def test_blocks_hold_every_pair():
    for sizes in ([5], [5, 5], [1] * 30, [50, 1, 1, 50, 3, 3, 3]):
        near_dup_members, near_dup.SET_MEMBERS = near_dup.SET_MEMBERS, 10
        try:
            parts = near_dup._parts(np.array(sizes))
        finally:
            near_dup.SET_MEMBERS = near_dup_members
        assert {(i, j) for p in parts for i in p for j in p} == {(i, j) for i in range(len(sizes)) for j in range(len(sizes))}
        assert all(sum(sizes[k] for k in p) <= 20 or len(p) <= 2 or max(sizes) > 10 for p in parts)


def test_very_long_texts(spark):
    """A million words, a copy of it with a word changed, one word a million times, and one word of a million letters twice."""
    words = [f"w{k % 99_991}x{k % 7}" for k in range(400_000)]
    other = [*words[:-1], "changed"]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, "same " * 400_000), (4, "y" * 1_000_000), (5, "Y" * 1_000_000), (6, "y" * 999_999)]
    got = sorted(tuple(r)[0:1] + tuple(r)[2:] for r in near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), 5, 80).collect())
    assert got == [(1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True)]
