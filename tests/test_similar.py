"""Like titles against all pairs of a year."""

import itertools
import random
import re
import unicodedata
from difflib import SequenceMatcher

import numpy as np
import pytest

from lorekeeper.operators import similar

SCHEMA = "id long, title string, year int"
STOP = {"a", "an", "and", "in", "of", "on", "the", "to"}


def plain(title):
    text = unicodedata.normalize("NFKC", title or "").translate(str.maketrans("‘’“”–—−", "''\"\"---"))
    return " ".join(text.casefold().split())


def brute(rows, threshold=0.9):
    """All pairs in the order of ids, with their scores."""
    out = {}
    rows = sorted({(i, plain(t), y) for i, t, y in rows if i is not None and plain(t)}, key=lambda r: (r[0], r[1]))
    for (i, a, y), (j, b, z) in itertools.combinations(rows, 2):
        if y != z or i == j:
            continue
        ta, tb = (set(re.findall("[a-z0-9]+", x)) - STOP for x in (a, b))
        score = max(SequenceMatcher(None, a, b).ratio(), len(ta & tb) / len(ta | tb) if ta and tb else 0.0)
        if score >= threshold:
            out[i, j] = round(score, 9)
    return out


def expanded(rows, found, threshold=0.9):
    """What the class rows say about every pair of ids."""
    members = {}
    by_title = {}
    for i, t, y in rows:
        if i is not None and plain(t):
            by_title.setdefault((plain(t), y), set()).add(i)
    for ids in by_title.values():
        members[min(ids)] = ids
    out = {}
    for ids in members.values():
        out |= {p: 1.0 for p in itertools.combinations(sorted(ids), 2)}
    for left, right, score, reverse in found:
        if left in members and right in members:
            for x, y in itertools.product(members[left], members[right]):
                s = score if x < y else reverse
                if s >= threshold:
                    out[min(x, y), max(x, y)] = round(s, 9)
    return out


def run(spark, rows, threshold=0.9):
    found = [tuple(r) for r in similar.near_titles(spark.createDataFrame(rows, SCHEMA), threshold).collect()]
    assert len(found) == len({f[:2] for f in found})
    return found


def random_titles(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n // 4):
        base = " ".join(rng.choice(["yowie", "seen", "near", "the", "bega", "hairy", "man", "bush", f"w{k}"]) for _ in range(rng.randint(1, 24)))
        year = rng.choice([None, 1990, 1991])
        for _ in range(3):
            at = rng.randrange(len(base))
            rows.append((rng.randrange(10**6), base[:at] + rng.choice(["", "x", base[at]]) + base[at + 1 :], year))
        words = base.split()
        rng.shuffle(words)
        rows.append((rng.randrange(10**6), " ".join(words).upper(), year))
    return rows


@pytest.mark.parametrize("tile, threshold", [(4096, 0.9), (25, 0.9), (25, 0.75), (4096, 1.0)])
def test_random_titles(spark, monkeypatch, tile, threshold):
    monkeypatch.setattr(similar, "TILE", tile)
    rows = random_titles(240, seed=5)
    rows += [(7, "Yowie seen by Bulahdelah", 1990), (8, "Yowie seen by Bulahdela", 1990), (9, "a “big” yowie—near bega", 1990), (10, 'A "big" yowie-near Bega', 1990)]
    rows += [(11, None, 1990), (12, "  ", 1990), (None, "Yowie seen by Bulahdelah", 1990), (13, "x" * 300 + "abc", None), (14, "x" * 298 + "abd", None), (15, "\U0001f47b ghost", 1), (16, "\U0001f47b ghosts", 1)]
    got = expanded(rows, run(spark, rows, threshold), threshold)
    assert got == brute(rows, threshold) and len(got) > 40


def test_templated_titles(spark):
    rng = random.Random(3)
    names = ["".join(rng.choice("abdeghilmnorstu") for _ in range(rng.randint(3, 9))) for _ in range(40)]
    rows = [(k, f"Report {k % 37} of the hairy man of {rng.choice(names)} creek, seen by {rng.choice(names)}", 1900 + k % 2) for k in range(420)]
    rows += [(1000 + k, f"{rng.choice(names)} {rng.choice(names)}", 1900) for k in range(80)]
    assert expanded(rows, run(spark, rows)) == brute(rows)


def test_copies_are_one_class(spark):
    """The order of a pair matters to its score, and copies make both orders occur."""
    rows = [(1, "Strange hairy man in bush", None), (2, "A strange hairy man in the bush", None), (3, "Strange hairy man in bush", None), (3, "Strange hairy man in bush", None), (4, "Strange hairy man in bush", 1990), (5, "tide", 1), (6, "diet", 1), (7, "tide", 1)]
    found = run(spark, rows)
    assert sorted(f[:2] for f in found) == [(1, 2), (1, 3), (5, 7)]
    assert expanded(rows, found) == brute(rows)
    assert {f[:2]: f[3] is None for f in found} == {(1, 2): False, (1, 3): True, (5, 7): True}


def test_many_copies_give_one_row_each(spark):
    rows = [(k, "The same title", 2000) for k in range(500)] + [(1000, "The same titles", 2000)]
    assert len(run(spark, rows)) == 500


def test_no_titles(spark):
    assert run(spark, []) == []


def test_common_length():
    rng = np.random.default_rng(1)
    titles = ["".join(rng.choice(list("abcdé"), rng.integers(1, 70))) for _ in range(60)] + ["a" * 64, "ab" * 32]
    left, right = (rng.integers(0, len(titles), 300) for _ in range(2))

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row
            row = [0]
            for k, y in enumerate(b):
                row.append(last[k] + 1 if x == y else max(last[k + 1], row[k]))
        return row[-1]

    for i, j, n in zip(left, right, similar.common_length(titles, left, right)):
        short = min(len(titles[i]), len(titles[j]))
        assert n == (lcs(titles[i], titles[j]) if short <= 64 else short)


def test_word_parts_meet():
    rng = random.Random(2)
    words = [f"w{k}" for k in range(60)]
    for _ in range(3000):
        a = set(rng.sample(words, rng.randint(1, 40)))
        b = set(a)
        for _ in range(rng.randint(0, 4)):
            b ^= {rng.choice(words)}
        if b and len(a & b) / len(a | b) >= 0.9:
            assert set(similar.word_parts(sorted(a), 0.9)) & set(similar.word_parts(sorted(b), 0.9))


def test_titles_are_described_once(spark):
    """Copies meet as they are written; what follows starts from the classes, so the driver's plan stays small."""
    rows = [(k, f"{' ' * (k % 3)}Title {k // 9}", 1990 + k % 2) for k in range(90)] + [(k, None, 1990) for k in range(3)]
    found = similar.near_titles(spark.createDataFrame(rows, SCHEMA))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") <= 3
    assert expanded(rows, [tuple(r) for r in found.collect()]) == brute(rows)
