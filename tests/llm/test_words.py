"""The word arrays against a regular expression, and hashes against equality of words."""

import random
import re

import pyarrow as pa

from llm.frames import slices
from llm.words import PUNCTUATION, WHITE, Words, shingles


def test_words_and_hashes():
    rng = random.Random(5)
    texts = ["".join(rng.choice("aAbB éÉ漢 \t\n\x0b.,-1\xa0") for _ in range(rng.randint(0, 60))) for _ in range(200)] + [None, "", " ", "x" * 3_000_000 + " y"]
    lower = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    for separators, pattern in ((WHITE, r"[^\x20\x09-\x0D]+"), (PUNCTUATION, r"(?:[0-9a-z]|[^\x00-\x7f])+")):
        w = Words(pa.array(texts), separators)
        seen = {}
        for k, text in enumerate(texts):
            want = re.findall(pattern, lower(text))
            got = w.hashes[w.at[k] : w.at[k + 1]].tolist()
            assert len(got) == len(want)
            for word, h in zip(want, got):
                assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


def test_sliced_input_and_no_rows():
    column = pa.array(["a b", "c", None, "d e f"]).slice(1)
    assert len(Words(column).hashes) == 4
    assert len(Words(pa.array([], pa.string()))) == 0


def test_shingles():
    h = Words(pa.array(["a b a b a b c"])).hashes
    assert len(shingles(h, 2)) == 3 and len(shingles(h[:1], 4)) == 1 and len(shingles(h[:0], 4)) == 0


def test_slices_are_bounded_and_whole():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["x" * 10, None, "y" * 50, "", "z" * 5, "w"])], ["id", "text"])
    parts = list(slices(iter([batch]), limit=12))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == list(range(6))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 12 for p in parts)
