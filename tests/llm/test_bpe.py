"""op4 against tiktoken, and exact round trips."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import tiktoken

from llm.bpe import Encoder, encode_documents, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def reference():
    with open(PATH, "rb") as f:
        ranks = read_ranks(f.read())
    return ranks, tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [None, "", " ", "a", "it's 12  words\n\n", "é漢字🙂 ß", "<|endoftext|>", "a" * 5000, "ab" * 4000, "\x00\x01", "same", "same", "naïve " * 300]


def test_documents(spark):
    _, library = reference()
    rng = random.Random(7)
    texts = TEXTS + ["".join(rng.choice("abAB éßñ12 \n\t!?漢字🙂'stre") for _ in range(rng.randint(0, 300))) for _ in range(150)]
    docs = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(texts)], "doc_id long, text string, ids array<int>")
    rows = {r.doc_id: r for r in encode_documents(docs, PATH, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        assert rows[i].ids == ids and rows[i].n_tokens == len(ids) and rows[i].exact
        assert rows[i].ids_sha256 == hashlib.sha256(b"".join(struct.pack("<I", x) for x in ids)).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_cache_bounds(monkeypatch):
    ranks, library = reference()
    monkeypatch.setattr(Encoder, "CACHED_PIECES", 3)
    e = Encoder(ranks, public_tokenizers.PATTERN)
    for t in ("one two three four five six seven", "one two eight nine ten eleven", "word" * 40):
        assert list(struct.unpack(f"<{len(e.encode(t)) // 4}I", e.encode(t))) == library.encode_ordinary(t)
    assert len(e.packed) <= 3


def test_lowest_rank_made_by_a_merge_comes_next():
    """A merge may give a pair of lower rank than those that wait."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"abc": 260, b"xy": 301, b"cx": 299}
    library = tiktoken.Encoding("t", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    e = Encoder(ranks, r"\S+")
    for t in ("abcxy", "abcabcxy", "bcbcbc", "aabcxyxy"):
        packed = e.encode(t)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == library.encode_ordinary(t)


def test_empty(spark):
    assert encode_documents(spark.createDataFrame([], "doc_id long, text string"), PATH, public_tokenizers.PATTERN).collect() == []


def test_ids_of_any_type(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    for kind in ("short", "int", "long", "decimal(20,0)", "string", "date", "binary", "struct<a:int,b:string>"):
        value = {"date": "date '2020-01-02'", "struct<a:int,b:string>": "named_struct('a', 1, 'b', 'x')"}.get(kind, f"cast('7' as {'binary' if kind == 'binary' else kind})")
        docs = spark.sql(f"select {value} as doc_id, 'some text' as text union all select null, null")
        got = encode_documents(docs, path, public_tokenizers.PATTERN).collect()
        assert sorted(r.n_tokens > 0 for r in got) == [False, True] and got[0].asDict().keys() >= {"doc_id", "ids"}


def test_megabytes_of_one_piece():
    """Very long pre-tokens against the library, in time that grows little faster than their length."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = read_ranks(f.read())
    own = Encoder(ranks, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    letters = "".join(rng.choice("etaoinshrdlucmfwyp") for _ in range(200_000))
    assert np.frombuffer(own.encode(letters), "<u4").tolist() == library.encode_ordinary(letters)
    for text in ("a" * 1_000_000, " " * 1_000_000, "\n" * 1_000_000, "=" * 1_000_000):
        assert own.decode(own.encode(text)) == text.encode()
