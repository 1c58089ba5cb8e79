"""op7 against a brute-force allocation by tiktoken's own tokens."""

import public_tokenizers
import pytest
import tiktoken

from llm.bpe import read_ranks
from llm.token_counts import Tokenizer, count_by_document, count_by_section

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = ["", None, "one line", "a\nb\n\nc", "\n\n\n", "é\nüü 漢字\n🙂 end\n", "x  \n\n  y\n", "tail\n", "same", "same", "word " * 3000 + "\n" + "y" * 5000]


def brute(text, rule):
    text = text or ""
    with open(PATH, "rb") as f:
        encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(f.read()), special_tokens={})
    lines = text.splitlines(keepends=True) if text else [""]
    assert all(x.count("\n") <= 1 for x in lines)
    at, spans = 0, []
    for line in lines:
        spans.append((at, at + len(line.encode())))
        at = spans[-1][1]
    counts, crossing, at = [0] * len(spans), [0] * len(spans), 0
    for t in encoding.encode_ordinary(text):
        end = at + len(encoding.decode_single_token_bytes(t))
        held = [max(0, min(end, b) - max(at, a)) for a, b in spans]
        k = next(i for i, h in enumerate(held) if h) if rule == "start" else held.index(max(held))
        counts[k] += 1
        crossing[k] += sum(h > 0 for h in held) > 1
        at = end
    chars = lambda b: len(text.encode()[:b].decode())
    return [(i, chars(a), chars(b), counts[i], crossing[i]) for i, (a, b) in enumerate(spans)]


@pytest.mark.parametrize("rule", ["start", "majority"])
def test_sections(spark, rule):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens string")
    out = count_by_section(docs, PATH, public_tokenizers.PATTERN, rule)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[1:])
    assert {i: sorted(x) for i, x in got.items()} == {i: brute(t, rule) for i, t in enumerate(TEXTS)}
    totals = {r.doc_id: r.n_tokens for r in count_by_document(out).collect()}
    assert totals[0] == 0 and totals[8] == totals[9] > 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert count_by_section(docs, PATH, public_tokenizers.PATTERN).collect() == []


def test_runs_that_the_library_cannot_match(spark):
    """A million spaces, line ends and letters; near the bounds both encoders give the same ids."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = [" " * 1_000_000, "\n" * 1_000_000, "x" * 1_000_000, "a" + " " * 1_000_000 + "b", "\t \n" * 300_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in count_by_document(count_by_section(docs, path, public_tokenizers.PATTERN)).collect()}
    assert len(got) == 5 and all(r.n_tokens > 0 for r in got.values()) and got[1].n_sections == 1_000_000
    with open(path, "rb") as f:
        t = Tokenizer(f.read(), public_tokenizers.PATTERN)
    for text in ("a" + " " * 4095 + "b", "a" + " " * 4096 + "b", " \n" * 3000 + "c", "ab" * 40_000):
        assert t.ids(text).tolist() == t.library.encode_ordinary(text)
