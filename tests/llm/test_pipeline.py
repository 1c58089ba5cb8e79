"""The pipeline on a small corpus: each stage against brute force on its own input, run() against the stages."""

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from llm.bpe import read_ranks
from llm.pii import Pseudonymiser
from llm.queries import PSEUDONYM_KEY
from llm.toxicity import fit, score_documents
from tests.llm.test_decontamination import corpus as leaking, score, words
from tests.llm.test_near_dup import brute as near_brute, corpus as copies
from tests.llm.test_toxicity import corpus as toxic

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs, labels = [], []
    for k, (t, y) in enumerate(toxic(300, 9)):
        docs.append((k, t))
        labels.append((k, 1, y))
    near = copies(6)
    docs += [(10_000 + i, t) for i, t in near]
    texts, items = leaking()
    docs += [(20_000 + i, t) for i, t in texts]
    docs += [(30_000, "card 4186133740741811 here"), (30_001, None), (30_002, ""), (30_003, "repeated row of words here"), (30_003, "repeated row of words here")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    final = []
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, folder)
        rows = out.collect()
        if name != "bpe":
            assert out.columns == COLUMNS and all(r.lang == "en" for r in rows)
        kept = sorted(r.doc_id for r in rows)
        if name == "toxicity":
            model = fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
            assert kept == sorted(r.doc_id for r in score_documents(docs, model).collect() if not r.predicted)
            assert 150 < sum(i < 10_000 for i in kept) < 290
        elif name == "near_dedup":
            want = {r[0] for r in near_brute(before, 5, 80) if r[3]}
            assert kept == sorted(want) and len(kept) < len(before)
        elif name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect() if words(r.text)]
            leaks = lambda t: any(score(words(x), words(t)) / (2 * len(words(x))) >= 0.5 for x in items)
            assert kept == sorted(i for i, t in before if not leaks(t)) and len(kept) < len(before)
        elif name == "pii":
            p = Pseudonymiser(PSEUDONYM_KEY)
            assert sorted((r.doc_id, r.text, r.n_chars) for r in rows if r.text is not None) == sorted((i, x := p.replace(t)[0], len(x)) for i, t in before if t is not None)
            assert len(rows) == len(before) and "4186133740741811" not in "".join(r.text or "" for r in rows)
        else:
            with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
                library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(f.read()), special_tokens={})
            assert sorted((r.doc_id, list(r.ids)) for r in rows) == sorted((i, library.encode_ordinary(t or "")) for i, t in before)
        final, docs = rows, spark.createDataFrame(rows, out.schema)
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in got) == sorted((r.doc_id, r.ids_sha256) for r in final)


def test_empty(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_extra_columns_in_every_stage(spark, folder):
    """Columns named as those that stages use within, and columns that can't be ordered, come through unchanged."""
    extra = ["_key", "_digest", "_rank", "_place", "cls", "row", "key", "digest", "lost", "leaking", "h", "toxic", "id"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.selectExpr("*", *[f"concat('{c}', doc_id) as `{c}`" for c in extra], "map('a', doc_id) as m", "struct(doc_id, map(doc_id, 'b') as inner) as s")
    plain = docs.select(*COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        out, same = stage(spark, docs, folder), stage(spark, plain, folder)
        if name == "bpe":
            assert sorted((r.doc_id, r.ids_sha256) for r in out.collect()) == sorted((r.doc_id, r.ids_sha256) for r in same.collect())
            break
        rows = out.collect()
        assert out.columns == docs.columns
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in extra) and all(r.m == {"a": r.doc_id} and r.s.doc_id == r.doc_id and r.s.inner == {r.doc_id: "b"} for r in rows)
        assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(((r.doc_id, r.text) for r in same.collect()), key=repr)
        docs, plain = spark.createDataFrame(rows, out.schema), spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], plain.schema)
