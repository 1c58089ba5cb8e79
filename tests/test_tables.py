"""Readers, sinks, merges, ordered operators and streams."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from lorekeeper.operators import graph, merge, sequential
from lorekeeper.operators.ranking import even_positions, numbered
from lorekeeper.operators.sequential import first_by_either, term_windows
from lorekeeper.sources import readers, sinks
from lorekeeper.streaming.events import event_stream, run_available, windowed_counts


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿title,url\n"two\nlines",u\n', encoding="utf-8")
    assert rows(readers.read_csv(spark, str(tmp_path / "a.csv"), ("title", "url"))) == [("two\nlines", "u")]
    with pytest.raises(readers.MissingColumns):
        readers.read_csv(spark, str(tmp_path / "a.csv"), ("author",))


def test_config_and_texts(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"seeds": [{"a": 1}], "x": {}}')
    assert rows(readers.dimension(spark, readers.read_config(str(tmp_path / "c.json"), "seeds"), "a long, b string")) == [(1, None)]
    with pytest.raises(ValueError):
        readers.read_config(str(tmp_path / "c.json"), "x")
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("whole\ntext")
    paths = spark.createDataFrame([("t/a.txt",), ("t/missing.txt",)], "path string")
    assert rows(readers.texts_by_path(spark, str(tmp_path / "t"), paths)) == [("t/a.txt", "whole\ntext"), ("t/missing.txt", "")]


def test_pages(spark):
    page = '<script type="application/ld+json">{"@graph":[{"@type":"Person"},{"@type":"NewsArticle","headline":"H","datePublished":"2001"}]}</script>'
    df = spark.createDataFrame([(page, "<loc> a </loc><loc><![CDATA[b]]></loc>")], "html string, xml string")
    r = df.select(readers.article_metadata().alias("m"), readers.sitemap_locations().alias("l")).first()
    assert r.m.headline == "H" and r.l == ["a", "b"]


def test_docx(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", "<w:p><w:t>one</w:t><w:t xml:space='preserve'>two &amp;</w:t></w:p>")
    assert readers.docx_text(spark, str(tmp_path / "a.docx")).first().text == "one two &"


def test_collector(spark):
    assert rows(readers.collected(spark, readers.StubCollector(["q1", "q2"]))) == [("q1", "lead_only"), ("q2", "lead_only")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "r1"), (2, "b", "r2")], "id long, name string, route_id string")
    sinks.write_csv(df, str(tmp_path / "csv"), ["id", "name", "absent"], "v2")
    assert rows(spark.read.csv(str(tmp_path / "csv"), header=True).na.fill("")) == [("v2", "1", "", ""), ("v2", "2", "b", "")]
    sinks.stage(df, str(tmp_path / "stage"))
    sinks.stage(df.where("id = 1"), str(tmp_path / "stage"))
    assert spark.read.json(str(tmp_path / "stage")).count() == 2
    doc = sinks.nested_document(df.agg(F.count("*").alias("n")), {"records": df}, {"records": ["id"]}).first().document
    assert json.loads(doc)["summary"]["n"] == 2 and [r["id"] for r in json.loads(doc)["records"]] == [1, 2]
    sinks.export_sections({"records": df}, str(tmp_path / "export"))
    m = sinks.manifest(spark, str(tmp_path / "export"))
    assert m.count() and sinks.changed_files(m, m).isEmpty()
    assert "| r1 | 1 | 50.0 % |" in sinks.report("Routes", df.groupBy("route_id").agg(F.count("*").alias("n")), "route_id", "n")


def test_merges_are_idempotent(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k long, v string, n long")
    new = spark.createDataFrame([(2, "x", 7), (3, "y", 8), (3, "z", 9)], "k long, v string, n long")
    once = merge.upsert(old, new, ["k"], "n")
    assert rows(once.na.fill(0)) == [(1, "a", 0), (2, "x", 7), (3, "z", 9)]
    assert rows(merge.upsert(once, new, ["k"], "n").na.fill(0)) == rows(once.na.fill(0))
    added = merge.insert_missing(old, new, ["k"])
    assert added.count() == 3 and rows(merge.insert_missing(added, new, ["k"]).na.fill(0)) == rows(added.na.fill(0))
    assert rows(merge.fill_nulls(old, spark.createDataFrame([(1, 4), (2, 6)], "k long, n long"), ["k"], ["n"])) == [(1, "a", 4), (2, "b", 5)]
    assert rows(merge.replace_group(old, new.where("k = 2"), ["k"]).na.fill(0)) == [(1, "a", 0), (2, "x", 7)]
    total = merge.merge_counters(old.select("k", F.lit(1).alias("n")), new.select("k", F.lit(2).alias("n")), "k", ["n"])
    assert rows(total) == [(1, 1, 1), (2, 3, 2), (3, 4, 2)]
    assert rows(merge.numbered_after(old, new.select("v"), "k", ["v"])) == [("x", 3), ("y", 4), ("z", 5)]
    assert rows(merge.update_where(old, F.col("n") > 1, v=F.lit("w")).na.fill(0)) == [(1, "a", 0), (2, "w", 5)]


def test_numbered_and_even(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    assert all(r.x == r.at for r in numbered(df, ["x"], "at").collect())
    assert spark.range(1).select(even_positions(F.lit(10), 4)).first()[0] == [0, 3, 6, 9]


def in_order(data):
    kept, a, b = [], set(), set()
    for k, x, y in sorted(data):
        if x not in a and y not in b:
            kept.append((k,))
            a.add(x)
            b.add(y)
    return kept


@pytest.mark.parametrize("block", [1 << 20, 9])
def test_first_by_either(spark, monkeypatch, block):
    monkeypatch.setattr(sequential, "BLOCK", block)
    rng = random.Random(block)
    mixed = [(k, f"a{k % 7}", f"b{k * 3 % 11}") for k in range(60)]
    chain = [(1000 + k, f"c{(k + 1) // 2}", f"c{k // 2}") for k in range(50)]  # each row shares a key with the one before
    hot = [(2000 + k, "hot", f"h{k % 20}") for k in range(40)] + [(3000 + k, None, f"n{k % 3}") for k in range(6)]
    loose = [(4000 + rng.randrange(10**6), f"r{rng.randrange(60)}", f"r{rng.randrange(60)}") for _ in range(80)]
    data = mixed + chain + hot + list({k: (k, x, y) for k, x, y in loose}.values())
    df = spark.createDataFrame(data, "k long, x string, y string")
    assert rows(first_by_either(df, ["x"], ["y"], "k").select("k")) == in_order(data)


def test_first_by_either_of_a_long_chain(spark):
    n = 100_000
    chain = spark.range(n).select("id", F.expr("cast((id + 1) div 2 as string)").alias("x"), F.expr("cast(id div 2 as string)").alias("y"))
    got = [r.id for r in first_by_either(chain, ["x"], ["y"], "id").select("id").orderBy("id").collect()]
    assert got == [k for (k,) in in_order([(k, (k + 1) // 2, k // 2) for k in range(n)])]
    assert first_by_either(chain.limit(0), ["x"], ["y"], "id").count() == 0


def test_parts_of_a_graph(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    got = {r.node: r.part for r in graph.parts(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 140)} | {300: 300, 301: 300}


def test_term_windows(spark):
    text = "ghost ghost " + "x" * 900 + " ghost"
    got = rows(term_windows(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), ["ghost"]))
    assert len(got) == 2 and got[0][2] == 0


def test_stream_counts_each_event_once(spark, tmp_path):
    batch = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    batch.unionAll(batch.limit(20)).coalesce(1).sortWithinPartitions("ts").write.parquet(str(tmp_path / "in"))
    run_available(windowed_counts(event_stream(spark, str(tmp_path / "in"))), str(tmp_path), str(tmp_path / "out"))
    closed = rows(spark.read.parquet(str(tmp_path / "out")))
    assert closed and set(closed) <= set(rows(windowed_counts(batch)))


def test_passes_until_targets_are_met():
    from lorekeeper.operators.decisions import until_met

    found = []
    step = lambda k: found.append(k) is None and k < 5
    assert until_met(step, lambda: len(found) >= 3) == 3  # met
    assert until_met(lambda k: False, lambda: False) == 1  # nothing new
    assert until_met(lambda k: True, lambda: False, passes=4) == 4  # as many as allowed
    assert until_met(step, lambda: True) == 0


def test_decisions_on_nulls_and_empty_tables(spark):
    from pyspark.sql import functions as F

    from lorekeeper.operators import decisions as d

    rows = spark.createDataFrame([(None, None, None, None), ("u", "", "", "")], "url string, text string, label string, place string")
    got = rows.select(d.seed_decision(F.col("url"), F.col("text"), F.col("label"), F.col("place"), F.lit(None).cast("string"), F.lit(True)).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in got] == [("rejected", "seed_missing_url"), ("accepted", "")]
    results = spark.sql("select array(named_struct('lat', -30.0, 'lon', 140.0, 'state', 'VIC', 'kind', 'state'), named_struct('lat', -30.0, 'lon', 141.0, 'state', 'Vic', 'kind', cast(null as string))) as r union all select array()")
    assert [(x.c.result and x.c.result.lon, x.c.reason) for x in results.select(d.choose_result(F.col("r"), F.lit("vic")).alias("c")).collect()] == [(141.0, "accepted"), (None, "no_result")]
    pages = spark.createDataFrame([], "page_id long, url string, text string")
    assert d.placed_evidence(pages, spark.createDataFrame([("a", "b")], "place string, alias string"), "x", None).collect() == []
    assert d.candidate_rows(rows, ["a", "url"], {"url": F.col("url")}, {"a": "1"}).collect() == [("1", ""), ("1", "u")]


def test_lexicon_words(spark):
    from lorekeeper.operators.lexicon import matches

    docs = spark.createDataFrame([(1, "The Drop\n Bear's claw; bears"), (2, "xbear bear_ BEAR"), (3, None), (4, "")], "doc_id long, text string")
    lexicon = spark.createDataFrame([(1, "drop bear", "plain"), (2, "bear", "plain"), (3, "", "plain"), (4, "BEARS", "noise_sensitive")], "alias_id int, alias string, kind string")
    assert sorted((r.doc_id, r.alias_id, r.p, r.confidence) for r in matches(docs, lexicon).collect()) == [(1, 1, 5, "high"), (1, 2, 10, "low"), (1, 4, 23, "medium"), (2, 2, 13, "low")]
