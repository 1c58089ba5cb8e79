"""Release checks on planted faults, words in nested values, parity."""

from pyspark.sql import functions as F

from lorekeeper.operators.release import Release, field_names, parity, paths_with


def test_words_by_path(spark):
    kind = "id long, plain string, n int, list array<string>, deep array<struct<a: string, b: map<string, array<string>>>>, s struct<t: struct<u: string>, v: array<array<string>>>, m map<string, struct<x: string>>"
    rows = [
        (1, "a secret", 1, ["x", None, "the Secret"], [("secret", {"k secret": ["no", "secret"]}), (None, None)], (("my secret",), [["a"], ["secret b", None]]), {"secret": ("secret",)}),
        (2, None, None, None, None, None, None), (3, "", 0, [], [], ((None,), []), {}), (4, "SECRET", 4, ["b"], [("c", {"d": ["e"]})], (("f",), [["g"]]), {"h": ("i",)}), (1, "again token", 1, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, kind)
    got = sorted(tuple(r) for r in paths_with(df, ["id"], ["secret", "token"]).collect())
    assert got == sorted([(1, p, "secret") for p in ("plain", "deep[].a", "deep[].b{keys}", "deep[].b{}[]", "s.t.u", "s.v[][]", "m{keys}", "m{}.x")] + [(1, "plain", "token")])
    assert {(r.id, r.path) for r in paths_with(df, ["id"], ["secret"], any_case=True).collect()} >= {(4, "plain"), (1, "list[]")}
    assert paths_with(df.select("id", "n"), ["id"], ["secret"]).count() == 0
    assert field_names(df.schema) == ["id", "plain", "n", "list", "deep", "deep[].a", "deep[].b", "s", "s.t", "s.t.u", "s.v", "m", "m{}.x"]


def release(spark, records, flags=((1,), (2,)), points=((1,), (2,)), bands=((3,),), sources=((7,),), summary=(3, 2, {"a": 2, "b": 1}, {"NSW": 2})):
    kind = "record_id long, source_id long, title string, source_name string, genre string, url string, external_id string, publicness_level string, relevance_code string, meta array<struct<raw_text: string>>"
    return Release(
        spark.createDataFrame(records, kind).drop("meta"), spark.createDataFrame(points, "record_id long"), spark.createDataFrame(flags, "record_id long"), spark.createDataFrame(bands, "record_count long"), spark.createDataFrame(sources, "source_id long"),
        spark.createDataFrame([summary], "record_count long, mapped_record_count long, source_rollup map<string,long>, mapped_state_counts map<string,long>"),
    )


GOOD = [(k, 7, f"t{k}", "s", "g", "u", None, "public_page", None, None) for k in (1, 2, 3)]


def failing(r):
    return {x.check_name: (x.level, x.failures, x.first) for x in r.checks().collect() if x.failures}


def test_release_checks(spark):
    good = release(spark, GOOD)
    assert failing(good) == {} and good.checks().count() == 16
    bad = [GOOD[0], GOOD[0], (4, 8, " ", "", None, "", " ", "Rejected by hand", "restricted", None), (5, None, "t", "s", "g", None, "e", "x", "SUPPRESSED", None)]
    got = failing(release(spark, bad, flags=[(1,), (1,), (9,)], points=[(1,)], bands=[(1,), (2,)], summary=(9, 3, {"a": 9, "b": None}, {"NSW": 1})))
    assert got == {
        "public_records_unique_by_record_id": ("error", 1, "1"), "map_flags_unique_by_record_id": ("error", 1, "1"), "every_map_flag_references_public_record": ("error", 1, "9"), "map_flag_count_equals_mapped_record_count": ("error", 1, None),
        "no_suppressed_rejected_restricted_records": ("error", 2, "4"), "every_public_record_has_title": ("error", 1, "4"), "every_public_record_has_source_name": ("error", 1, "4"), "every_public_record_has_narrative_or_source_type": ("warning", 1, "4"),
        "every_public_record_has_url_or_identifier": ("warning", 1, "4"), "summary_record_count_reconciles": ("error", 1, None), "date_band_totals_reconcile": ("error", 1, None), "source_rollups_reconcile": ("error", 1, None), "map_state_counts_reconcile": ("error", 1, None), "source_page_source_totals_reconcile": ("error", 1, "4"),
    }


def test_internal_fields_are_named_anywhere(spark):
    r = release(spark, GOOD)
    r.records = r.records.withColumn("meta", F.array(F.struct(F.lit("x").alias("raw_text"))))
    assert failing(r) == {"no_raw_internal_fields_in_public_records": ("error", 3, "1")}


def test_parity(spark):
    kind = "k long, a string, b array<int>, m map<string,int>"
    left = [(1, "x", [1], {"p": 1}), (2, "x", [1], None), (3, None, None, None), (4, "same", [1, 2], {}), (5, "bag", None, None), (5, "gab", None, None), (6, "one", None, None), (None, "n", None, None), (8, "m", None, {"p": 1})]
    right = [(1, "x", [1], {"p": 1}), (2, "y", [2], None), (4, "same", [2, 1], {}), (5, "gab", None, None), (5, "bag", None, None), (6, "one", None, None), (6, "one", None, None), (7, "new", None, None), (None, "n", None, None), (8, "m", None, {"p": 2})]
    got = {r.k: (r.side, r.columns) for r in parity(spark.createDataFrame(left, kind), spark.createDataFrame(right, kind), ["k"]).collect()}
    assert {k: s for k, (s, _) in got.items()} == {2: "differs", 3: "missing", 4: "differs", 6: "differs", 7: "extra", 8: "differs"}
    assert got[2][1] == ["a", "b"] and got[4][1] == ["b"] and got[8][1] == ["m"] and got[6][1][0] == "(rows)" and got[3][1] == []
    other = spark.createDataFrame([(1, "x")], "k long, c string")
    assert [(r.side, r.columns) for r in parity(spark.createDataFrame([(1, "x")], "k long, a string"), other, ["k"]).collect()] == [("differs", ["a", "c"])]
