"""Exports of the archive: fields and order as written, the review queue, counts and layers by hand, and bands between the years of the data."""

import csv
import glob

import pytest

from lorekeeper.operators import exports as ex
from lorekeeper.operators.periods import bands_between


def written(folder, name):
    rows = []
    for part in sorted(glob.glob(f"{folder}/{name}/part-*.csv")):
        with open(part, newline="", encoding="utf-8") as f:
            head, *more = csv.reader(f, escapechar="\\")
            rows += more
    return head, rows


def record_tables(spark):
    frame = spark.createDataFrame
    return {
        "records": frame([(1, None, "Ä", "public_page"), (2, 1900, 'say "x", y', None), (3, 1800, "z", "restricted_excluded"), (4, 1850, "w", "public_page"), (5, 1700, "v", None)], "record_id int, year int, title string, publicness_level string"),
        "coding": frame([(1, "n1", None, "needs_review"), (4, "n4", "restricted_excluded", None), (5, "n5", None, "scope_excluded")], "record_id int, notes string, publicness_code string, relevance_code string"),
        "figures": frame([(1, "Yowie", "c"), (2, "Mimih", "b")], "figure_id int, canonical_name string, cluster string"),
        "aliases": frame([(1, 1, "hairy man", 1), (2, 1, "yahoo", 9), (3, 1, "ape", 1)], "alias_id int, figure_id int, alias string, search_priority int"),
        "sources": frame([(1, "S", "web")], "source_id int, source_name string, source_type string"),
        "queries": frame([(1, 1, 2, "q", "1900"), (2, 9, 1, "r", "1900"), (3, 1, None, "a", None)], "query_id int, source_id int, figure_id int, query_string string, date_start string"),
        "attention_series": frame([(1, 1, 1, "t", "2001", 5)], "attention_id int, source_id int, figure_id int, term string, date string, value int"),
        "record_locations": frame([(2, 1, "high"), (2, 2, None), (2, 3, "low"), (3, 1, "low"), (2, 9, "low")], "record_id int, location_id int, confidence string").selectExpr("*", "'near' as relation_type"),
        "locations": frame([(1, "Bega", "NSW", "South"), (2, "Ayr", "", "North"), (3, "Cue", None, None)], "location_id int, place_name string, state_territory string, region string"),
    }


def test_record_exports(spark, tmp_path):
    exports = ex.record_exports(record_tables(spark))
    counts = ex.write_exports(exports, str(tmp_path), None)
    assert counts == {"records_review": 2, "figures_aliases": 4, "query_plan": 2, "attention_series": 1, "record_locations": 4}
    head, rows = written(tmp_path, "records_review")
    assert head == ex.RECORD_FIELDS and [r[0] for r in rows] == ["1", "2"]  # no year first
    told = dict(zip(head, rows[1]))
    assert told["title"] == 'say "x", y' and told["location_summary"] == "Ayr (North): ; Bega (NSW): high; Cue: low" and told["notes"] == told["url"] == "" and dict(zip(head, rows[0]))["notes"] == "n1"
    head, rows = written(tmp_path, "figures_aliases")
    assert [(r[1], r[10]) for r in rows] == [("Mimih", ""), ("Yowie", "yahoo"), ("Yowie", "ape"), ("Yowie", "hairy man")]
    assert [r[0] for r in written(tmp_path, "query_plan")[1]] == ["3", "1"]
    assert [(r[0], r[3]) for r in written(tmp_path, "record_locations")[1]] == [("3", "Bega"), ("2", "Ayr"), ("2", "Bega"), ("2", "Cue")]


def archive_tables(spark):
    frame = spark.createDataFrame
    whole = {table: frame([(2, "b"), (1, None)], f"{key} int, what string") for table, key in ex.WHOLE.values()}
    return whole | {
        "source_items": frame([(n, "A" if n < 3 else None, "org" if n != 2 else "", f"t{n}", "web") for n in range(1, 6)], "source_item_id int, source_tier string, publication_or_organisation string, title string, source_type string"),
        "narrative_units": frame(
            [(1, "encounter_account", None, "analysis_ready", "high", "full", "1900"), (2, None, "heritage_discourse", "needs_review", "low", "suppressed", "1700-01"), (3, "", "", None, None, None, None), (4, "giant_or_ogre_narrative", None, "lead_only", "very_high", "summary_only", "x")],
            "narrative_id int, narrative_type string, secondary_role string, analysis_status string, cultural_sensitivity string, display_mode string, earliest_attestation_start string",
        ).selectExpr("*", "'ok' as ethics_review_status", "'w' as working_title"),
        "legacy_record_mappings": frame([(1, 1, 1, "narrative", "[]"), (2, 2, 2, "control", "[]"), (3, 3, None, "control", "[]"), (4, 4, None, "narrative", None), (5, 5, 4, "narrative", "[]"), (6, 1, 2, "x", '["f"]'), (7, 9, None, "control", "[]")], "legacy_record_id int, source_item_id int, narrative_id int, primary_record_role string, review_flags string").selectExpr("*", "'low' as migration_confidence"),
        "narrative_locations": frame([(1, 1, 1, "alleged_event_location"), (2, 1, 2, None), (3, 2, 1, "x"), (4, 4, 1, "publication_location"), (5, 3, 1, "x"), (6, 1, 9, "x")], "narrative_location_id int, narrative_id int, location_id int, location_role string"),
        "locations": frame([(1, "Bega", "NSW"), (2, "Ayr", "")], "location_id int, place_name string, state_territory string"),
        "collection_candidates_v2": frame([(1, "accepted"), (2, "rejected"), (3, "duplicate"), (4, None), (5, "lead_only"), (6, "accepted")], "candidate_id int, candidate_status string"),
    }


def test_archive_exports(spark, tmp_path):
    t = archive_tables(spark)
    exports = ex.archive_exports(t)
    assert len(exports) == 13
    counts = ex.write_exports({k: exports[k] for k in ("source_items_review", "leads", "review_queue", "collection_500_accepted", "collection_500_rejected", "narrative_locations_review")}, str(tmp_path), "v2")
    assert counts == {"source_items_review": 5, "leads": 2, "review_queue": 4, "collection_500_accepted": 2, "collection_500_rejected": 3, "narrative_locations_review": 5}
    head, rows = written(tmp_path, "leads")
    assert head == ["schema_version", "lead_id", "what"] and rows == [["v2", "1", ""], ["v2", "2", "b"]]
    assert [r[1] for r in written(tmp_path, "review_queue")[1]] == ["3", "4", "5", "6"]
    empty = {"leads": exports["leads"]._replace(rows=exports["leads"].rows.limit(0))}
    assert ex.write_exports(empty, str(tmp_path / "none"), "v2") == {"leads": 0} and written(tmp_path / "none", "leads") == (["schema_version", "lead_id", "what"], [])


def test_counts_summary_and_layers(spark):
    t = archive_tables(spark)
    counts = ex.public_counts(t, [("old", 1600, 1799), ("new", 1800, 1950)])
    got = {(r.family, r.value): r.n for r in counts.collect()}
    family = lambda f: {v: n for (k, v), n in got.items() if k == f}
    assert family("narrative_types") == {"encounter_account": 1, "heritage_discourse": 1, "untyped": 1, "giant_or_ogre_narrative": 1} and family("date_bands") == {"old": 1, "new": 1, "undated": 2}
    assert family("source_tiers") == {"A": 2, "unknown": 3} and family("source_organisations") == {"org": 4, "unknown": 1} and family("collection_candidates") == {"accepted": 2, "rejected": 1, "duplicate": 1, "lead_only": 1, "unknown": 1}
    # A display that is null is not known to be shown.
    assert family("location_roles") == {"alleged_event_location": 1, "unknown": 1, "publication_location": 1} and family("states") == {"NSW": 2, "AU_UNSPECIFIED": 1}
    summary = ex.public_summary(t, counts).first().asDict()
    assert summary["encounter_account_count"] == summary["discourse_context_count"] == summary["traditional_spirit_person_count"] == summary["unresolved_lead_count"] == summary["analysis_ready_count"] == 1
    assert summary["high_sensitivity_count"] == 2 and summary["ghost_legend_count"] == 0 and summary["source_item_count"] == 5 and summary["entity_concept_count"] == 2 and len(summary) == 14
    assert {(r.narrative_location_id, r.layer) for r in ex.map_layers(t).collect()} == {(1, "alleged_event_location"), (2, "uncertain_or_broad_location")}
    none = {k: v.limit(0) for k, v in t.items()}
    assert ex.public_counts(none, []).count() == 0 and set(ex.public_summary(none, ex.public_counts(none, [])).first()) == {0}


def test_bands_between_years():
    periods = [("a", None, 1849), ("b", 1850, 1900), ("c", 1901, None)]
    assert bands_between(periods, 1700, 2020) == [("a", 1700, 1849), ("b", 1850, 1900), ("c", 1901, 2020)]
    assert bands_between(periods, None, 2020) == [("a", None, None), ("b", None, None), ("c", None, None)]
    for bad, years in [([("a", None, 1849), ("b", 1851, None)], (1700, 2020)), (periods, (1860, 2020)), (periods, (1700, 1890)), ([("a", 1700, None)], (1600, 1800)), ([("a", None, 1900)], (1700, 1950))]:
        with pytest.raises(ValueError):
            bands_between(bad, *years)
