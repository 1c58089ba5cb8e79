"""First codes and the classification of records, against plain Python and by hand."""

import random
import re

import pytest

from lorekeeper.operators import classification as cl
from lorekeeper.operators import coding as co
from lorekeeper.operators import gazetteer as g

RECORDS = "record_id long, title string, snippet string, full_text string, publicness_level string, figure_id int"
ALIASES = "alias_id int, alias string, alias_type string, figure_id int, search_priority int"
FIGURES = "figure_id int, canonical_name string, include_status string, ontology_default string, humanoid_degree string, involves_indigenous_knowledge boolean"
FIGURE_ROWS = [(1, "Yowie", "include_v1", "being", "high", False), (2, "Mimih", "validate_before_include", "spirit", "medium", True), (3, "Gone", "exclude_core", "x", "y", False), (4, "Bunyip", "control_only", "control", "low", None)]


def first_held(texts, names, around=90):
    out = set()
    for d, text in texts:
        for i, name in names:
            if name and text and (at := text.lower().find(name.lower())) >= 0:
                end = at + len(name)
                out.add((d, i, at, end, " ".join(text[max(0, at - around) : end + around].split()), text[at:end]))
    return out


@pytest.mark.parametrize("size", [1 << 20, 8])
def test_names_within_words(spark, monkeypatch, size):
    monkeypatch.setattr(g, "BLOCK_BYTES", size)
    rng = random.Random(5)
    letters = ["a", "B", "é", "É", "'", ".", " ", "  ", "ß", "\n", "ab"]
    texts = [(k, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for k in range(60)] + [(60, None), (61, "x" * 5000 + "St. Mary's"), (62, "yowie's")]
    names = [(k, "".join(rng.choice(letters) for _ in range(rng.randint(1, 4)))) for k in range(40)] + [(40, None), (41, ""), (42, "ST. MARY'S"), (43, "É"), (44, "é")]
    docs, wanted = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(names, "item_id long, name string")
    got = [tuple(r) for r in g.first_held(docs, wanted, 9).collect()]
    assert len(got) == len(set(got)) and set(got) == first_held(texts, names, 9)
    assert g.first_held(docs, wanted.limit(0)).count() == g.first_held(docs.limit(0), wanted).count() == 0


ALIAS_ROWS = [
    (1, "Yowie", "common", 1, 5), (2, "Hairy Man", "historical_descriptor", 1, 5), (3, "Mimi", "noise_sensitive", 2, 9), (4, "Mimi's", "common", 2, 7), (5, "Gone", "common", 3, 99), (6, "Bunyip", "noise_sensitive", 4, 1), (7, None, "common", 1, 9), (8, "", "common", 1, 9), (9, "yowie", "common", 2, 5),
]


def frames(spark, rows):
    return spark.createDataFrame(rows, RECORDS), spark.createDataFrame(ALIAS_ROWS, ALIASES), spark.createDataFrame(FIGURE_ROWS, FIGURES)


def test_coding_by_hand(spark):
    rows = [
        (1, "A YOWIE seen", None, "near the  hairy \n man", "open_full_text", 4),
        (2, None, "", "", "public_page", 2),
        (3, "Gone", "Yowies and Mimix", None, None, None),
        (4, "Cadbury yowie", "of MIMI'S art", "y", "restricted_excluded", 1),
        (5, "x", "y", "a bunyip " + "z " * 3000 + "Yowie", "other", 1),
        (6, None, None, None, None, 77),
        (7, "Mimi", None, None, "public_metadata", None),
    ]
    records, aliases, figures = frames(spark, rows)
    got = {r.record_id: r for r in co.coded(records, aliases, figures, ["Yowie toy", "cadbury YOWIE", "Yowie"]).collect()}
    pick = lambda k: (got[k].canonical_figure_guess, got[k].figure_name_as_printed, got[k].publicness_code, got[k].relevance_code, got[k].ethics_flag)
    assert pick(1) == ("Yowie", "hairy \n man", "open_article", "noise", "ok_public")  # of equal priority the longer alias
    assert pick(2) == ("Mimih", None, "public_heritage_page", "needs_review", "caution_indigenous_knowledge")  # the record's own figure
    assert pick(3)[:2] == (None, None) and got[3].relevance_code == "noise"  # within words for noise, not for aliases
    assert pick(4) == ("Mimih", "MIMI", "restricted_excluded", "noise", "restricted_exclude") and got[4].notes == "Obvious noise pattern matched: cadbury YOWIE. Requires confirmation."
    assert pick(5)[:3] == ("Yowie", "Yowie", "open_article") and got[5].ontology_code == "being"
    assert pick(6) == (None, None, "open_article", "needs_review", "ok_public") and got[6].notes == "Initial rule-based coding; requires human review."
    assert pick(7) == ("Mimih", "Mimi", "public_metadata", "needs_review", "caution_indigenous_knowledge")
    told = {(r.record_id, r.alias_id): r for r in co.alias_matches(records.select("record_id", co.record_text("title", "snippet", "full_text").alias("text")), aliases, figures).collect()}
    assert {(k, told[k].matched_text, told[k].confidence) for k in told if k[0] in (1, 4)} == {((1, 1), "YOWIE", "high"), ((1, 9), "YOWIE", "high"), ((1, 2), "hairy \n man", "medium"), ((4, 1), "yowie", "high"), ((4, 9), "yowie", "high"), ((4, 3), "MIMI", "low"), ((4, 4), "MIMI'S", "high")}
    assert told[1, 2].match_context == "A YOWIE seen near the hairy man" and not any(k[0] == 3 for k in told) and len(told[5, 6].match_context) <= 6 + 180


def test_only_uncoded_records_and_again(spark):
    records, aliases, figures = frames(spark, [(k, "Yowie" if k % 2 else "z", None, None, None, None) for k in range(6)])
    done = co.coded(records.where("record_id < 4"), aliases, figures, [])
    assert {r.record_id for r in co.coded(records, aliases, figures, [], done).collect()} == {4, 5}
    assert co.coded(records.limit(0), aliases, figures, []).count() == 0 and co.coded(records, aliases.limit(0), figures.limit(0), []).count() == 6
    from pyspark.sql import functions as F

    old = done.withColumn("genre", F.when(F.col("record_id") == 1, "report")).withColumn("notes", F.lit("by hand"))
    state = {r.record_id: r for r in co.coded_again(old, co.coded(records.where("record_id > 0"), aliases, figures, ["z"])).collect()}
    assert sorted(state) == list(range(6)) and state[0].notes == "by hand" and state[1].genre == "report" and state[1].notes != "by hand"
    assert state[2].genre is None and state[2].relevance_code == "noise" and state[5].genre == "unknown"


ROW = dict(source_type="modern_web", source_name="Web", figure_name_as_printed=None, canonical_figure_guess=None, canonical_name=None, title=None, snippet=None, include_status=None, involves_indigenous_knowledge=None, full_text_path=None, year=None)
SCHEMA = "source_type string, source_name string, figure_name_as_printed string, canonical_figure_guess string, canonical_name string, title string, snippet string, include_status string, involves_indigenous_knowledge boolean, full_text_path string, year int"
CASES = [
    (dict(figure_name_as_printed="  BUNYIP ", source_type=None), dict(primary_role="control", source_tier="C", source_mediation="public_source", display_mode="metadata_only", review_flags=["control"], relationship_type=None)),
    (dict(include_status="control_only", figure_name_as_printed="Bula"), dict(primary_role="control", ethics_review_status="not_required_control")),
    (dict(canonical_figure_guess="bula", involves_indigenous_knowledge=True), dict(primary_role="exclusion", cultural_sensitivity="very_high", display_mode="suppressed", review_flags=["exclusion"])),
    (dict(source_type="academic_metadata", involves_indigenous_knowledge=True), dict(primary_role="catalogue_metadata", display_mode="metadata_only", entity_concept_key="traditional_spirit_person_cluster", review_flags=["indigenous_related", "metadata_only_not_accepted"], source_tier="B")),
    (dict(source_type="academic_metadata", title="The Wanjina"), dict(entity_concept_key="unresolved_or_validation_label", cultural_sensitivity="high", review_flags=["high_sensitivity", "metadata_only_not_accepted"])),
    (dict(figure_name_as_printed="Mamu", source_type="internet_archive_metadata"), dict(narrative_type="spirit_person_narrative", secondary_role="heritage_discourse", relationship_type="original_publication", display_mode="summary_only", review_flags=["high_sensitivity", "item_text_requires_inspection"])),
    (dict(figure_name_as_printed="Mamu", snippet="A GIANT spirit", full_text_path="p", source_type="internet_archive_metadata"), dict(narrative_type="giant_or_ogre_narrative", review_flags=["high_sensitivity"])),
    (dict(figure_name_as_printed="Nargun", source_type="andc"), dict(narrative_type="traditional_narrative", secondary_role=None, relationship_type="derivative_web_summary", cultural_sensitivity="low", display_mode="full", review_flags=[])),
    (dict(figure_name_as_printed="", canonical_figure_guess=None), dict(narrative_type="encounter_account", relationship_type="witness_account_publication", label_type="historical_descriptor", label="unknown humanoid")),
    (dict(figure_name_as_printed="Yowie", source_name="Australian Yowie Research", year=1969), dict(source_tier="E", relationship_type="archive_reproduction", label_type="exact_name", review_flags=["original_article_verification_required"])),
    (dict(figure_name_as_printed="Yowie", source_name="Australian Yowie Research", year=0), dict(relationship_type="retrospective_summary", review_flags=[])),
    (dict(figure_name_as_printed="Ghost", canonical_name="Yowie", source_name="australian yowie research", title="Old newspaper"), dict(source_tier="E", relationship_type="witness_account_publication", review_flags=[])),
    (dict(figure_name_as_printed="Ghost", source_type="google_trends"), dict(primary_role="source pointer", source_tier="attention", classification_confidence="low", review_flags=["requires_manual_classification"], entity_concept_key="unresolved_or_validation_label")),
    (dict(figure_name_as_printed="Ghost", source_type="trove_magazine", involves_indigenous_knowledge=False), dict(source_traceability_status="stable_public_identifier", display_mode="metadata_only")),
]


def test_every_kind_of_record(spark):
    rows = [{**ROW, **given, "n": n} for n, (given, _) in enumerate(CASES)]
    got = {r.n: r.asDict() for r in cl.classified(spark.createDataFrame(rows, SCHEMA + ", n int")).collect()}
    for n, (_, want) in enumerate(CASES):
        assert {k: got[n][k] for k in want} == want, n
    assert all(v is not None for r in got.values() for k, v in r.items() if k in cl.FIELDS and k not in ("narrative_type", "secondary_role", "relationship_type"))


def test_classification_moves_no_row(spark):
    df = spark.createDataFrame([{**ROW, "primary_role": "old", "label": "old"}], SCHEMA + ", primary_role string, label string")
    out = cl.classified(df)  # columns of the same names give way
    assert out.count() == 1 and len(set(out.columns)) == len(out.columns) and out.first().label == "unknown humanoid" and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert cl.classified(df.limit(0)).count() == 0
