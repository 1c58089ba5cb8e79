"""What a legacy record is in the normalised archive: 22 fields, decided by its label, its source and its words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekeeper.functions.text import normalised
from lorekeeper.operators.promotion import first_given
from lorekeeper.operators.rules import ladder, mentions

#: Labels (fixed values).
CONTROL = ("bunyip", "drop bear", "min min lights")
EXCLUSION = ("rainbow serpent", "ngatyi", "bula")
TRADITIONAL = ("yaroma", "yara-ma-yha-who", "yara-ma-tha-who", "mimih", "mimi", "quinkan", "quinkin", "wandjina", "wanjina", "nargun", "garkain", "mokoi", "mamu", "pangkarlangu", "puttikan", "tjangara")
HIGH_SENSITIVITY = ("wandjina", "wanjina", "mamu", "quinkan", "quinkin")
HAIRY_HUMANOID = ("yowie", "yahoo", "hairy man", "hairy man of the wood", "australian ape", "australian gorilla", "wild man", "ape-like man", "unknown humanoid")
GIANTS = ("pangkarlangu", "tjangara")
SPIRITS = ("mimih", "mimi", "quinkan", "quinkin", "wandjina", "wanjina", "mokoi", "mamu", "garkain")
UNLABELLED, HAIRY_FIGURE = "unknown humanoid", "Yowie"
#: Words of a text that tell (fixed values).
SENSITIVE_WORDS, GIANT_WORD, SPIRIT_WORD, REPRINT_WORDS = ["wandjina", "wanjina"], "giant", "spirit", ["historical", "newspaper"]
AGGREGATOR, AGGREGATOR_TITLE, REPRINT_BEFORE = "yowie research", "Australian Yowie Research", 1970
#: Tier, mediation and traceability of a source by its type; those of an aggregator, and of any other type (fixed values).
SOURCES = [
    (("trove_newspaper", "trove_magazine", "nla_catalogue"), ("A", "original_or_near_primary", "stable_public_identifier")),
    (("aiatsis_public_catalogue", "andc"), ("B", "public_institutional_metadata", "public_metadata_only")),
    (("academic_metadata",), ("B", "bibliographic_metadata", "metadata_only_pointer")),
    (("internet_archive_metadata",), ("A", "digitized_public_item_or_metadata", "metadata_requires_item_inspection")),
]
AGGREGATORS = ("E", "specialist_aggregator_or_witness_publication", "public_page_traceable")
LATER_SOURCES = [
    (("modern_web",), ("C", "public_web_or_media", "public_page_traceable")),
    (("wikimedia_pageviews", "google_trends"), ("attention", "attention_series", "not_source_item_evidence")),
]
OTHER_SOURCES = ("C", "public_source", "public_page_traceable")
#: Sensitivity, ethics and display of sensitive, related and other records (fixed values).
CARE = {"high": ("high", "requires_ethics_review", "summary_only"), "related": ("medium", "caution_indigenous_related", "summary_only"), "none": ("low", "ok_public", "full")}
#: Clusters of labels (fixed values).
HAIRY_CLUSTER, TRADITIONAL_CLUSTER, CONTROL_CLUSTER, UNRESOLVED = "hairy_humanoid_operational_cluster", "traditional_spirit_person_cluster", "control_or_excluded_terms", "unresolved_or_validation_label"
#: The fields in order.
FIELDS = (
    "primary_role", "narrative_type", "secondary_role", "relationship_type", "source_tier", "source_mediation", "narrative_status", "analysis_status", "humanoid_basis", "australia_relation", "cultural_sensitivity",
    "ethics_review_status", "display_mode", "classification_confidence", "source_traceability_status", "rights_access_status", "reproduction_status", "text_or_ocr_status", "label_type", "entity_concept_key", "review_flags", "notes",
)
#: What each kind of record has whatever else it says (fixed values).
KINDS = {
    "control": dict(
        primary_role="control", secondary_role="control", narrative_status="control", analysis_status="excluded", humanoid_basis="non_core_control", australia_relation="australia_public_text", cultural_sensitivity="medium", ethics_review_status="not_required_control", display_mode="metadata_only",
        classification_confidence="medium", rights_access_status="public_review_required", reproduction_status="metadata_or_short_excerpt_only", text_or_ocr_status="metadata_or_excerpt", label_type="compiler_supplied_label", entity_concept_key=CONTROL_CLUSTER, notes="Control term retained outside humanoid-core counts.",
    ),
    "exclusion": dict(
        primary_role="exclusion", secondary_role="exclusion", narrative_status="excluded", analysis_status="excluded", humanoid_basis="outside_v2_core", australia_relation="australia_public_text", cultural_sensitivity="very_high", ethics_review_status="excluded_by_scope", display_mode="suppressed",
        classification_confidence="medium", rights_access_status="public_review_required", reproduction_status="metadata_or_short_excerpt_only", text_or_ocr_status="metadata_or_excerpt", label_type="compiler_supplied_label", entity_concept_key=CONTROL_CLUSTER, notes="Excluded/control material kept auditable but outside public core.",
    ),
    "catalogue": dict(
        primary_role="catalogue_metadata", secondary_role="catalogue_metadata", relationship_type="catalogue_pointer", narrative_status="metadata_pointer", analysis_status="lead_only", humanoid_basis="public_metadata_mentions_project_label", australia_relation="australia_relation_requires_review", display_mode="metadata_only",
        classification_confidence="medium", rights_access_status="metadata_public_reuse_unclear", reproduction_status="metadata_only", text_or_ocr_status="metadata_only", label_type="compiler_supplied_label", notes="Bibliographic metadata is a source pointer unless accessible content is reviewed.",
    ),
    "traditional": dict(
        primary_role="first-class narrative source", narrative_status="legacy_migrated_public_narrative", analysis_status="display_ready_unreviewed", humanoid_basis="public_source_describes_humanoid_or_spirit_person_basis", australia_relation="australia_public_text_or_association",
        classification_confidence="medium", rights_access_status="public_review_required", reproduction_status="short_excerpt_or_summary_only", text_or_ocr_status="metadata_or_excerpt", label_type="exact_name", entity_concept_key=TRADITIONAL_CLUSTER,
        notes="Traditional/spirit-person material preserved as public narrative/context, not cryptid taxonomy.",
    ),
    "encounter": dict(
        primary_role="first-class narrative source", narrative_type="encounter_account", narrative_status="legacy_migrated_encounter_candidate", analysis_status="display_ready_unreviewed", humanoid_basis="source_reports_humanoid_or_hairy_upright_figure", australia_relation="australian_event_or_public_text_relation",
        classification_confidence="medium", rights_access_status="public_review_required", reproduction_status="short_excerpt_or_summary_only", text_or_ocr_status="metadata_or_excerpt", entity_concept_key=HAIRY_CLUSTER,
        notes="Migrated as encounter-account candidate; source verification does not verify supernatural claim.",
    ),
    "pointer": dict(
        primary_role="source pointer", secondary_role="source_pointer", relationship_type="derivative_web_summary", narrative_status="requires_review", analysis_status="lead_only", humanoid_basis="humanoid_basis_requires_review", australia_relation="australia_relation_requires_review", display_mode="metadata_only",
        classification_confidence="low", rights_access_status="public_review_required", reproduction_status="metadata_or_short_excerpt_only", text_or_ocr_status="metadata_or_excerpt", label_type="uncertain_label", entity_concept_key=UNRESOLVED, notes="Legacy row could not be safely promoted by deterministic rules.",
    ),
}
#: Fields that some kind fixes, and those of a source.
CONSTANT = {c for values in KINDS.values() for c in values}
STANDING = ("source_tier", "source_mediation", "source_traceability_status")


def standing(source_type: Column, source_name: Column) -> Column:
    """(source_tier, source_mediation, source_traceability_status) of a source as one struct, so that they can't fall apart."""
    told = lambda values: F.struct(*[F.lit(v).alias(c) for c, v in zip(STANDING, values)])
    by_type = lambda rules: [(source_type.isin(*types), told(v)) for types, v in rules]
    return ladder([*by_type(SOURCES), (F.contains(F.lower(source_name), F.lit(AGGREGATOR)), told(AGGREGATORS)), *by_type(LATER_SOURCES)], told(OTHER_SOURCES))


def _labels() -> dict[str, dict]:
    """What each fixed label tells: its kind, whether it is sensitive, and what being it is."""
    kinds = {"encounter": HAIRY_HUMANOID, "traditional": TRADITIONAL + HIGH_SENSITIVITY, "exclusion": EXCLUSION, "control": CONTROL}
    return {x: dict(kind=kind, sensitive=x in HIGH_SENSITIVITY, being="giant" if x in GIANTS else "spirit" if x in SPIRITS else None) for kind, labels in kinds.items() for x in labels}


def _looked_up(table: dict[str, dict], key: Column) -> Column:
    """The row of a small fixed table under a key, as a struct of all names in it; null if there is none. Spark folds the table into one literal, so the key's expression appears once."""
    names = {c: F.lit(None).cast("boolean" if any(isinstance(r.get(c), bool) for r in table.values()) else "string") for c in dict.fromkeys(c for r in table.values() for c in r)}
    rows = [x for k, r in table.items() for x in (F.lit(k), F.struct(*[(F.lit(r[c]) if r.get(c) is not None else null).alias(c) for c, null in names.items()]))]
    return F.element_at(F.create_map(*rows), key)


def classified(rows: DataFrame) -> DataFrame:
    """rows with FIELDS, and ``label``: their label as given.

    rows has the columns source_type, source_name, figure_name_as_printed, canonical_figure_guess, canonical_name, title, snippet, include_status,
    involves_indigenous_knowledge, full_text_path and year. Nulls count as empty texts, false, and no year; a row without any label has UNLABELLED. Labels, titles and
    snippets are compared in normal form. One projection: nothing is shuffled, and the kinds are tried in order, the first met decides.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    kind, name = text("source_type"), text("source_name")
    given = rows.withColumn("label", first_given("figure_name_as_printed", "canonical_figure_guess", "canonical_name", F.lit(UNLABELLED))).withColumn("_l", normalised(F.col("label")))
    given = given.withColumns({"_t": F.concat_ws(" ", "_l", normalised(F.col("title")), normalised(F.col("snippet"))), "_known": _looked_up(_labels(), F.col("_l")), "_s": standing(kind, name)})
    label, words, status = F.col("_known"), F.col("_t"), text("include_status")
    related = F.coalesce(F.col("involves_indigenous_knowledge").cast("boolean"), F.lit(False))
    of = ladder(
        [
            ((label["kind"] == "control") | (status == "control_only"), "control"),
            ((label["kind"] == "exclusion") | (status == "exclude_core"), "exclusion"),
            (kind == "academic_metadata", "catalogue"),
            ((label["kind"] == "traditional") | related, "traditional"),
            ((label["kind"] == "encounter") | (text("canonical_name") == HAIRY_FIGURE), "encounter"),
        ],
        "pointer",
    )
    care = ladder([(label["sensitive"] | mentions(words, SENSITIVE_WORDS), "high"), (related, "related")], "none")
    aggregated = F.contains(name, F.lit(AGGREGATOR_TITLE))
    reprinted = aggregated & (mentions(words, REPRINT_WORDS) | F.coalesce((F.col("year") != 0) & (F.col("year") < REPRINT_BEFORE), F.lit(False)))
    tale = ladder([(F.contains(words, F.lit(GIANT_WORD)) | (label["being"] == "giant"), "giant_or_ogre_narrative"), (F.contains(words, F.lit(SPIRIT_WORD)) | (label["being"] == "spirit"), "spirit_person_narrative")], "traditional_narrative")
    publication = ladder([(reprinted, "archive_reproduction"), (aggregated, "retrospective_summary")], "witness_account_publication")
    told = given.withColumns({"_k": of, "_care": care, "_tale": tale, "_publication": publication, "_related": related})

    k, tier = F.col("_k"), F.col("_s.source_tier")
    fixed, cared = _looked_up(KINDS, k), _looked_up({c: dict(zip(("cultural_sensitivity", "ethics_review_status", "display_mode"), v)) for c, v in CARE.items()}, F.col("_care"))
    traditional, encounter = k == "traditional", k == "encounter"
    own = {
        "narrative_type": F.when(traditional, F.col("_tale")),
        "secondary_role": F.when(traditional & kind.isin("modern_web", "internet_archive_metadata"), "heritage_discourse"),
        "relationship_type": ladder([(traditional & (tier == "A"), "original_publication"), (traditional, "derivative_web_summary"), (encounter, F.col("_publication"))]),
        "label_type": ladder([(encounter & (F.col("_l") == "yowie"), "exact_name"), (encounter, "historical_descriptor")]),
        "entity_concept_key": ladder([((k == "catalogue") & F.col("_related"), TRADITIONAL_CLUSTER), (k == "catalogue", UNRESOLVED)]),
    } | {c: cared[c] for c in ("cultural_sensitivity", "ethics_review_status", "display_mode")}
    reviewed = ~k.isin("control", "exclusion")
    flags = [
        (~reviewed, k),
        (reviewed & (F.col("_care") == "high"), "high_sensitivity"),
        (reviewed & (F.col("_care") == "related"), "indigenous_related"),
        (reviewed & (kind == "internet_archive_metadata") & (text("full_text_path") == ""), "item_text_requires_inspection"),
        (encounter & (F.col("_publication") == "archive_reproduction"), "original_article_verification_required"),
        (k == "catalogue", "metadata_only_not_accepted"),
        (k == "pointer", "requires_manual_classification"),
    ]
    fields = {c: F.coalesce(*[v for v in (fixed[c] if c in CONSTANT else None, own.get(c)) if v is not None]) for c in FIELDS if c in CONSTANT or c in own}
    fields |= {c: F.col(f"_s.{c}") for c in STANDING} | {"review_flags": F.array_compact(F.array(*[F.when(c, v) for c, v in flags]))}
    return told.select(*[c for c in rows.columns if c not in (*FIELDS, "label")], "label", *[fields[c].alias(c) for c in FIELDS])
