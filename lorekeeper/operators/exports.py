"""What the archive gives out: review tables with fixed fields in a fixed order, and the counts, summary and map layers of its public data."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lorekeeper.operators.periods import band_of, leading_year
from lorekeeper.operators.promotion import first_given

#: Fields of the exports (fixed values).
RECORD_FIELDS = "record_id year date_published title publication url location_summary canonical_figure_guess figure_name_as_printed snippet relevance_code ontology_code humanoid_degree_code source_voice genre publicness_code ethics_flag notes".split()
RECORD_OWN = "record_id year date_published title publication url snippet".split()
ALIAS_FIELDS = "figure_id canonical_name cluster tier include_status humanoid_degree ontology_default involves_indigenous_knowledge sensitivity_notes alias_id alias alias_type search_priority notes".split()
PLAN_FIELDS = "query_id source_name source_type canonical_name query_string query_type date_start date_end expected_noise_level status notes".split()
ATTENTION_FIELDS = "attention_id canonical_name source_name source_type term date value geo metric_type notes".split()
LOCATION_FIELDS = "record_id year title place_name region state_territory country latitude longitude location_type verification_status relation_type evidence_text confidence notes".split()
ITEM_FIELDS = "source_item_id legacy_record_id source_id external_id title publication_or_organisation author_or_creator publication_date_text publication_date_start publication_date_end publication_date_precision access_date url canonical_url persistent_identifier source_type source_tier source_mediation publicness_status rights_access_status reproduction_status raw_snapshot_path raw_snapshot_sha256 extracted_text_path text_or_ocr_status source_traceability_status created_at updated_at".split()
NARRATIVE_FIELDS = "narrative_id narrative_type secondary_role working_title public_summary narrative_status analysis_status humanoid_basis australia_relation earliest_attestation_start earliest_attestation_end earliest_attestation_precision circulation_period_start circulation_period_end cultural_sensitivity ethics_review_status display_mode normalized_entity_concept_id classification_confidence created_at updated_at".split()
QUEUE_FIELDS = "legacy_record_id source_item_id narrative_id primary_record_role migration_confidence review_flags title source_type source_tier narrative_type secondary_role analysis_status ethics_review_status display_mode".split()
PLACE_FIELDS = "place_name region state_territory country latitude longitude".split()
#: Exports that are whole relations, with their keys (fixed values).
WHOLE = {
    "encounter_events_review": ("encounter_events", "encounter_event_id"),
    "narrative_source_links": ("narrative_source_links", "narrative_source_link_id"),
    "narrative_relations": ("narrative_relations", "narrative_relation_id"),
    "entity_labels_review": ("entity_labels", "entity_label_id"),
    "entity_concepts": ("entity_concepts", "entity_concept_id"),
    "leads": ("leads", "lead_id"),
    "exclusions": ("exclusions", "exclusion_id"),
}
#: States that wait for a review, and candidates' states by export (fixed values).
WAITING = ("display_ready_unreviewed", "review_required", "lead_only", "exclusion", "control")
CANDIDATES = {"collection_500_accepted": ("accepted",), "collection_500_rejected": ("rejected", "duplicate", "lead_only")}
#: What stands for a missing value in counts and layers, the role that has no layer and the display that hides a narrative (fixed values).
UNTYPED, UNKNOWN, NO_STATE, NO_ROLE, NO_LAYER, HIDDEN = "untyped", "unknown", "AU_UNSPECIFIED", "uncertain_or_broad_location", "publication_location", "suppressed"
#: Summary counts by family and the values that each sums (fixed values).
SUMMARY = {
    "encounter_account_count": ("narrative_types", ["encounter_account"]),
    "apparition_account_count": ("narrative_types", ["apparition_account"]),
    "ghost_legend_count": ("narrative_types", ["ghost_legend"]),
    "rumour_local_legend_count": ("narrative_types", ["rumour_account", "local_legend"]),
    "traditional_spirit_person_count": ("narrative_types", ["traditional_narrative", "spirit_person_narrative", "giant_or_ogre_narrative"]),
    "retelling_adaptation_count": ("narrative_types", ["retelling_or_adaptation"]),
    "discourse_context_count": ("narrative_types", ["heritage_discourse", "tourism_discourse", "media_commentary", "scholarly_commentary", "catalogue_metadata"]),
    "unresolved_lead_count": ("analysis_status", ["lead_only"]),
    "analysis_ready_count": ("analysis_status", ["analysis_ready"]),
    "high_sensitivity_count": ("sensitivity", ["high", "very_high"]),
}
#: Summary counts that are numbers of rows.
ROWS = {"source_item_count": "source_items", "narrative_unit_count": "narrative_units", "entity_concept_count": "entity_concepts", "source_label_count": "entity_labels"}

Tables = dict[str, DataFrame]


class Export(NamedTuple):
    """Rows of an export, its fields in order, and the order of its rows. A field that the rows lack is empty."""

    rows: DataFrame
    fields: list[str]
    order: list[str]


def located(bridge: DataFrame, locations: DataFrame) -> DataFrame:
    """Rows of a bridge with their place's columns; those of no known place go."""
    told = [c for c in locations.columns if c == "location_id" or c not in bridge.columns]
    return bridge.join(locations.select(told), "location_id")


def location_summary(record_locations: DataFrame, locations: DataFrame) -> DataFrame:
    """(record_id, location_summary): each place with its state, else its region, and how sure it is, in the order of names; one text a record."""
    where = first_given("state_territory", "region")
    part = F.concat(F.coalesce("place_name", F.lit("")), F.when(where.isNotNull(), F.concat(F.lit(" ("), where, F.lit(")"))).otherwise(""), F.lit(": "), F.coalesce("confidence", F.lit("")))
    rows = located(record_locations.select("record_id", "location_id", "confidence"), locations).select("record_id", F.struct(F.col("place_name").alias("name"), F.col("location_id").alias("id"), part.alias("part")).alias("p"))
    return rows.groupBy("record_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["part"]), "; ").alias("location_summary"))


def record_exports(t: Tables) -> dict[str, Export]:
    """The five review exports of records, coding, figures, aliases, queries, attention_series, sources, record_locations and locations.

    Records that are restricted or out of scope by their level or their codes are not given out; nulls count as neither.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    own = [c for c in t["records"].columns if c in RECORD_OWN or c == "publicness_level"]
    codes = t["coding"].select([c for c in t["coding"].columns if c == "record_id" or c in RECORD_FIELDS and c not in RECORD_OWN])
    public = t["records"].select(own).join(codes, "record_id", "left").where((blank("publicness_level") != "restricted_excluded") & (blank("publicness_code") != "restricted_excluded") & (blank("relevance_code") != "scope_excluded"))
    records = public.join(location_summary(t["record_locations"], t["locations"]), "record_id", "left")
    names, sources = t["figures"].select("figure_id", "canonical_name"), t["sources"].select("source_id", "source_name", "source_type")
    places = located(t["record_locations"], t["locations"]).join(t["records"].select("record_id", "year", "title"), "record_id")
    return {
        "records_review": Export(records, RECORD_FIELDS, ["year", "record_id"]),
        "figures_aliases": Export(t["figures"].drop("notes").join(t["aliases"], "figure_id", "left").withColumn("_first", -F.col("search_priority")), ALIAS_FIELDS, ["cluster", "canonical_name", "_first", "alias", "alias_id"]),
        "query_plan": Export(t["queries"].join(sources, "source_id").join(names, "figure_id", "left"), PLAN_FIELDS, ["source_type", "canonical_name", "date_start", "query_string", "query_id"]),
        "attention_series": Export(t["attention_series"].join(sources, "source_id").join(names, "figure_id", "left"), ATTENTION_FIELDS, ["term", "date", "attention_id"]),
        "record_locations": Export(places, LOCATION_FIELDS, ["year", "record_id", "place_name", "location_id", "relation_type"]),
    }


def review_queue(mappings: DataFrame, items: DataFrame, narratives: DataFrame) -> DataFrame:
    """QUEUE_FIELDS of mappings that wait for a review: by their narrative's state, else their own role, or with flags other than none ([]; null flags wait too)."""
    told = items.select("source_item_id", "title", "source_type", "source_tier")
    states = narratives.select("narrative_id", "narrative_type", "secondary_role", "analysis_status", "ethics_review_status", "display_mode")
    j = mappings.join(told, "source_item_id").join(states, "narrative_id", "left")
    waits = F.coalesce("analysis_status", "primary_record_role").isin(*WAITING)
    return j.where(F.coalesce(waits, F.lit(False)) | (F.coalesce("review_flags", F.lit("")) != "[]")).select(QUEUE_FIELDS)


def archive_exports(t: Tables) -> dict[str, Export]:
    """The thirteen review exports of the normalised archive: items, narratives, relations given whole, located narratives, the review queue, and candidates by what became of them."""
    out = {
        "source_items_review": Export(t["source_items"], ITEM_FIELDS, ["source_item_id"]),
        "narrative_units_review": Export(t["narrative_units"], NARRATIVE_FIELDS, ["narrative_id"]),
    }
    out |= {name: Export(t[table], t[table].columns, [key]) for name, (table, key) in WHOLE.items()}
    places = t["narrative_locations"]
    out["narrative_locations_review"] = Export(located(places, t["locations"]), places.columns + [c for c in PLACE_FIELDS if c not in places.columns], ["narrative_location_id"])
    out["review_queue"] = Export(review_queue(t["legacy_record_mappings"], t["source_items"], t["narrative_units"]), QUEUE_FIELDS, ["legacy_record_id"])
    candidates = t["collection_candidates_v2"]
    out |= {name: Export(candidates.where(F.col("candidate_status").isin(*states)), candidates.columns, ["candidate_id"]) for name, states in CANDIDATES.items()}
    return out


def map_layers(t: Tables) -> DataFrame:
    """Located narratives that are not hidden, with their ``layer``: their role. Places of publication have none."""
    told = t["narrative_units"].where("display_mode <> 'suppressed'").select("narrative_id", "narrative_type", "display_mode", "working_title")
    layer = first_given("location_role", F.lit(NO_ROLE))
    return located(t["narrative_locations"], t["locations"]).join(told, "narrative_id").withColumn("layer", layer).where(F.col("layer") != NO_LAYER)


def _families(df: DataFrame, **values: Column) -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("family"), v.alias("value")) for k, v in values.items()])).alias("f")).select("f.*")


def public_counts(t: Tables, bands: list[tuple[str, int, int]]) -> DataFrame:
    """(family, value, n): how often every type, state, tier, organisation, role, band and so on occurs; all families take one shuffle.

    Roles and states are those of located narratives that are not hidden. Missing values count under a name of their own. ``sensitivity`` is for the summary.
    """
    visible = t["narrative_units"].where("display_mode <> 'suppressed'").select("narrative_id")
    places = located(t["narrative_locations"].join(visible, "narrative_id", "left_semi"), t["locations"])
    other = F.lit(UNKNOWN)
    told = [
        _families(t["narrative_units"], narrative_types=first_given("narrative_type", "secondary_role", F.lit(UNTYPED)), analysis_status=first_given("analysis_status", other), sensitivity=first_given("cultural_sensitivity", other), date_bands=band_of(leading_year(F.col("earliest_attestation_start").cast("string")), bands)),
        _families(t["source_items"], source_tiers=first_given("source_tier", other), source_organisations=first_given("publication_or_organisation", other)),
        _families(places, location_roles=first_given("location_role", other), states=first_given("state_territory", F.lit(NO_STATE))),
        _families(t["collection_candidates_v2"], collection_candidates=first_given("candidate_status", other)),
    ]
    return told[0].unionAll(told[1]).unionAll(told[2]).unionAll(told[3]).groupBy("family", "value").agg(F.count("*").alias("n"))


def public_summary(t: Tables, counts: DataFrame) -> DataFrame:
    """One row of the summary's counts: sums over public_counts, and numbers of rows."""
    sums = [F.coalesce(F.sum(F.when((F.col("family") == family) & F.col("value").isin(values), F.col("n"))), F.lit(0)).alias(name) for name, (family, values) in SUMMARY.items()]
    out = counts.agg(*sums)
    for name, table in ROWS.items():
        out = out.crossJoin(t[table].agg(F.count("*").alias(name)))  # of single rows
    return out


def write_exports(exports: dict[str, Export], folder: str, version: str | None = None) -> dict[str, int]:
    """Every export as a folder of CSV parts whose names follow the rows' order, each part with a header; returns how many rows each has.

    Values are written as texts and nulls empty; with a version it is the first column. Rows are counted as they are written. An
    export without rows is one part with a header.
    """
    written = {}
    for name, e in exports.items():
        seen = Observation(name)
        fields = [(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in e.rows.columns else F.lit("")).alias(c) for c in e.fields]
        version_field = [F.lit(version).alias("schema_version")] if version is not None else []
        out = e.rows.orderBy(*e.order).select(*version_field, *fields).observe(seen, F.count("*").alias("n"))
        out.write.mode("overwrite").options(header=True, emptyValue="").csv(f"{folder}/{name}")
        written[name] = seen.get["n"]
    return written
