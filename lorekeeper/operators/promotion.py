"""Accepted candidates become records: ids allocated once, carried as keys through every relation."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekeeper.functions.text import collapsed
from lorekeeper.operators.ranking import first_by, numbered

#: What promoted rows say of themselves (fixed values).
RECORD_STATUS, REVIEWED, MEDIATION = "accepted_candidate_promoted", "accepted_candidate_reviewed", "public_candidate_review"
REPRODUCTION, OCR, TRACEABILITY = "metadata_or_short_excerpt_only", "public_summary_or_excerpt", "stable_public_url_or_identifier"
#: Columns of places that a later candidate with coordinates may fill, and the candidates' columns that fill them.
PLACE_FILLS = {"latitude": "latitude", "longitude": "longitude", "state_territory": "state_territory", "location_type": "location_precision", "geocode_source": "geocode_source", "verification_status": "geocode_verification_status"}


def first_given(*columns: Column | str) -> Column:
    """The first of some texts that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in columns])


class Promotion:
    """The rows that accepted candidates without a mapping add to every relation.

    candidates has candidate_id and the columns named below; tables has the relations that are there: sources (source_id,
    source_name, source_type), collection_runs (collection_run_id, run_name), locations (location_id, place_name and PLACE_FILLS), narrative_units
    (narrative_id, migration_key), mappings (candidate_id) and, as ``tops``, the greatest id of each relation. New ids follow
    those, records, items and narratives in the order of candidates, sources, runs and places in the order of the first candidate that
    needs one; numbers are checkpointed, so every relation tells the same ones. A relation is a lazy DataFrame. Nothing is new when
    the mappings that a promotion gave are among those of the next one.
    """

    def __init__(self, candidates: DataFrame, tables: dict[str, DataFrame], tops: dict[str, int]):
        self.candidates, self.tables, self.tops = candidates, tables, tops

    @cached_property
    def accepted(self) -> DataFrame:
        c = self.candidates.where("candidate_status = 'accepted'")
        return c.withColumns({
            "_source_name": first_given("source_name", "publication_or_organisation", F.lit("Unspecified public source")),
            "_source_type": first_given("source_type", F.lit("public_web")),
            "_named": F.nullif(collapsed(F.col("location_text")), F.lit("")),
            "_year": F.col("publication_date_text").try_cast("int"),
            "_public": first_given("publicness_status", F.lit("public")),
            "_quality": first_given("quality_class", F.lit("reviewed")),
            "_external": first_given("external_id", F.concat(F.lit("candidate-v2:"), F.col("candidate_id").cast("string"))),
            "_key": F.concat(F.lit("candidate:"), F.col("candidate_id").cast("string")),
        })

    @cached_property
    def waiting(self) -> DataFrame:
        """Candidates to promote, with the ids of their record and its source item."""
        open_rows = self.accepted.join(self.tables["mappings"].select("candidate_id"), "candidate_id", "left_anti")
        at = numbered(open_rows, ["candidate_id"], "_n")
        return at.withColumn("record_id", F.col("_n") + 1 + self.tops["records"]).withColumn("source_item_id", F.col("_n") + 1 + self.tops["source_items"]).drop("_n")

    def _allocated(self, keys: dict[str, str], table: str, id_col: str) -> DataFrame:
        """New rows of a dimension: the keys (its columns by the candidates') that no row has, each with the first candidate's columns and an id."""
        firsts = first_by(self.waiting.dropna(subset=list(keys)), list(keys), ["candidate_id"])
        known = self.tables[table].select(*[F.col(own).alias(f"_has{k}") for k, own in enumerate(keys.values())]).distinct()
        missing = firsts.join(known, [F.col(c) == F.col(f"_has{k}") for k, c in enumerate(keys)], "left_anti")
        return numbered(missing, ["candidate_id"], "_n").withColumn(id_col, F.col("_n") + 1 + self.tops[table])

    @cached_property
    def new_sources(self) -> DataFrame:
        rows = self._allocated({"_source_name": "source_name", "_source_type": "source_type"}, "sources", "source_id")
        base = F.regexp_extract(first_given("canonical_url", "url"), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
        return rows.select("source_id", F.col("_source_name").alias("source_name"), F.col("_source_type").alias("source_type"), base.alias("base_url"), F.col("_public").alias("publicness_level"))

    @cached_property
    def new_runs(self) -> DataFrame:
        return self._allocated({"run_id": "run_name"}, "collection_runs", "collection_run_id").select("collection_run_id", F.col("run_id").alias("run_name"))

    @cached_property
    def locations(self) -> DataFrame:
        """All places that candidates name, as they are afterwards: a place that is there keeps what it has; what is null is filled by the first candidate with coordinates that tells it."""
        candidates = self.waiting.dropna(subset=["_named"])
        placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
        told = lambda c: F.min(F.when(placed & F.col(c).isNotNull(), F.struct("candidate_id", F.col(c).alias("v"))))["v"]
        fills = candidates.groupBy("_named").agg(*[told(c).alias(f"_{own}") for own, c in PLACE_FILLS.items()])
        new = self._allocated({"_named": "place_name"}, "locations", "location_id")
        new = new.select("location_id", F.col("_named").alias("place_name"), *[F.col(c).alias(own) for own, c in PLACE_FILLS.items()], F.lit(True).alias("added"))
        old = self.tables["locations"].select("location_id", "place_name", *PLACE_FILLS, F.lit(False).alias("added"))
        both = old.unionByName(new).join(fills, F.col("place_name") == F.col("_named"))
        return both.select("location_id", "place_name", *[F.coalesce(own, f"_{own}").alias(own) for own in PLACE_FILLS], "added")

    @cached_property
    def keyed(self) -> DataFrame:
        """Candidates to promote with all of their keys, checkpointed once for all relations; location_id is null without a place."""
        sources = self.tables["sources"].groupBy("source_name", "source_type").agg(F.min("source_id").alias("source_id")).unionByName(self.new_sources.select("source_name", "source_type", "source_id"))
        runs = self.tables["collection_runs"].groupBy("run_name").agg(F.min("collection_run_id").alias("collection_run_id")).unionByName(self.new_runs.select("run_name", "collection_run_id"))
        rows = self.waiting.drop("source_id").join(sources.withColumnsRenamed({"source_name": "_source_name", "source_type": "_source_type"}), ["_source_name", "_source_type"], "left")
        rows = rows.join(runs.withColumnRenamed("run_name", "run_id"), "run_id", "left")
        rows = rows.join(self.locations.select(F.col("place_name").alias("_named"), "location_id"), "_named", "left")
        old = self.tables["narrative_units"].select(F.col("migration_key").alias("_key"), F.col("narrative_id").alias("_old"))
        rows = rows.join(old, "_key", "left")
        fresh = numbered(rows.where("_old is null").select("candidate_id"), ["candidate_id"], "_n")
        return rows.join(fresh, "candidate_id", "left").withColumn("narrative_id", F.coalesce("_old", F.col("_n") + 1 + self.tops["narrative_units"])).drop("_n").checkpoint()

    @cached_property
    def records(self) -> DataFrame:
        publication = first_given("publication_or_organisation", "source_name")
        return self.keyed.select("record_id", "source_id", F.col("_external").alias("external_id"), "title", publication.alias("publication"), F.col("publication_date_text").alias("date_published"), F.col("_year").alias("year"), "url", F.col("evidence_summary").alias("snippet"), F.col("rights_access_status").alias("access_status"), F.col("_public").alias("publicness_level"), F.lit(RECORD_STATUS).alias("ingestion_status"))

    @cached_property
    def coding(self) -> DataFrame:
        notes = F.concat(F.lit("Promoted from accepted candidate "), F.col("candidate_id").cast("string"), F.lit("; quality "), F.col("_quality"), F.lit("."))
        return self.keyed.select("record_id", F.col("source_label").alias("figure_name_as_printed"), F.col("narrative_type").alias("ontology_code"), F.col("humanoid_basis").alias("humanoid_degree_code"), F.col("source_type").alias("genre"), F.col("_public").alias("publicness_code"), F.lit("relevant").alias("relevance_code"), F.col("ethics_review_status").alias("ethics_flag"), notes.alias("notes"), F.lit("candidate_promotion").alias("coded_by"))

    @cached_property
    def source_items(self) -> DataFrame:
        # Year 0 counts as none.
        year = F.when(F.col("_year") != 0, F.col("_year").cast("string"))
        return self.keyed.select(
            "source_item_id", F.col("record_id").alias("legacy_record_id"), "source_id", F.col("_external").alias("external_id"), "title", year.alias("publication_date_start"), F.when(year.isNotNull(), "year").otherwise("unknown").alias("publication_date_precision"),
            "url", first_given("canonical_url", "url").alias("canonical_url"), F.lit(MEDIATION).alias("source_mediation"), F.col("_public").alias("publicness_status"), first_given("rights_access_status", F.lit("public_access_note_required")).alias("rights_access_status"),
            F.lit(REPRODUCTION).alias("reproduction_status"), F.lit(OCR).alias("text_or_ocr_status"), F.lit(TRACEABILITY).alias("source_traceability_status"),
        )

    @cached_property
    def narratives(self) -> DataFrame:
        year = F.when(F.col("_year") != 0, F.col("_year").cast("string"))
        mode = F.when(F.col("cultural_sensitivity").isin("high", "very_high"), "summary_only").otherwise("full")
        return self.keyed.where("_old is null").select("narrative_id", F.col("_key").alias("migration_key"), "narrative_type", F.col("title").alias("working_title"), F.col("evidence_summary").alias("public_summary"), year.alias("earliest_attestation_start"), F.when(year.isNotNull(), "year").otherwise("unknown").alias("earliest_attestation_precision"), mode.alias("display_mode"), F.col("_quality").alias("classification_confidence"))

    @cached_property
    def source_links(self) -> DataFrame:
        return self.keyed.where("_old is null").select("narrative_id", "source_item_id", F.lit("original_publication").alias("relationship_type"), F.col("_quality").alias("confidence"), F.lit(REVIEWED).alias("human_review_status"))

    @cached_property
    def labels(self) -> DataFrame:
        plain = collapsed(F.col("source_label"))
        return self.keyed.where(F.col("_old").isNull() & (plain != "")).select("source_item_id", "narrative_id", F.col("source_label").alias("label_text"), F.lower(plain).alias("normalized_text"), F.lit("source_or_institution_label").alias("label_type"), F.lit(REVIEWED).alias("review_status"))

    @cached_property
    def _located(self) -> DataFrame:
        role = first_given("location_role", F.lit("uncertain_or_broad_location"))
        return self.keyed.where("location_id is not null").withColumn("_role", role).withColumn("_evidence", first_given("coordinate_evidence_note", "evidence_summary"))

    @cached_property
    def record_locations(self) -> DataFrame:
        return self._located.select("record_id", "location_id", F.col("_role").alias("relation_type"), F.col("_evidence").alias("evidence_text"), F.col("_quality").alias("confidence"))

    @cached_property
    def narrative_locations(self) -> DataFrame:
        return self._located.select("narrative_id", "location_id", "source_item_id", F.col("_role").alias("location_role"), F.col("location_text").alias("location_text_as_printed"), "location_precision", F.col("geocode_verification_status").alias("verification_status"), F.col("_quality").alias("confidence"), F.lit(REVIEWED).alias("review_status"))

    @cached_property
    def mappings(self) -> DataFrame:
        return self.keyed.select("candidate_id", "record_id", "source_item_id", "narrative_id", "collection_run_id", F.lit("promoted").alias("promotion_status"))

    @cached_property
    def counters(self) -> DataFrame:
        known = self.tables["mappings"].select("candidate_id", F.lit(1).alias("_known")).distinct()
        return self.accepted.select("candidate_id").join(known, "candidate_id", "left").agg(F.count("*").alias("accepted_candidates"), F.count_if(F.col("_known").isNull()).alias("promoted"), F.count("_known").alias("already_mapped"))

    def relations(self) -> dict[str, DataFrame]:
        """The rows to add, by relation; locations holds changed rows too and replaces those of its ids."""
        return {
            "sources": self.new_sources, "collection_runs": self.new_runs, "records": self.records, "coding": self.coding, "source_items": self.source_items, "narrative_units": self.narratives, "narrative_source_links": self.source_links,
            "entity_labels": self.labels, "locations": self.locations, "record_locations": self.record_locations, "narrative_locations": self.narrative_locations, "mappings": self.mappings,
        }

    def key_faults(self) -> DataFrame:
        """(relation, key, faults): rows whose key no row of the relation that it points to has, there before or new."""
        r = self.relations()
        ids = {"source_id": r["sources"].select("source_id").union(self.tables["sources"].select("source_id")), "record_id": r["records"].select("record_id"), "source_item_id": r["source_items"].select("source_item_id"), "location_id": r["locations"].select("location_id"), "narrative_id": r["narrative_units"].select("narrative_id").union(self.tables["narrative_units"].select("narrative_id")), "collection_run_id": r["collection_runs"].select("collection_run_id").union(self.tables["collection_runs"].select("collection_run_id"))}
        points = [("records", "source_id"), ("coding", "record_id"), ("source_items", "source_id"), ("narrative_source_links", "narrative_id"), ("narrative_source_links", "source_item_id"), ("entity_labels", "narrative_id"), ("record_locations", "record_id"), ("record_locations", "location_id"), ("narrative_locations", "narrative_id"), ("narrative_locations", "location_id"), ("mappings", "record_id"), ("mappings", "source_item_id"), ("mappings", "narrative_id"), ("mappings", "collection_run_id")]
        fault = lambda name, key: r[name].select(key).join(ids[key], key, "left_anti").agg(F.count("*").alias("faults")).select(F.lit(name).alias("relation"), F.lit(key).alias("key"), "faults")
        out = fault(*points[0])
        for p in points[1:]:
            out = out.unionAll(fault(*p))
        return out
