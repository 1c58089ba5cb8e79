"""Checks of a release: forbidden words anywhere in nested values, counts that have to agree, and parity of two relations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

#: Words of a record's status that keep it from a release, and parts of names of fields that are internal (fixed values).
WITHHELD = ("restricted", "suppressed", "rejected")
INTERNAL = ("raw_", "candidate_id", "run_id", "collection_run", "crawler", "snapshot_sha")
STATUS = ("publicness_level", "publicness_code", "relevance_code", "ethics_flag", "ingestion_status")


def _texts(kind: DataType, path: str) -> list[tuple[str, Callable[[Column], Column]]]:
    """(path, the array of texts there) of every text within a value of this type; [] stands for an array's elements, {} for a map's values and {keys} for its keys."""
    if isinstance(kind, StringType):
        return [(path, lambda c: F.array(c))]
    # Functions of one argument each: what is bound comes from the enclosing calls.
    within = lambda name, get: lambda c: get(c[name])
    each = lambda of, get: lambda c: F.flatten(F.transform(of(c), lambda x: F.coalesce(get(x), F.array().cast("array<string>"))))  # noqa: E731  nothing is null within
    if isinstance(kind, StructType):
        return [(p, within(f.name, get)) for f in kind.fields for p, get in _texts(f.dataType, f"{path}.{f.name}" if path else f.name)]
    if isinstance(kind, ArrayType):
        return [(p, each(lambda c: c, get)) for p, get in _texts(kind.elementType, f"{path}[]")]
    if isinstance(kind, MapType):
        keys = [(p, each(F.map_keys, get)) for p, get in _texts(kind.keyType, f"{path}{{keys}}")]
        return keys + [(p, each(F.map_values, get)) for p, get in _texts(kind.valueType, f"{path}{{}}")]
    return []


def paths_with(df: DataFrame, keys: list[str], words: list[str], any_case: bool = False) -> DataFrame:
    """(keys, path, word): where in the values of a row, however nested, a word is part of a text. One expression over the scan, built from the schema."""
    fold = F.lower if any_case else lambda x: x
    holds = lambda w: lambda x: F.coalesce(F.contains(fold(x), F.lit(w.lower() if any_case else w)), F.lit(False))
    found = []
    for field in df.schema.fields:
        for path, get in _texts(field.dataType, field.name):
            texts = get(df[f"`{field.name}`"])
            for word in words:
                found.append(F.when(F.exists(texts, holds(word)), F.struct(F.lit(path).alias("path"), F.lit(word).alias("word"))))
    if not found:
        return df.select(*keys, F.lit("").alias("path"), F.lit("").alias("word")).limit(0)
    return df.select(*keys, F.explode(F.array_compact(F.array(*found))).alias("_at")).select(*keys, "_at.path", "_at.word")


def field_names(kind: DataType, path: str = "") -> list[str]:
    """The paths of all fields of a schema."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for own in [f"{path}.{f.name}" if path else f.name] for p in [own, *field_names(f.dataType, own)]]
    if isinstance(kind, ArrayType):
        return field_names(kind.elementType, f"{path}[]")
    return field_names(kind.valueType, f"{path}{{}}") if isinstance(kind, MapType) else []


@dataclass
class Release:
    """What is released: records (record_id, source_id, ...), map_points and map_flags (record_id), date_bands (record_count), sources (source_id), and
    the summary, one row (record_count, mapped_record_count, source_rollup and mapped_state_counts, maps of counts)."""

    records: DataFrame
    map_points: DataFrame
    map_flags: DataFrame
    date_bands: DataFrame
    sources: DataFrame
    summary: DataFrame

    def _lacks(self, *columns: str) -> DataFrame:
        """Records with nothing in any of those columns that there are."""
        here = [F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "" for c in columns if c in self.records.columns]
        return self.records.where(reduce(lambda a, b: a & b, here, F.lit(True)))

    def _agree(self, *counts: DataFrame) -> DataFrame:
        """A row where counts, each a frame of one row and column, are not all equal; a missing one agrees with none."""
        one = reduce(DataFrame.unionAll, [c.toDF("n").select(F.col("n").cast("long")) for c in counts]).agg(F.min("n").alias("a"), F.max("n").alias("b"), F.count("n").alias("told"))
        return one.where((F.col("told") < len(counts)) | (F.col("a") != F.col("b"))).select(F.lit(None).cast("string").alias("record_id"))

    def offenders(self) -> dict[str, tuple[str, DataFrame]]:
        """Of every check its level, and the record_id of what fails it."""
        repeated = lambda df: df.groupBy("record_id").agg(F.count("*").alias("n")).where("n > 1")
        size = lambda df: df.agg(F.count("*"))
        summed = lambda m: self.summary.select(F.aggregate(F.map_values(m), F.lit(0).cast("long"), lambda x, y: x + F.coalesce(y, F.lit(0)).cast("long")))
        status = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in STATUS if c in self.records.columns]))
        internal = [p for p in field_names(self.records.schema) if any(t in p.rsplit(".", 1)[-1].lower() for t in INTERNAL)]
        none = self.records.limit(0)
        return {
            "public_records_unique_by_record_id": ("error", repeated(self.records)),
            "map_flags_unique_by_record_id": ("error", repeated(self.map_flags)),
            "map_points_unique_by_record_id": ("error", repeated(self.map_points)),
            "every_map_flag_references_public_record": ("error", self.map_flags.join(self.records.select("record_id"), "record_id", "left_anti")),
            "map_flag_count_equals_mapped_record_count": ("error", self._agree(self.summary.select("mapped_record_count"), size(self.map_points), size(self.map_flags))),
            "no_suppressed_rejected_restricted_records": ("error", self.records.where(reduce(lambda a, b: a | b, [F.contains(status, F.lit(w)) for w in WITHHELD]))),
            "every_public_record_has_title": ("error", self._lacks("title")),
            "every_public_record_has_source_name": ("error", self._lacks("source_name", "source_organisation")),
            "every_public_record_has_narrative_or_source_type": ("warning", self._lacks("ontology_code", "genre", "canonical_figure_guess", "canonical_figure", "source_type")),
            "every_public_record_has_url_or_identifier": ("warning", self._lacks("url", "external_id")),
            "no_raw_internal_fields_in_public_records": ("error", self.records if internal else none),
            "summary_record_count_reconciles": ("error", self._agree(self.summary.select("record_count"), size(self.records))),
            "date_band_totals_reconcile": ("error", self._agree(self.date_bands.agg(F.sum("record_count")), size(self.records))),
            "source_rollups_reconcile": ("error", self._agree(summed("source_rollup"), size(self.records))),
            "map_state_counts_reconcile": ("error", self._agree(summed("mapped_state_counts"), size(self.map_flags))),
            "source_page_source_totals_reconcile": ("error", self.records.where("source_id is not null").join(self.sources.select("source_id"), "source_id", "left_anti")),
        }

    def checks(self) -> DataFrame:
        """(check_name, level, failures, first): how many rows fail each check, and the least record_id among them."""
        counted = [df.agg(F.count("*").alias("failures"), F.min(F.col("record_id").cast("string")).alias("first")).select(F.lit(name).alias("check_name"), F.lit(level).alias("level"), "failures", "first") for name, (level, df) in self.offenders().items()]
        return reduce(DataFrame.unionAll, counted)


def parity(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side, columns): keys that only one relation has, "missing" on the right or "extra" there, and those whose rows differ, with the columns that do.

    Rows of one key are a bag: a column differs when its values over the key's rows do. Digests are summed before they are shuffled, so
    keys of any number of rows are fine. Null keys are equal. Columns of one side only differ wherever they hold a value.
    """
    columns = sorted((set(left.columns) | set(right.columns)) - set(keys))

    def digests(df: DataFrame, side: int) -> DataFrame:
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        value = lambda c: F.to_json(F.struct(F.col(c))) if "map<" in kinds[c] else F.col(c)
        digest = lambda c, seed: F.xxhash64(F.lit(seed), value(c)).cast("decimal(38,0)") if c in kinds else F.xxhash64(F.lit(seed), F.lit(None).cast("string")).cast("decimal(38,0)")
        sums = [F.struct(F.sum(digest(c, 1)), F.sum(digest(c, 2))).alias(f"_{c}") for c in columns]
        return df.groupBy(*keys).agg(F.count("*").alias("_n"), *sums).select(*keys, F.lit(side).alias("_side"), "_n", *[f"_{c}" for c in columns])

    both = digests(left, 0).unionByName(digests(right, 1)).groupBy(*keys)
    of = lambda c, side: F.max(F.when(F.col("_side") == side, F.col(c)))
    met = both.agg(F.count_if(F.col("_side") == 0).alias("_l"), F.count_if(F.col("_side") == 1).alias("_r"), (of("_n", 0) != of("_n", 1)).alias("_rows"), *[(of(f"_{c}", 0) != of(f"_{c}", 1)).alias(f"_{c}") for c in columns])
    named = F.array_compact(F.array(F.when(F.col("_rows"), "(rows)"), *[F.when(F.col(f"_{c}"), c) for c in columns]))
    side = F.when(F.col("_r") == 0, "missing").when(F.col("_l") == 0, "extra").when(F.size(named) > 0, "differs")
    alone = (F.col("_r") == 0) | (F.col("_l") == 0)
    return met.select(*keys, side.alias("side"), F.when(alone, F.array().cast("array<string>")).otherwise(named).alias("columns")).where("side is not null")
