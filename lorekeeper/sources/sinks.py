"""Sinks: CSV with fixed fields, staged JSON lines, the nested export, manifests and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, fields: list[str], schema_version: str | None = None) -> None:
    """Fields in their order, missing columns and nulls empty; a leading version column if one is given."""
    columns = [(F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in fields]
    out = df.select(*([F.lit(schema_version).alias("schema_version")] if schema_version else []), *[F.coalesce(c, F.lit("")).alias(n) for c, n in zip(columns, fields)])
    out.write.mode("overwrite").options(header=True, emptyValue="").csv(path)


def stage(df: DataFrame, path: str, route_col: str = "route_id") -> None:
    """Candidates as JSON lines, a folder a route; routes that come again replace their own folder only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(route_col).json(path)


def export_sections(sections: dict[str, DataFrame], path: str) -> None:
    """The export document as one folder of JSON lines a section, written by executors; no section is gathered."""
    for name, df in sections.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def nested_document(summary: DataFrame, sections: dict[str, DataFrame], order: dict[str, list[str]]) -> DataFrame:
    """One row of JSON for consumers that want a single document: the sections have to be small, such as bands and rollups."""
    out = summary.select(F.struct("*").alias("summary"))
    for name, df in sections.items():
        rows = df.agg(F.sort_array(F.collect_list(F.struct(*order[name], *[c for c in df.columns if c not in order[name]]))).alias(name))
        out = out.crossJoin(rows)  # of single rows
    return out.select(F.to_json(F.struct("*")).alias("document"))


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(file, bytes, sha256) of every file under a folder, each read by one task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def changed_files(old: DataFrame, new: DataFrame) -> DataFrame:
    """Files of the new manifest that the old one lacks or holds otherwise."""
    return new.join(old.select("file", "sha256"), ["file", "sha256"], "left_anti")


def report(title: str, counts: DataFrame, label: str, n: str, limit: int = 50) -> str:
    """A Markdown table of the largest counts with their shares."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    rows = counts.orderBy(F.desc(n), label).limit(limit).collect()  # of limit rows at most
    return "\n".join([f"# {title}", "", f"| {label} | {n} | share |", "|---|---|---|", *(f"| {r[label]} | {r[n]} | {100 * r[n] / total:.1f} % |" for r in rows)]) + "\n"
