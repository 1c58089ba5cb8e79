"""Sources: checked CSV, JSON, whole texts by path, configuration files, and a collector as a data source."""

from __future__ import annotations

import io
import json
import re
import zipfile
from abc import ABC, abstractmethod
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructType


class MissingColumns(ValueError):
    pass


def read_csv(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """A CSV with a header as strings; a byte order mark goes, quoted line ends stay, and required columns must be there."""
    df = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    if missing := [c for c in required if c not in df.columns]:
        raise MissingColumns(", ".join(missing))
    return df


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def texts_by_path(spark: SparkSession, folder: str, paths: DataFrame, path_col: str = "path") -> DataFrame:
    """paths with the text of each file; a missing file has the empty text.

    A path is relative to the folder, or else begins with the folder's own name.
    """
    folder = folder.rstrip("/")
    below = F.regexp_extract(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), re.escape(folder) + "/(.*)$", 1)
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True).select(below.alias("_below"), F.col("value").alias("_text"))
    names = F.posexplode(F.array("_below", F.concat(F.lit(folder.rsplit("/", 1)[-1] + "/"), "_below"))).alias("_rank", "_name")
    named = files.select("_text", names).groupBy("_name").agg(F.min_by("_text", "_rank").alias("_text"))
    return paths.join(named, F.col(path_col) == F.col("_name"), "left").select(*paths.columns, F.coalesce("_text", F.lit("")).alias("text"))


def has_table(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether a folder's table is there and can be read."""
    return columns_of(spark, sf_dir, name) is not None


def columns_of(spark: SparkSession, sf_dir: str, name: str) -> list[str] | None:
    """The columns of a folder's table, from its footer alone; None where there is no such table."""
    try:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").columns
    except AnalysisException:
        return None


def read_config(path: str, section: str | None = None) -> dict | list:
    """A JSON or YAML file of settings: small, so the driver reads it. A section must be a list."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        found = json.loads(text)
    except ValueError:
        import yaml  # only where YAML files are used

        found = yaml.safe_load(text)
    if not isinstance(found, dict):
        raise ValueError(f"{path} holds no mapping")
    if section is None:
        return found
    if not isinstance(found.get(section), list):
        raise ValueError(f"{section} in {path} is no list")
    return found[section]


def dimension(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A configured list as a small frame; keys outside the schema are left out, missing ones null."""
    names = spark.createDataFrame([], schema).columns
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def docx_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): the runs of text of word-processor files, read by executors file by file."""
    @F.pandas_udf(StringType())
    def text_of(content: pd.Series) -> pd.Series:
        def one(data: bytes) -> str:
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                return unescape(" ".join(re.findall(r"<w:t[^>]*>([^<]*)</w:t>", z.read("word/document.xml").decode())))

        return content.map(one)

    return spark.read.format("binaryFile").load(path).select("path", text_of("content").alias("text"))


def article_metadata(html_col: str = "html"):
    """The first Article of a page's linked-data script, alone or in its graph: struct<headline, datePublished>."""
    item = "`@type` string, headline string, datePublished string"
    raw = F.regexp_extract(html_col, r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>", 1)
    parsed = F.from_json(raw, f"`@graph` array<struct<{item.replace(' string', ': string')}>>, {item}")
    own = F.struct(parsed["@type"].alias("@type"), parsed["headline"].alias("headline"), parsed["datePublished"].alias("datePublished"))
    everything = F.concat(F.array(own), F.coalesce(parsed["@graph"], F.array().cast(f"array<struct<{item.replace(' string', ': string')}>>")))
    articles = F.filter(everything, lambda x: x["@type"].isin("Article", "NewsArticle"))
    return F.get(articles, 0)


def sitemap_locations(xml_col: str = "xml"):
    """Addresses of a sitemap, plain or in CDATA."""
    return F.transform(F.regexp_extract_all(xml_col, F.lit(r"(?s)<loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</loc>"), F.lit(1)), F.trim)


class Collector(ABC):
    """What collects candidates: named parts, each of which an executor turns into rows."""

    schema: str

    @abstractmethod
    def parts(self) -> list[str]: ...

    @abstractmethod
    def collect(self, part: str) -> Iterator[tuple]: ...


class StubCollector(Collector):
    """Leads for queries that no connector answers here: without a network nothing is fetched."""

    schema = "query string, status string"

    def __init__(self, queries: list[str]):
        self.queries = queries

    def parts(self) -> list[str]:
        return self.queries

    def collect(self, part: str) -> Iterator[tuple]:
        yield part, "lead_only"


class _Reader(DataSourceReader):
    def __init__(self, collector: Collector):
        self.collector = collector

    def partitions(self):
        return [InputPartition(p) for p in self.collector.parts()]

    def read(self, partition):
        yield from self.collector.collect(partition.value)


def collected(spark: SparkSession, collector: Collector, name: str = "collector") -> DataFrame:
    """A collector's rows as a frame, one partition a part."""

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return collector.schema

        def reader(self, schema):
            return _Reader(collector)

    spark.dataSource.register(Source)
    return spark.read.format(name).load()
