"""The archive's relational model over the tables of a scale-factor folder.

Records, sources, figures, locations and their bridge are read from the star schema; texts, labels,
pages and events come as they are. Everything is lazy: columns that a query doesn't use never leave the scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The public period bands: id, first and last year. They are contiguous.
BANDS = [("b1995", 1995, 1995), ("b1996", 1996, 1996), ("b1997", 1997, 1997), ("b1998", 1998, 1998), ("b1999", 1999, 1999), ("b2000", 2000, 2001)]

#: The same model in SQL, for the queries' oracles.
PRELUDE = {
    "bands": "SELECT * FROM (VALUES ('b1995',1995,1995),('b1996',1996,1996),('b1997',1997,1997),('b1998',1998,1998),('b1999',1999,1999),('b2000',2000,2001)) t(band,first_year,last_year)",
    "sources": "SELECT c_custkey source_id, c_name source_name, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment END source_type, c_nationkey nation_id FROM customer",
    "records": "SELECT o_orderkey record_id, o_custkey source_id, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS year, strftime(o_orderdate, '%Y-%m-%d') date_text, CASE o_orderstatus WHEN 'P' THEN 'restricted_excluded' WHEN 'F' THEN 'public_page' END AS level, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS code, CASE WHEN o_orderkey % 19 = 0 THEN 'scope_excluded' WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'in_scope' END AS relevance, CAST(o_totalprice AS DECIMAL(18,2)) AS value, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders",
    "public_records": "SELECT * FROM records WHERE COALESCE(level,'') <> 'restricted_excluded' AND COALESCE(code,'') <> 'restricted_excluded' AND COALESCE(relevance,'') <> 'scope_excluded'",
    "places": "SELECT s_suppkey location_id, s_name place_name, n_name AS state, r_name AS region, -46.0 + CAST((s_suppkey * 37) % 400 AS DOUBLE) / 10 AS lat, 110.0 + CAST((s_suppkey * 53) % 460 AS DOUBLE) / 10 AS lon, n_nationkey AS nation_id FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey",
    "record_places": "SELECT l_orderkey record_id, l_suppkey location_id, l_partkey figure_id, l_returnflag relation, l_linestatus kind, l_linenumber AS priority, l_shipdate AS seen_at, CAST(l_quantity AS INT) AS quantity, CASE WHEN l_linenumber % 4 = 0 THEN ' ' ELSE l_returnflag || l_linestatus END AS evidence FROM lineitem",
    "figures": "SELECT p_partkey figure_id, p_brand AS figure, p_type AS cluster, p_size AS tier, p_name AS label FROM part",
}


class Archive:
    """One folder's tables as the archive's relations."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def bands(self) -> DataFrame:
        return self.spark.createDataFrame(BANDS, "band string, first_year int, last_year int")

    @cached_property
    def sources(self) -> DataFrame:
        kind = F.when(F.col("c_custkey") % 11 == 0, "").otherwise(F.col("c_mktsegment"))
        return self.table("customer").select(F.col("c_custkey").alias("source_id"), F.col("c_name").alias("source_name"), kind.alias("source_type"), F.col("c_nationkey").alias("nation_id"))

    @cached_property
    def records(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.table("orders").select(
            key.alias("record_id"),
            F.col("o_custkey").alias("source_id"),
            F.when(key % 17 != 0, F.year("o_orderdate")).alias("year"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"),
            F.when(F.col("o_orderstatus") == "P", "restricted_excluded").when(F.col("o_orderstatus") == "F", "public_page").alias("level"),
            F.when(key % 5 == 0, "").otherwise(F.col("o_orderpriority")).alias("code"),
            F.when(key % 19 == 0, "scope_excluded").when(key % 3 != 0, "in_scope").alias("relevance"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("value"),
            F.month("o_orderdate").alias("month"),
        )

    @cached_property
    def public_records(self) -> DataFrame:
        return self.records.where(is_public())

    @cached_property
    def places(self) -> DataFrame:
        nation = self.table("nation").join(F.broadcast(self.table("region")), F.col("r_regionkey") == F.col("n_regionkey"))  # 25 and 5 rows at any scale
        key = F.col("s_suppkey")
        return self.table("supplier").join(F.broadcast(nation), F.col("n_nationkey") == F.col("s_nationkey")).select(
            key.alias("location_id"),
            F.col("s_name").alias("place_name"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("region"),
            (F.lit(-46.0) + (key * 37 % 400).cast("double") / 10).alias("lat"),
            (F.lit(110.0) + (key * 53 % 460).cast("double") / 10).alias("lon"),
            F.col("n_nationkey").alias("nation_id"),
        )

    @cached_property
    def record_places(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("record_id"),
            F.col("l_suppkey").alias("location_id"),
            F.col("l_partkey").alias("figure_id"),
            F.col("l_returnflag").alias("relation"),
            F.col("l_linestatus").alias("kind"),
            F.col("l_linenumber").alias("priority"),
            F.col("l_shipdate").alias("seen_at"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.when(F.col("l_linenumber") % 4 == 0, " ").otherwise(F.concat("l_returnflag", "l_linestatus")).alias("evidence"),
        )

    @cached_property
    def figures(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("figure_id"), F.col("p_brand").alias("figure"), F.col("p_type").alias("cluster"), F.col("p_size").alias("tier"), F.col("p_name").alias("label"))


def is_public() -> Column:
    """Neither restricted nor out of scope; null counts as the empty string."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return (blank("level") != "restricted_excluded") & (blank("code") != "restricted_excluded") & (blank("relevance") != "scope_excluded")
