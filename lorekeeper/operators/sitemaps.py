"""Sitemaps that were landed as files, walked from their roots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeeper.operators.ranking import first_by
from lorekeeper.operators.storage import shared_folder
from lorekeeper.sources.readers import sitemap_locations


def walk(files: DataFrame, roots: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(visited, pages): what is found from ``roots`` (root, url) over landed ``files`` (url, xml).

    visited has (root, url, place): the sitemaps of each root in the order in which a queue visits them, ``limit`` of them at most, those that were not
    landed too. pages has (root, url): the other addresses on visited sitemaps that were landed. An address beginning with http is a sitemap when it ends in .xml or
    has "sitemap" in its path. Each round takes a whole layer of all roots by one join, ordered by the place of the sitemap that names an address
    and its place there, so a root's places are those of a queue, cycles end, and rounds follow the depth of the maps and not their number.
    """
    shared_folder(files.sparkSession)
    address = F.col("loc.url")
    path = F.lower(F.regexp_extract(address, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1))
    landed = files.groupBy("url").agg(F.min("xml").alias("xml"))
    named = landed.select(F.col("url").alias("by"), F.posexplode(sitemap_locations("xml"))).select("by", F.struct(F.col("col").alias("url")).alias("loc"), F.col("pos").alias("at")).where(F.startswith(address, F.lit("http")))
    named = named.select("by", address.alias("url"), "at", (F.endswith(address, F.lit(".xml")) | F.contains(path, F.lit("sitemap"))).alias("map")).checkpoint()
    layer = roots.select("root", "url").distinct().withColumn("place", F.lit(1).cast("long")).checkpoint()
    layer = layer if limit > 0 else layer.limit(0)
    visited = layer
    while not layer.isEmpty():
        taken = visited.groupBy("root").agg(F.max("place").alias("last"))
        found = layer.select("root", F.col("url").alias("by"), "place").join(named.where("map"), "by").join(visited.select("root", "url"), ["root", "url"], "left_anti")
        new = first_by(found, ["root", "url"], ["place", "at"]).join(taken, "root")
        # Places behind those of a root that are taken; an address counts once, at its first mention.
        from pyspark.sql.window import Window as W

        ranked = new.withColumn("place", F.col("last") + F.row_number().over(W.partitionBy("root").orderBy("place", "at")))
        layer = ranked.where(F.col("place") <= limit).select("root", "url", "place").checkpoint()
        visited = visited.unionAll(layer)
    pages = visited.select("root", F.col("url").alias("by")).join(named.where("not map"), "by").select("root", "url").distinct()
    return visited, pages
