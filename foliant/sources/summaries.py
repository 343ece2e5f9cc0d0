"""Stored summaries of a track, as tables.

A summary is a JSON document year -> track -> {src, sum, name, hist, tsf}. Older files name counts, tiers, dimensions and
tier ids by tnum, tname, rname and tid beside these, and hold one string where newer ones have one for each area.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MAP = "map<string,string>"


def _entries(doc: DataFrame, old: str | None, new: str | None) -> DataFrame:
    """key and value of the object under the old or else the new path."""
    found = [F.get_json_object("doc", f"$.{p}") for p in (old, new) if p]
    return doc.select(F.explode(F.from_json(F.coalesce(*found), _MAP)).alias("key", "value"))


def _areas(value: Column) -> Column:
    """area -> string; a plain string is that of area 0."""
    return F.when(F.startswith(value, F.lit("{")), F.from_json(value, _MAP)).otherwise(F.create_map(F.lit("0"), value))


def summary(spark: SparkSession, path: str, year: int, track: str) -> dict[str, DataFrame]:
    """counts (tier, n), tiers (tier, name), dimensions (dim, label), ids (name, tid), hist and tsf (label, tier, area,
    value) of one track. A document without the year or track gives empty tables."""
    text = spark.read.option("wholetext", True).text(path)
    doc = text.select(F.get_json_object("value", f"$['{year}']['{track}']").alias("doc")).where("doc is not null")
    tier = F.col("key").cast("int").alias("tier")
    dimensions = _entries(doc, "rname", "name.review").select(F.col("key").cast("int").alias("dim"), F.col("value").alias("label"))

    def strings(name: str) -> DataFrame:
        by_dim = _entries(doc, name, None).select(F.col("key").cast("int").alias("dim"), F.explode(F.from_json("value", _MAP)).alias("tier", "v"))
        by_area = by_dim.select("dim", F.col("tier").cast("int").alias("tier"), F.explode(_areas(F.col("v"))).alias("area", "value"))
        return by_area.join(dimensions, "dim").select("label", "tier", F.col("area").cast("int").alias("area"), "value")

    return {
        "counts": _entries(doc, "tnum", "sum.count").select(tier, F.col("value").cast("bigint").alias("n")),
        "tiers": _entries(doc, "tname", "name.tier").select(tier, F.col("value").alias("name")),
        "dimensions": dimensions,
        "ids": _entries(doc, "tid", "name.tier_raw").select(F.col("value").alias("name"), F.col("key").cast("int").alias("tid")),
        "hist": strings("hist"),
        "tsf": strings("tsf"),
    }
