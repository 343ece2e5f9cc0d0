"""Sinks. Nothing is written for an empty table; upserts replace rows by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.operators.rows import upsert


def save_list(df: DataFrame, path: str, mode: str = "overwrite", partitions: tuple[str, ...] = (), fmt: str = "json") -> bool:
    """Writes a list; whether there was anything to write. Partitioned writes only replace the partitions they hold."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode is overwrite or append, not {mode}")
    if df.isEmpty():
        return False
    out = df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "dynamic")
    (out.partitionBy(*partitions) if partitions else out).save(path)
    return True


def save_document(df: DataFrame, path: str) -> None:
    """A small result as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_upsert(new: DataFrame, path: str, key: str, order: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Merges new rows into a stored table by key and returns it. The merged table is written beside the old one first."""
    spark = new.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target, fresh, aside = (hadoop.Path(path + end) for end in ("", ".new", ".old"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target) and fs.exists(aside):  # an earlier merge broke off between its two renames
        fs.rename(aside, target)
    merged = upsert(spark.read.format(fmt).schema(new.schema).load(path), new, key) if fs.exists(target) else new
    (merged.orderBy(order) if order else merged).write.mode("overwrite").format(fmt).save(path + ".new")
    # The old table moves aside before the new one takes its name: at every moment one of them is whole.
    if fs.exists(target):
        fs.delete(aside, True)
        fs.rename(target, aside)
    fs.rename(fresh, target)
    fs.delete(aside, True)
    return spark.read.format(fmt).schema(new.schema).load(path)


def save_requests(papers: DataFrame, path: str, name: str, prompt: str, model: str) -> None:
    """Batch requests as lines of JSON, one for each paper with an affiliation text."""
    from foliant.functions.text import custom_id

    message = F.array(F.struct(F.lit("system").alias("role"), F.lit(prompt).alias("content")), F.struct(F.lit("user").alias("role"), F.col("aff").alias("content")))
    body = F.struct(F.lit(model).alias("model"), message.alias("messages"))
    rows = papers.where(F.coalesce(F.col("aff"), F.lit("")) != "").select(F.to_json(F.struct(custom_id(F.lit(name), F.col("row_ix")).alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v4/chat/completions").alias("url"), body.alias("body"))).alias("value"))
    rows.write.mode("overwrite").text(path)


def summary_document(hists: DataFrame, tsfs: DataFrame) -> DataFrame:
    """One nested JSON document a track from (track, dim, tier, area, hist) and (track, dim, tier, area, tsf) strings.

    Its size is set by the venue's configuration: dimensions x tiers x areas.
    """

    def nested(df: DataFrame, value: str) -> DataFrame:
        # Maps inside out, keys in order: dim -> tier -> area -> string.
        names = ["area", "tier", "dim"]
        out = df.select("track", *names, value)
        for i, name in enumerate(names):
            entries = F.array_sort(F.collect_list(F.struct(F.col(name).cast("string").alias("k"), F.to_json(value).alias("v") if i else F.col(value).alias("v"))))
            out = out.groupBy("track", *names[i + 1 :]).agg(F.map_from_entries(entries).alias(value))
        return out

    def plain(value: str) -> Column:
        """The maps of JSON texts as one JSON text."""
        tiers = F.transform_values(F.col(value), lambda _, t: F.transform_values(F.from_json(t, "map<string,string>"), lambda _, a: F.from_json(a, "map<string,string>")))
        return F.coalesce(F.to_json(tiers), F.lit("{}"))

    j = nested(hists, "hist").join(nested(tsfs, "tsf"), "track", "full")
    return j.select("track", F.concat(F.lit('{"hist":'), plain("hist"), F.lit(',"tsf":'), plain("tsf"), F.lit("}")).alias("document"))


def status_grid(df: DataFrame, years: list[int]) -> DataFrame:
    """Conferences by year with the state of each task."""
    return df.groupBy("conf").pivot("year", years).agg(F.max("state")).orderBy("conf")
