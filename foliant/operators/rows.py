"""Row-order operators: carry-forward, duplicates, sorting, sets and upserts. Order is a column, never implicit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.operators.scans import carried


def carry_forward(df: DataFrame, column: str, partition: str, order: str = "row_ix") -> DataFrame:
    """Blank cells take the last value above them in their table, which may be of any size."""
    return carried(df, column, partition, order)


def keep_best(df: DataFrame, key: Column, score: str, order: str = "row_ix", short: int = 10) -> DataFrame:
    """Of rows with equal keys the one with the best score, the earliest on ties; keys of `short` characters or fewer are
    too vague and keep all rows."""
    d = df.withColumn("__key", key)
    vague = d.where(F.length("__key") <= short)
    best = d.where(F.length("__key") > short).groupBy("__key").agg(F.max_by(F.struct(*df.columns), F.struct(F.col(score), -F.col(order))).alias("r"))
    return best.select("r.*").unionByName(vague.select(*df.columns))


def last_scores_first_facts(df: DataFrame, key: str, scores: tuple[str, ...], facts: tuple[str, ...], order: str = "row_ix") -> DataFrame:
    """Repeated responses: scores of the last one, all other facts of the first."""
    return df.groupBy(key).agg(*[F.max_by(c, order).alias(c) for c in scores], *[F.min_by(c, order).alias(c) for c in facts])


def first_of(df: DataFrame, key: str, order: str = "row_ix") -> DataFrame:
    """The first row of each key."""
    return df.groupBy(key).agg(F.min_by(F.struct(*df.columns), order).alias("__r")).select("__r.*")


def ranked(df: DataFrame, by: str, order: Column, tie: str) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(order, tie)).cast("bigint"))


def sorted_by(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Sorted by the columns; strings by code point."""
    return df.orderBy(*columns)


def union(*frames: DataFrame) -> DataFrame:
    """All rows, by column name; columns that a frame lacks are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b.select(key).distinct(), key, "left_anti")


def intersection(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b.select(key).distinct(), key, "left_semi")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of old whose key new lacks, and all rows of new."""
    return union(difference(old, new, key), new)


def refreshed(stats: DataFrame, meta: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """Rows that no source has marked get the meta sheet's cells, and meta-only conferences are added."""
    m = meta.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    own = stats.join(m, key, "left")
    unmarked = F.coalesce(F.col("bot_mark"), F.lit("")) == ""
    own = own.select(*[F.when(unmarked & F.col(f"__{c}").isNotNull(), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in stats.columns])
    added = difference(meta, stats, key).select(key, *columns).withColumn("bot_mark", F.lit(""))
    return union(own, added).orderBy(key)
