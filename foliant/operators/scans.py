"""Prefix scans in two levels: over the rows of a range, and over the ranges.

A scan along an order (numbers, running values) done by one window puts each of its groups into one task. Here rows are
dealt to ranges of (group, order), which cut a large group like any other; the ranges of a group are summed up, a scan over
these few rows says what each range starts with, and each range scans its own rows. Ranges are written once, because a row's
range must not change between the two readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.storage import stored

_RANGE, _START, _VALUE = "__range", "__start", "__value"


def ranged(df: DataFrame, *order: str | Column) -> DataFrame:
    """df with the range of each row: ascending numbers along the order, as many as there are shuffle partitions."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(parts, *order).withColumn(_RANGE, F.spark_partition_id()), "ranges")


def _exclusive(name: str) -> Column:
    return F.sum(name).over(Window.partitionBy("__one").orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))


def numbered(df: DataFrame, *order: str | Column, name: str = "row_ix") -> DataFrame:
    """df with each row's place in the order, from 0, without gaps; rows of equal order in any order."""
    rows = ranged(df, *order)
    sizes = rows.groupBy(_RANGE).agg(F.count("*").alias(_START)).withColumn("__one", F.lit(1))  # a row a range
    starts = sizes.select(_RANGE, F.coalesce(_exclusive(_START), F.lit(0)).alias(_START))
    own = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*order)) - 1
    return rows.withColumn(name, own.cast("bigint")).join(F.broadcast(starts), _RANGE).withColumn(name, F.col(name) + F.col(_START)).drop(_RANGE, _START)


def numbered_within(df: DataFrame, group: list[str], *order: str | Column, name: str = "n") -> DataFrame:
    """df with each row's place in its group, from 0, for groups of any size whose columns are not null."""
    rows = numbered(df, *group, *order, name="__place")
    starts = rows.groupBy(*group).agg(F.min("__place").alias("__first"))
    return rows.join(starts, group).withColumn(name, F.col("__place") - F.col("__first")).drop("__place", "__first")


def carried(df: DataFrame, column: str, group: str, order: str) -> DataFrame:
    """df with blank cells of a column filled by the last value above them in their group."""
    value = F.nullif(F.col(f"`{column}`"), F.lit(""))
    rows = ranged(df.withColumn(_VALUE, value), group, order)
    last = rows.where(F.col(_VALUE).isNotNull()).groupBy(group, _RANGE).agg(F.max_by(_VALUE, order).alias(_START))
    # A row for each range that a group has rows in, also where none of them has a value.
    every = rows.select(group, _RANGE).distinct().join(last, [group, _RANGE], "left")
    above = Window.partitionBy(group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = every.select(F.col(group).alias("__group"), F.col(_RANGE).alias("__of"), F.last(_START, ignorenulls=True).over(above).alias(_START))
    own = F.last(_VALUE, ignorenulls=True).over(Window.partitionBy(group, _RANGE).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = rows.withColumn(_VALUE, own).join(starts, rows[group].eqNullSafe(F.col("__group")) & (F.col(_RANGE) == F.col("__of")))
    return out.withColumn(column, F.coalesce(_VALUE, _START)).select(*[F.col(f"`{c}`") for c in df.columns])
