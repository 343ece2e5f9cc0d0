"""Sharding by jump consistent hashing.

A document's shard follows from its id and the number of shards alone, by a walk of jumps, without a table of a ring: when
a shard is appended, it takes its share of rows and no row moves between the others.

Slots number the rows of a shard from 0, in order of id, checksum and size, without a task that sees a whole shard: rows
without their texts are dealt in ranges of (shard, id, ..), each task numbers the rows of its range, and a range's rows
start where the earlier ranges of its shard end. Ranges cut at single rows, so a shard, an id or a text that holds much of
the table is spread like any other. Numbered rows are written to the shared folder, so that a lost executor can't number
them anew.

Defined results: a null text has no bytes (its size is the overhead, its checksum 0) and is not told from an empty one; a
null id is a key of its own; rows that repeat an id share its shard and have slots of their own; equal rows are numbered in
any order; an empty table gives an empty result. Columns other than the id and the text are not read by assign(), and kept
by write_shards(). Ids may be of any type that has a text form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import written

#: Bytes that every row counts besides its text.
OVERHEAD = 16
#: Rows of the table of ranges up to which it is broadcast (20 bytes each); a larger one is joined by a shuffle.
BROADCAST_RANGES = 200_000
#: Rows without texts in one range, about.
RANGE_ROWS = 1 << 20

# Fixed values of the published algorithm: the generator's multiplier, and the power of two that its 31 bits divide.
MULTIPLIER = 2862933555777941757
SPAN = 1 << 31


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key among so many."""
    if not 0 < shards < SPAN:
        raise ValueError("at least one shard and less than 2**31")
    key = keys.astype(np.uint64)
    at, ahead, walking = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64), np.arange(len(key))
    while len(walking):
        at[walking] = ahead[walking]
        key[walking] = key[walking] * np.uint64(MULTIPLIER) + np.uint64(1)
        step = SPAN / ((key[walking] >> np.uint64(33)).astype(np.int64) + 1)
        ahead[walking] = ((at[walking] + 1) * step).astype(np.int64)
        walking = walking[ahead[walking] < shards]
    return at


def key_of(id_col: str) -> Column:
    """A 64-bit key of an id's text, as 8 bytes; other systems can compute it as well."""
    return F.unhex(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string").cast("binary"), F.lit("null id").cast("binary"))), 1, 16))


def _keys(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u8")


def _jumped(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            keys, n = _keys(batch.column("key")), batch.num_rows
            now, grown = (pa.array(jump(keys, x).astype(np.int32)) for x in (shards, shards + 1))
            own = [batch.column(c) for c in ("doc_id", "size", "text_crc32")]
            yield pa.RecordBatch.from_arrays([*own, now, grown, pa.array(np.arange(seen, seen + n) + task)], names=["doc_id", "size", "text_crc32", "shard", "grown_shard", "tie"])
            seen += n

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the range and, by shard, the place within it."""
    task, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        place = np.empty(len(shard), np.int64)
        for s in np.unique(shard).tolist():
            rows = np.flatnonzero(shard == s)
            place[rows] = np.arange(len(rows)) + seen.get(s, 0)
            seen[s] = seen.get(s, 0) + len(rows)
        own = [batch.column(c) for c in ("doc_id", "size", "text_crc32", "shard", "grown_shard")]
        yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(len(shard), task, np.int32)), pa.array(place)], names=["doc_id", "size", "text_crc32", "shard", "grown_shard", "range", "place"])


def assign(docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text", overhead: int = OVERHEAD, broadcast_ranges: int = BROADCAST_RANGES) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and grown_shard (the shard if there were one more) of every row.

    Texts are read once; two tables of the other columns are written to the shared folder.
    """
    spark, text = docs.sparkSession, F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), key_of(id_col).alias("key"))
    base = f"doc_id {id_type}, size long, text_crc32 long, shard int, grown_shard int"
    keyed = written(rows.mapInArrow(_jumped(shards), f"{base}, tie long"), "keyed")
    n = keyed.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // RANGE_ROWS))
    order = ["shard", "doc_id", "text_crc32", "size", "tie"]
    dealt = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = written(dealt.mapInArrow(_numbered, f"{base}, range int, place long"), "placed")
    # One row for each range and shard in it: at most ranges + shards - 1.
    sizes = placed.groupBy("shard", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    if ranges + shards <= broadcast_ranges:
        starts = F.broadcast(starts)
    return placed.join(starts, ["shard", "range"]).select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place")).alias("slot"), "grown_shard")


def digest(assigned: DataFrame) -> DataFrame:
    """assign()'s columns and the law that holds for them."""
    return assigned.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _shard_column(shards: int):
    @F.pandas_udf("int")
    def run(key: pd.Series) -> pd.Series:
        return pd.Series(jump(np.frombuffer(b"".join(key), ">u8"), shards).astype(np.int32))

    return run


def with_shard(docs: DataFrame, shards: int, *, id_col: str = "doc_id", name: str = "shard") -> DataFrame:
    """docs with the shard of each row."""
    return docs.withColumn(name, _shard_column(shards)(key_of(id_col)))


def write_shards(docs: DataFrame, shards: int, path: str, *, id_col: str = "doc_id", files: int = 1) -> None:
    """Whole rows, one folder a shard (`path`/shard=<n>), so many files in each, by a hash of the row.

    Equal rows meet in one file; so does a shard unless `files` is over 1.
    """
    names = [f"`{c}`" for c in docs.columns]
    dealt = with_shard(docs, shards, id_col=id_col).withColumn("__file", F.pmod(F.xxhash64(*names), F.lit(files)))
    dealt.repartition(shards * files, "shard", "__file").drop("__file").write.partitionBy("shard").parquet(path)


def movers(spark, path: str, shards: int, *, id_col: str = "doc_id") -> DataFrame:
    """Of shards written by write_shards() the rows that one shard more takes, with `shard`, where they are now."""
    return with_shard(spark.read.parquet(path), shards + 1, id_col=id_col, name="__grown").where(F.col("__grown") == shards).drop("__grown")
