"""Incremental forms of the batch operators on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from foliant.functions.scores import histogram_bin
from foliant.upserts import BucketTable, latest, summed


def upsert_stream(stream: DataFrame, path: str, key: str, checkpoint: str, order: str | None = None, buckets: int = 64) -> StreamingQuery:
    """Stored rows by key in a BucketTable: of rows that share a key the one of highest order (the key's own column if none
    is given) stays, whichever batch it comes in. A batch that runs again after a failure is merged once."""
    schema = stream.schema

    def merge(batch: DataFrame, number: int) -> None:
        stored_rows(batch.sparkSession, path, schema, key, order, buckets).merge(batch, checkpoint, number)

    return stream.writeStream.foreachBatch(merge).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_rows(spark: SparkSession, path: str, schema: StructType, key: str, order: str | None = None, buckets: int = 64) -> BucketTable:
    """The table that upsert_stream() writes."""
    return BucketTable(spark, path, schema, [key], latest(key, order or key, schema.names), buckets)


def count_stream(changes: DataFrame, path: str, cell: list[str], checkpoint: str, buckets: int = 8) -> StreamingQuery:
    """Counts by cell kept up to date from signed changes (see stateful.cell_changes), compacted in a BucketTable: a row for
    each cell that is not empty, however long the stream."""
    schema = changes.schema

    def merge(batch: DataFrame, number: int) -> None:
        stored_counts(batch.sparkSession, path, schema, cell, buckets).merge(batch, checkpoint, number)

    return changes.writeStream.foreachBatch(merge).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_counts(spark: SparkSession, path: str, schema: StructType, cell: list[str], buckets: int = 8) -> BucketTable:
    """The table that count_stream() writes."""
    return BucketTable(spark, path, schema, cell, summed(cell, "n"), buckets)


def histogram_stream(stream: DataFrame, value: str, time: str, window: str = "1 day", late: str = "1 day", top: float = 10.0) -> DataFrame:
    """Histograms by event-time window; rows later than `late` are dropped by the watermark."""
    ts = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return ts.groupBy(F.window(time, window), histogram_bin(F.col(value), top).alias("bin")).agg(F.count("*").alias("n"))


def first_of_stream(stream: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def snapshot_changes(stream: DataFrame, initial: DataFrame, key: str = "id") -> DataFrame:
    """Current rows of a stream with their initial score from a static snapshot."""
    return stream.join(initial.select(key, F.col("avg").alias("before")), key)


def retry_queue(work: DataFrame, outcome: DataFrame, most: int = 2) -> DataFrame:
    """The work table (title, attempts, status) after a round of outcomes (title, status).

    'no_record' is tried again until `most` attempts have been made; success and other failures are final.
    """
    j = work.join(outcome.select("title", F.col("status").alias("new")), "title", "left")
    attempts = F.col("attempts") + F.when(F.col("new").isNotNull(), 1).otherwise(0)
    status = F.when(F.col("new").isNull(), F.col("status")).when((F.col("new") == "no_record") & (attempts <= most), "pending").otherwise(F.col("new"))
    return j.select("title", attempts.alias("attempts"), status.alias("status"))


def resumed(load: Callable[[], DataFrame], fetch: Callable[[], DataFrame]) -> DataFrame:
    """The stored table if it has rows, else what fetching gives."""
    stored = load()
    return fetch() if stored.isEmpty() else stored
