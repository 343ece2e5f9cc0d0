"""Shared plumbing: the cluster's shared folder, written tables, and bounded slices of Arrow batches."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.storage import shared_dir, shared_root, stored

__all__ = ["before", "bounded_batches", "id_text", "kept", "release_memory", "removed", "renamed_apart", "sha256_hex", "shared_dir", "shared_root", "slices", "with_names", "written"]

#: A table in the shared folder: lineage ends there, and lost executors cost no recomputation.
written = stored

#: Characters of text that one vectorised step takes at most, unless a single document is longer.
SLICE_CHARS = 1 << 19

#: Bytes of an Arrow batch on its way to a Python worker: both sides hold one, and the JVM's grows by doubling.
BATCH_BYTES = 4 << 20
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of the session take BATCH_BYTES at most from now on, or less where less is set already."""
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_ARROW_BYTES, "64m"))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(_ARROW_BYTES, str(BATCH_BYTES))


def before(rows: DataFrame, order: str, value: str, name: str, run: int = 4096) -> DataFrame:
    """rows with the sum of `value` over all rows of a smaller `order`, a whole number from 0: sums of runs of the order,
    a scan over the runs, and one within each."""
    own = rows.withColumn("__run", F.floor(F.col(order) / run))
    runs = own.groupBy("__run").agg(F.sum(value).alias("__sum")).withColumn("__one", F.lit(1))  # a row for `run` rows
    earlier = Window.partitionBy("__one").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("__run", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    within = Window.partitionBy("__run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn(name, F.coalesce(F.sum(value).over(within), F.lit(0)))
    return own.join(starts, "__run").withColumn(name, F.col(name) + F.col("__start")).select(*rows.columns, name)


def removed(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def renamed_apart(df: DataFrame, *reserved: str) -> tuple[DataFrame, dict[str, str]]:
    """df with other names for columns that clash with an operator's own, and the new name of every column."""
    taken = {c.lower() for c in df.columns} | {r.lower() for r in reserved}
    names = {}
    for c in df.columns:
        names[c] = c
        if c.lower() in {r.lower() for r in reserved}:
            while names[c].lower() in taken:
                names[c] += "_"
            taken.add(names[c].lower())
    return df.toDF(*names.values()), names


def with_names(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns that renamed_apart() renamed, under their old names, and no others."""
    return df.select(*[F.col(f"`{new}`").alias(old) for old, new in names.items()])


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, under fixed names, so that other columns can't clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


@lru_cache
def _trim():
    """glibc's malloc_trim, where there is one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return None


_KEPT: dict[tuple, object] = {}


def kept(operator: str, key: object, make: Callable[[], object]) -> object:
    """What make() gives, once for a key as long as the worker process runs tasks of one operator: workers live on, so what
    another one has left behind is dropped."""
    if any(name != operator for name, _ in _KEPT):
        _KEPT.clear()
        release_memory()
    if (operator, key) not in _KEPT:
        _KEPT[operator, key] = make()
    return _KEPT[operator, key]


def release_memory() -> None:
    """Gives freed memory back: Python workers live on from task to task and share a machine with the next ones."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def slices(batch: pa.RecordBatch, text: str = "text", chars: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Row slices of a batch whose texts hold about `chars` characters; a longer text is a slice of its own.

    Memory that a batch has freed is given back after it.
    """
    place = batch.schema.get_field_index(text)
    begin = total = 0
    sizes = pc.fill_null(pc.utf8_length(batch.column(place)), 0).to_pylist()
    for i, n in enumerate([*sizes, chars + 1]):
        if i > begin and total + n > chars:
            part = batch.slice(begin, i - begin)
            yield part, part.column(place).to_pylist()
            begin, total = i, 0
        total += n
    release_memory()


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
