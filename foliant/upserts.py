"""A stored table of rows by key, in hash buckets: a merge rewrites the buckets that it touches and no others.

    <path>/data/<version>/__bucket=<b>/..   Parquet files of the buckets that a version rewrote
    <path>/commits/<version>.json           for every bucket the version that has its rows; the streams' last batches

A version exists once its commit file does, which is created under its own name and never replaced: a merge that breaks off
leaves the table as it was, and of two merges of one version the second fails. Readers name the folders of one commit and
see nothing of later ones.

Rows of a key are decided by `order` within a batch and against what is stored, so that a late row loses; of equal orders
the largest row (by its columns in turn) stays, in whatever order they came. A null order is the lowest; a null key is a key.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_BUCKET = "__bucket"


class ConcurrentMerge(RuntimeError):
    """Another merge has committed the same version."""


def latest(key: str, order: str, columns: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Of rows that share a key the one of highest order."""
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])

    def run(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col(f"`{key}`").alias("__key")).agg(F.max_by(whole, F.struct(F.col(f"`{order}`").alias("__order"), whole.alias("__row"))).alias("__row")).select("__row.*")

    return run


def summed(key: list[str], value: str) -> Callable[[DataFrame], DataFrame]:
    """Counts of equal keys added up; those that come to nothing go."""

    def run(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*key).agg(F.sum(value).alias(value)).where(F.col(value) != 0)

    return run


class BucketTable:
    """combine makes the rows of each key from stored and new ones; keys are the columns that tell rows apart."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], combine: Callable[[DataFrame], DataFrame], buckets: int = 64) -> None:
        self.spark, self.path, self.schema, self.keys, self.combine, self.buckets = spark, path.rstrip("/"), schema, keys, combine, buckets
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), spark._jsc.hadoopConfiguration())

    def _path(self, rest: str):
        return self._hadoop.Path(f"{self.path}/{rest}" if rest else self.path)

    def versions(self) -> list[int]:
        folder = self._path("commits")
        return sorted(int(s.getPath().getName()[:-5]) for s in self._fs.listStatus(folder) if s.getPath().getName().endswith(".json")) if self._fs.exists(folder) else []

    def commit(self, version: int | None = None) -> dict:
        """The commit of a version, the last one by default: version, buckets (by number, the version that wrote each) and
        batches (by stream, the last batch)."""
        found = self.versions()
        if version is None and not found:
            return {"version": 0, "of": self.buckets, "buckets": {}, "batches": {}}
        source = self._fs.open(self._path(f"commits/{found[-1] if version is None else version}.json"))
        try:
            return json.loads(bytes(source.readAllBytes()).decode())
        finally:
            source.close()

    def _create(self, commit: dict) -> None:
        """Writes the commit aside and gives it its name, unless that is taken."""
        name = self._path(f"commits/{commit['version']}.json")
        aside = self._path(f"commits/.{commit['version']}-{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        out.write(json.dumps(commit).encode())
        out.close()
        plain = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)  # no overwriting
        try:
            self._context.rename(*(self._fs.makeQualified(p) for p in (aside, name)), plain)
        except Py4JJavaError as e:
            self._fs.delete(aside, False)
            if not self._fs.exists(name):
                raise
            raise ConcurrentMerge(f"version {commit['version']} of {self.path} is there already") from e

    def _bucket(self, of: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(of)).cast("int")

    def _rows(self, commit: dict, buckets: list[int]) -> DataFrame:
        folders = [f"{self.path}/data/{commit['buckets'][str(b)]}/{_BUCKET}={b}" for b in buckets if str(b) in commit["buckets"]]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        commit = self.commit(version)
        return self._rows(commit, list(range(commit["of"])))

    def merge(self, rows: DataFrame, stream: str | None = None, batch: int | None = None, seen: dict | None = None) -> dict:
        """Merges rows (with the table's columns) and returns the new commit. A batch that the stream has merged before is
        left out, and so is a merge without rows.

        seen: the commit that the caller has read, the last one by default.
        """
        commit = seen or self.commit()
        if stream is not None and commit["batches"].get(stream, -1) >= batch:
            return commit
        rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        new = self.combine(rows).persist()
        try:
            touched = sorted(r[0] for r in new.select(self._bucket(commit["of"])).distinct().collect())  # numbers of buckets
            if not touched and stream is None:
                return commit
            version = commit["version"] + 1
            folder = f"data/{version}-{uuid.uuid4().hex}"
            if touched:
                merged = self.combine(self._rows(commit, touched).unionByName(new)).withColumn(_BUCKET, self._bucket(commit["of"]))
                merged.repartition(len(touched), _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        finally:
            new.unpersist()
        own = folder.removeprefix("data/")
        # A bucket that has lost its last row has no folder any more.
        left = {b: own for b in touched if self._fs.exists(self._path(f"{folder}/{_BUCKET}={b}"))}
        kept = {b: v for b, v in commit["buckets"].items() if int(b) not in touched}
        batches = commit["batches"] | ({stream: batch} if stream is not None else {})
        self._create(made := {"version": version, "of": commit["of"], "buckets": kept | {str(b): v for b, v in left.items()}, "batches": batches})
        return made

    def vacuum(self, keep: int = 2) -> int:
        """Removes what only commits before the last `keep` read; the number of folders removed. No merge may be running."""
        found = self.versions()
        used = {v for n in found[-keep:] for v in self.commit(n)["buckets"].values()}
        for n in found[:-keep]:
            self._fs.delete(self._path(f"commits/{n}.json"), False)
        gone = 0
        if self._fs.exists(self._path("data")):
            for version in self._fs.listStatus(self._path("data")):
                if version.getPath().getName() not in used:
                    gone += bool(self._fs.delete(version.getPath(), True))
        return gone
