"""The folder that the driver and all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir where the cluster names it. Unset: a folder of this machine in local mode, the warehouse
    elsewhere."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        return "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: its lineage ends there."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more: the folders under the shared root that these frames read."""
    for df in tables:
        spark = df.sparkSession
        root = spark._jvm.org.apache.hadoop.fs.Path(shared_root(spark))
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        own = fs.makeQualified(root).toString().rstrip("/") + "/"
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(folder))
            if path.toString().startswith(own):
                fs.delete(path, True)
