"""Scratch tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []


def folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Only a local session may leave it unset and gets a temporary folder."""
    if configured := spark.conf.get("spark.checkpoint.dir", None):
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="covertrail-"))
    return _local[0]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the scratch folder that is removed when the application ends."""
    path = f"{folder(spark)}/covertrail-{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(drop, spark, path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to scratch and read back, which cuts its lineage."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is."""
    jsc = spark.sparkContext._jsc
    if jsc is None:  # the session has ended
        return
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(jsc.hadoopConfiguration()).delete(target, True)
