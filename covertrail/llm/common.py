"""Helpers shared by the corpus operators: reading, scratch tables, words."""

from __future__ import annotations

import gc
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import scratch

#: Word separators: space, and tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share; what is there goes when the application ends."""
    return scratch.new_path(spark, name)


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df as a table in the shared scratch folder and read it back.

    Later stages then restart from files that any executor can read. The table
    goes when the application ends; the shuffle files that made it are let go at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _let_go(spark)
    df.write.option("compression", "zstd").parquet(path, partitionBy=partition_by)
    _let_go(spark)
    return spark.read.schema(df.schema).parquet(path)


def remove(*written: DataFrame) -> None:
    """Delete tables in the scratch folder that no later plan reads."""
    for df in written:
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            scratch.drop(df.sparkSession, folder)


def discard(spark: SparkSession, *written: DataFrame) -> None:
    """remove() tables, and let go of shuffle files no longer used."""
    remove(*written)
    time.sleep(1)  # the last query's listeners hold on to it for a moment
    _let_go(spark)


def _let_go(spark: SparkSession) -> None:
    """Spark's cleaner removes shuffle files once the driver forgets them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text, in order."""
    return F.array_remove(F.split(text, SPACES), "")


def utf8_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's UTF-8, joined, and where each text ends."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at[1:] - at[0]
