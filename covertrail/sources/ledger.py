"""Work that resumes: results written by key, and a ledger of the keys that are done."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import stored


def _same(keys: list[str]):
    return reduce(lambda a, b: a & b, (F.col(f"w.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys))


def done(work: DataFrame, path: str) -> DataFrame:
    """The keys that the ledger under path records, in work's schema; none if there is no ledger yet."""
    spark, ledger = work.sparkSession, f"{path}/ledger"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return work.limit(0)
    return spark.read.schema(work.schema).parquet(ledger)


def left(work: DataFrame, path: str) -> DataFrame:
    """The keys of work that are not done."""
    return work.alias("w").join(done(work, path).alias("d"), _same(work.columns), "left_anti")


def run(work: DataFrame, make: Callable[[DataFrame], DataFrame], path: str, batches: int = 1) -> DataFrame:
    """finished() after all of work (distinct keys) has been made that is not done yet.

    make(keys) gives the rows of some keys, with the key columns; it must give the same
    for a key each time. Keys are made in batches (by a hash). A batch's rows replace what
    an earlier, broken run may have left of those keys, and only then are the keys added
    to the ledger. So a run that is stopped anywhere and started again leaves no gap and no
    double, and loses one batch at most. One run at a time may write to a path.
    """
    keys = work.columns
    for k in range(batches):
        some = left(work.where(F.pmod(F.xxhash64(*keys), F.lit(batches)) == k), path)
        some = stored(some, "work")  # a fixed list, whatever make() and the ledger do
        if some.isEmpty():
            continue
        make(some).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(f"{path}/data")
        some.write.mode("append").parquet(f"{path}/ledger")
    return finished(work, make(work.limit(0)), path)


def finished(work: DataFrame, like: DataFrame, path: str) -> DataFrame:
    """The rows of keys that are done, with the columns of like; what a broken run has left is not seen."""
    spark: SparkSession = work.sparkSession
    rows = spark.read.schema(like.schema).parquet(f"{path}/data").select(like.columns)
    return rows.alias("w").join(done(work, path).alias("d"), _same(work.columns), "left_semi")
