"""Training samples: masks of stable area, quotas, balance, splits.

Draws use a number in [0, 1) that follows from the key and a seed, so they are repeatable
and each row is judged by itself; only sizes of classes need a (combined) count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Digits of a hexadecimal hash that a double holds exactly.
_DIGITS = 13
_LEVELS = 60


def uniform(seed: int = 0, pixel: str = "pixel_id", year: str = "year") -> Column:
    """A repeatable number in [0, 1) for a pixel and year, the same in any SQL engine: 52 bits of a hash, so keys do not share numbers."""
    mixed = F.md5(F.concat_ws(":", pixel, year, F.lit(str(seed))))
    return F.conv(F.substring(mixed, 1, _DIGITS), 16, 10).cast("long") / F.lit(float(16**_DIGITS))


def stable_area(stable: Column, burned: Column, alert: Column, coincidence: Column, below: int = 3) -> Column:
    """Stable, neither burned nor deforested, and maps that coincide."""
    return stable & (F.coalesce(burned, F.lit(0)) == 0) & (F.coalesce(alert, F.lit(0)) == 0) & (coincidence < below)


def stratified(df: DataFrame, n: int, *strata: str, seed: int = 0) -> DataFrame:
    """n rows of each stratum, or all it has: those of the least numbers.

    Counts of the numbers by their size (powers of two) show which sizes the n least have.
    Only those rows, about 2n of a stratum, are ranked, so no stratum is one task's.
    """
    level = F.least(F.floor(-F.log2(F.greatest(F.col("_u"), F.lit(2.0**-_LEVELS)))), F.lit(_LEVELS)).cast("int")
    drawn = df.withColumn("_u", uniform(seed)).withColumn("_level", level)
    least_first = Window.partitionBy(*strata).orderBy(F.desc("_level"))
    counts = drawn.groupBy(*strata, "_level").agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(least_first))
    bound = counts.where(F.col("_upto") - F.col("_n") < n).groupBy(*strata).agg(F.min("_level").alias("_bound"))
    same = reduce(lambda a, b: a & b, (F.col(f"d.{c}").eqNullSafe(F.col(f"b.{c}")) for c in strata))
    near = drawn.alias("d").join(bound.alias("b"), same & (F.col("d._level") >= F.col("b._bound"))).select("d.*")
    first = Window.partitionBy(*strata).orderBy("_u", "pixel_id", "year")
    return near.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= n).select(*df.columns)


def uniform_sample(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n rows of all, by the least numbers: every task keeps its best n first."""
    return df.withColumn("_u", uniform(seed)).orderBy("_u", "pixel_id", "year").limit(n).drop("_u")


def quota(df: DataFrame, limits: DataFrame, *strata: str, seed: int = 0) -> DataFrame:
    """Rows whose number is at most limit * share / size of their stratum.

    limits: strata, limit, share; a stratum not listed gives no rows.
    """
    sizes = df.groupBy(*strata).agg(F.count("*").alias("_size"))
    bound = limits.join(sizes, list(strata)).select(*strata, (F.col("limit") * F.col("share") / F.col("_size")).alias("_bound"))
    return df.join(bound, list(strata)).where(uniform(seed) <= F.col("_bound")).drop("_bound")


def share_rules(shares: DataFrame) -> DataFrame:
    """Class shares with additions: mosaic (21) gets 0.1 more; forest (3) under 0.05 becomes 0.15; unknown 0.01."""
    share = F.coalesce("share", F.lit(0.01))
    ruled = F.when(F.col("class") == 21, share + 0.1).when((F.col("class") == 3) & (share < 0.05), 0.15).otherwise(share)
    return shares.withColumn("share", ruled)


def balance(df: DataFrame, targets: dict[int, tuple[int, int]], seed: int = 0) -> DataFrame:
    """Classes over a limit are thinned to about a target: targets is class -> (limit, target)."""
    sizes = df.groupBy("class").agg(F.count("*").alias("_size"))
    bound = F.lit(1.0)
    for cls, (limit, target) in targets.items():
        bound = F.when((F.col("class") == cls) & (F.col("_size") > limit), F.lit(float(target)) / F.col("_size")).otherwise(bound)
    bounds = sizes.select("class", bound.alias("_bound"))
    return df.join(bounds, "class").where(uniform(seed) <= F.col("_bound")).drop("_bound")


def keep_by_class(df: DataFrame, seed: int = 0) -> DataFrame:
    """Class 4 where u >= 0.5, class 21 always, others where u <= 0.9."""
    u, cls = uniform(seed), F.col("class")
    return df.where(F.when(cls == 4, u >= 0.5).when(cls == 21, F.lit(True)).otherwise(u <= 0.9))


def split(df: DataFrame, train: float = 0.8, seed: int = 0) -> DataFrame:
    """df with part: train or test."""
    return df.withColumn("part", F.when(uniform(seed) < train, "train").otherwise("test"))


def tortora_size(shares: DataFrame, b: float, error: float) -> DataFrame:
    """Sample size of each class: b * p * (1 - p) / error ** 2, rounded up."""
    p = F.col("share")
    return shares.withColumn("n", F.ceil(F.lit(b) * p * (1 - p) / F.lit(error * error)).cast("long"))
