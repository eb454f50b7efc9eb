"""Map against map: agreement codes and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import masks
from .areas import area


def pair_maps(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both classes of every pixel and year: columns a and b beside those of the first map."""
    other = b.select("pixel_id", "year", F.col("class").alias("b"))
    return a.withColumnRenamed("class", "a").join(other, ["pixel_id", "year"])


def agreement(cls: int, a: Column, b: Column, newer: str = "b") -> Column:
    """1 both maps have the class, 2 only the newer (b, or a if so named), 3 only the older; masked elsewhere."""
    has = lambda c: F.coalesce(c == cls, F.lit(False))
    new, old = (a, b) if newer == "a" else (b, a)
    return F.when(has(new) & has(old), 1).when(has(new), 2).when(has(old), 3)


def synthesis(code: Column, a: Column, b: Column, swapped: bool = False) -> Column:
    """The class that each agreement code stands for: a, b, a; swapped: b, a, b."""
    first, second = (b, a) if swapped else (a, b)
    return F.when(code.isin(1, 3), first).when(code == 2, second)


def agreement_area(pairs: DataFrame, classes: list[int], *keys: str) -> DataFrame:
    """Area by the keys, class and agreement code for all classes in one pass."""
    coded = F.array(*(F.struct(F.lit(k).alias("class"), agreement(k, F.col("a"), F.col("b")).alias("code")) for k in classes))
    rows = pairs.select(*keys, "area_m2", F.inline(F.filter(coded, lambda x: x["code"].isNotNull())))
    return rows.groupBy(*keys, "class", "code").agg(area())


def presence(cls: int, a: Column, b: Column) -> Column:
    """2 only the first map has the class, 1 only the second, 3 both, 0 none."""
    has = lambda c: F.coalesce((c == cls).cast("int"), F.lit(0))
    return 2 * has(a) + has(b)


def any_layer(*layers: Column) -> Column:
    """1 where any of the masks is set."""
    total = sum((masks.unmask(x) for x in layers), F.lit(0))
    return (total / len(layers) > 0).cast("int")
