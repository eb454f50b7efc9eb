"""Area accounting: sums by class, region and year, shares, transitions, rollups.

Areas are kept in square metres as whole numbers, so sums do not depend on their order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HECTARE = 10_000
SQUARE_KM = 1_000_000


def area(unit: int = HECTARE, column: str = "area_m2") -> Column:
    return (F.sum(column) / F.lit(unit)).alias("area")


def area_by(df: DataFrame, *keys: str, unit: int = HECTARE) -> DataFrame:
    """Area of observed pixels by the keys, such as region, year, class."""
    return df.where(F.col("class").isNotNull()).groupBy(*keys).agg(area(unit))


def area_by_regions(df: DataFrame, regions: DataFrame, unit: int = HECTARE) -> DataFrame:
    """Area by region_kind, region_id, year, class for all kinds of region at once.

    regions: region_kind, region_id, pixel_id; a pixel may lie in several. They are as
    many as the pixels and never broadcast.
    """
    joined = df.where(F.col("class").isNotNull()).join(regions.hint("merge"), "pixel_id")
    return joined.groupBy("region_kind", "region_id", "year", "class").agg(area(unit))


def transitions(df: DataFrame, first: int, last: int) -> DataFrame:
    """Area by code = from * 100 + to between two years, in one pass over the map."""
    pick = lambda year: F.max(F.when(F.col("year") == year, F.col("class")))
    both = df.where(F.col("year").isin(first, last)).groupBy("pixel_id").agg(pick(first).alias("a"), pick(last).alias("b"), F.max("area_m2").alias("area_m2"))
    return both.where("a is not null and b is not null").groupBy((F.col("a") * 100 + F.col("b")).alias("code")).agg(area())


def rollup_basins(df: DataFrame) -> DataFrame:
    """Area by basin, year, class, and for the whole biome (basin NULL)."""
    sets = "GROUP BY GROUPING SETS ((basin, year, class), (year, class))"
    observed = df.where(F.col("class").isNotNull())
    return df.sparkSession.sql(f"SELECT basin, year, class, sum(area_m2) / {HECTARE} AS area FROM {{df}} {sets}", df=observed)


def shares(areas: DataFrame, *keys: str) -> DataFrame:
    """area over the sum of areas with the same keys."""
    return areas.withColumn("share", F.try_divide("area", F.sum("area").over(Window.partitionBy(*keys))))


def gain_loss(areas: DataFrame, first: int, last: int, *keys: str) -> DataFrame:
    """Absolute difference and percent change of the area between two years."""
    pick = lambda year: F.max(F.when(F.col("year") == year, F.col("area")))
    both = areas.where(F.col("year").isin(first, last)).groupBy(*keys).agg(pick(first).alias("area_first"), pick(last).alias("area_last"))
    change = F.try_divide(100 * (F.col("area_last") - F.col("area_first")), F.col("area_first"))
    return both.withColumns({"difference": F.abs(F.col("area_last") - F.col("area_first")), "percent": F.round(change.cast("decimal(18,6)"), 2)})


def histogram(df: DataFrame, *keys: str, cls: str = "class") -> DataFrame:
    """Number of rows by class."""
    return df.groupBy(*keys, cls).agg(F.count("*").alias("n"))


def axis_ranges(areas: DataFrame) -> DataFrame:
    """Per class, the axis of a chart of its areas: 30 % of the least below, 20 % of the most above, five ticks."""
    found = areas.groupBy("class").agg(F.min("area").alias("low"), F.max("area").alias("high"))
    pad = F.col("low") < F.col("high")
    low = F.when(pad, F.col("low") - F.abs(F.col("low") * F.lit(0.3))).otherwise(F.col("low"))
    high = F.when(pad, F.col("high") + F.col("high") * F.lit(0.2)).otherwise(F.col("high"))
    tick = F.when(pad, F.floor((high - low) / 5).cast("long")).otherwise(F.lit(0).cast("long"))
    return found.select("class", low.alias("axis_low"), high.alias("axis_high"), tick.alias("tick"))


def composite(df: DataFrame, keys: Sequence[str], columns: Sequence[str], how: str = "median") -> DataFrame:
    """One row per key from overlapping scenes: median, min, max or mean of each band."""
    step = {"median": F.median, "min": F.min, "max": F.max, "mean": F.avg}[how]
    return df.groupBy(*keys).agg(*(step(c).alias(c) for c in columns))


def medians_by_part(df: DataFrame, keys: Sequence[str], columns: Sequence[str], parts: Mapping[str, Column]) -> DataFrame:
    """One row per key with the median of each column over the rows of each part, named column + part.

    parts maps suffixes to tests of a row. Like composite(), but a key's rows are brought
    together once, not counted by value for each median: a key has few scenes.
    """
    tests = [test.alias(f"_part{i}") for i, test in enumerate(parts.values())]
    rows = df.select(*keys, F.struct(*columns, *tests).alias("row")).groupBy(*keys).agg(F.collect_list("row").alias("rows"))
    of = lambda i: F.filter("rows", lambda r: r[f"_part{i}"]).alias(f"_rows{i}")
    kept = rows.select(*keys, *map(of, range(len(parts))))
    names = {f"{c}{part}": F.col(f"_rows{i}")[c].cast("array<double>") for i, part in enumerate(parts) for c in columns}
    ordered = kept.select(*keys, F.array(*(F.sort_array(F.array_compact(values)) for values in names.values())).alias("lists"))
    at = lambda x, n: F.get(x, F.floor(n / 2).cast("int"))
    found = ordered.select(*keys, F.transform("lists", lambda x: (at(x, F.size(x) - 1) + at(x, F.size(x))) / 2).alias("medians"))
    return found.select(*keys, *(F.col("medians")[i].alias(name) for i, name in enumerate(names)))


def incomplete(df: DataFrame, key: str, part: str, expected: int) -> DataFrame:
    """Keys with fewer distinct parts than expected."""
    return df.groupBy(key).agg(F.countDistinct(part).alias("n")).where(F.col("n") < expected)


def majority_key(df: DataFrame, group: str, key: str) -> DataFrame:
    """For each group the key with most rows, the least of ties."""
    counted = df.groupBy(group, key).agg(F.count("*").alias("n"))
    best = F.max(F.struct(F.col("n"), (-F.col(key)).alias("low")))
    return counted.groupBy(group).agg(best.alias("b")).select(group, (-F.col("b.low")).alias(key), F.col("b.n").alias("n"))
