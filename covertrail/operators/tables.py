"""Joins and set operations between map, point and registry tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import indices, masks


def select_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The listed columns under new names, in order."""
    return df.select(*(F.col(a).alias(b) for a, b in names.items()))


def clip(df: DataFrame, members: DataFrame) -> DataFrame:
    """The pixels of a region, members: pixel_id; they may be as many as the pixels and are never broadcast."""
    return df.join(members.hint("merge"), "pixel_id", "left_semi")


def _graded(boxes: DataFrame, finest: float, levels: int) -> DataFrame:
    """box, own (the level of its size: a cell of finest * 2 ** own holds it) and large (it exceeds the coarsest level)."""
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(finest))
    level = F.greatest(F.ceil(F.log2(size / finest) - 1e-9), F.lit(0)).cast("int")
    rows = boxes.where("x0 <= x1 and y0 <= y1").select(F.struct(*boxes.columns).alias("box"), level.alias("own"))
    return rows.withColumns({"large": F.col("own") >= levels, "own": F.least("own", F.lit(levels - 1))})


def _coarser(rows: DataFrame, others: DataFrame) -> DataFrame:
    """rows once for each level on which others has boxes and that is coarser than their own: a dozen levels at most."""
    on = others.select(F.col("own").alias("_level")).distinct()
    return rows.join(F.broadcast(on), F.col("_level") > F.col("own"))


def overlaps(a: DataFrame, b: DataFrame, finest: float, levels: int = 12) -> DataFrame:
    """The pairs of rows of a and b whose boxes (x0, y0, x1, y1) share a point, with a's columns and b's others.

    A pair meets on the level of the larger box, a grid whose cells hold that box: small
    boxes meet only large ones there. Of a, the side with more rows, a box stands in the one
    cell of its lower left corner; of b in all cells that it touches and those a cell's
    width before, so no pair comes twice. Only boxes that exceed the coarsest level stand
    in several cells of a, and meet in the first that both have. Rows are sorted and merged,
    never broadcast. Boxes with a null or a negative side meet nothing.
    """
    many, few = _graded(a, finest, levels), _graded(b, finest, levels)
    cell = F.lit(finest) * F.pow(F.lit(2.0), "_level")
    at = lambda name: F.floor(F.col(name) / cell)
    own = lambda rows: rows.withColumn("_level", F.col("own"))
    # _up: a's boxes that are smaller than the cell, with b's of the cell's size; else a's of that size with b's of it or smaller
    left = own(many).withColumn("_up", F.lit(False)).unionByName(_coarser(many, few).withColumn("_up", F.lit(True)))
    right = own(few).withColumn("_up", F.explode(F.array(F.lit(False), F.lit(True)))).unionByName(_coarser(few, many).withColumn("_up", F.lit(False)))
    for c in "xy":
        upto = F.when(F.col("large"), at(f"box.{c}1")).otherwise(at(f"box.{c}0"))
        left = left.withColumn(f"_{c}", F.explode(F.sequence(at(f"box.{c}0"), upto)))
        right = right.withColumn(f"_{c}", F.explode(F.sequence(F.floor(F.col(f"box.{c}0") / cell - 1.001), at(f"box.{c}1"))))
    key = ["_level", "_up", "_x", "_y"]
    met = left.select(F.col("box").alias("a"), "large", *key).join(right.select(F.col("box").alias("b"), *key).hint("merge"), key)
    for c in "xy":
        low, high = F.greatest(f"a.{c}0", f"b.{c}0"), F.least(f"a.{c}1", f"b.{c}1")
        met = met.where((low <= high) & (~F.col("large") | (F.floor(low / cell) == F.col(f"_{c}"))))
    return met.select("a.*", *(F.col(f"b.{c}") for c in b.columns if c not in a.columns))


def index_profile(scenes: DataFrame, name: str, key: str = "pixel_id") -> DataFrame:
    """key, profile: the (year, value) series of an index at each point, from the medians of each year's bands."""
    yearly = scenes.groupBy(key, "year").agg(*(F.median(f"{b}_median").alias(f"{b}_median") for b in indices.BANDS))
    return yearly.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("year", indices.index(name).alias("value")))).alias("profile"))


def intersect_regions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pixels that both regions have."""
    return a.select("pixel_id").intersect(b.select("pixel_id"))


def drop_unobserved(points: DataFrame, code: int = 27) -> DataFrame:
    """Points without the code in any year, in reference or classification."""
    unseen = points.where((F.col("reference") == code) | (F.col("classification") == code)).select("pixel_id").distinct()
    return points.join(unseen, "pixel_id", "left_anti")


def allowed_classes(df: DataFrame, barred: Iterable[tuple[str, int]]) -> DataFrame:
    """Rows whose class their basin may have; barred lists (basin, class)."""
    bad = F.lit(False)
    for basin, cls in barred:
        bad = bad | ((F.col("basin") == basin) & (F.col("class") == cls))
    return df.where(~F.coalesce(bad, F.lit(False)))


def normalise(scenes: DataFrame, stats: DataFrame, bands: Iterable[str]) -> DataFrame:
    """Bands as 1 / (1 + exp(-z)) by their basin's and year's mean and standard deviation: of stats, a row for each, which is broadcast."""
    joined = scenes.join(F.broadcast(stats), ["basin", "year"])
    made = {b: indices.logistic(F.col(b), F.col(f"{b}_mean"), F.col(f"{b}_stdDev")) for b in bands}
    return joined.withColumns(made).select(*scenes.columns)


def sample_at_points(points: DataFrame, df: DataFrame) -> DataFrame:
    """points with the class of their pixel and year, 0 where masked or outside. The map is never broadcast."""
    joined = points.join(df.select("pixel_id", "year", "class").hint("merge"), ["pixel_id", "year"], "left")
    return joined.withColumn("class", masks.unmask(F.col("class")))


def accuracy_delta(a: DataFrame, b: DataFrame) -> DataFrame:
    """basin, year, acc_a, acc_b and the absolute difference."""
    joined = a.select("basin", "year", F.col("accuracy").alias("acc_a")).join(b.select("basin", "year", F.col("accuracy").alias("acc_b")), ["basin", "year"])
    return joined.withColumn("delta", F.abs(F.col("acc_a") - F.col("acc_b")))


def wide_by_year(deltas: DataFrame, years: Iterable[int]) -> DataFrame:
    """One row per basin, acc_a, acc_b and delta for each year."""
    pick = lambda c, y: F.max(F.when(F.col("year") == y, F.col(c))).alias(f"{c}_{y}")
    return deltas.groupBy("basin").agg(*(pick(c, y) for y in years for c in ("acc_a", "acc_b", "delta")))


def missing(keys: DataFrame, done: DataFrame) -> DataFrame:
    """Work keys that are not done."""
    return keys.join(done.select(*keys.columns), keys.columns, "left_anti")


def tuned_year(year: Column) -> Column:
    """The tuning year that serves a year."""
    return F.when(year > 2018, 2021).otherwise(2016)


def tuned_parameters(keys: DataFrame, registry: DataFrame, shift: int = 0, rate: float = 0.1, trees: int = 25) -> DataFrame:
    """keys (basin, year) with the learning rate and trees of registry (basin, tuned, rate, trees), else the defaults.

    shift is added to the year before its tuning year is looked up.
    """
    tuned = keys.withColumn("tuned", tuned_year(F.col("year") + shift)).join(registry, ["basin", "tuned"], "left").drop("tuned")
    return tuned.withColumns({"rate": F.coalesce("rate", F.lit(rate)), "trees": F.coalesce("trees", F.lit(trees))})


def usable_bands(selected: DataFrame, available: Iterable[str]) -> DataFrame:
    """bands: the selected ones that exist, in rank order."""
    ranked = F.transform(F.sort_array(F.collect_list(F.struct("rank", "band"))), lambda x: x["band"])
    kept = selected.groupBy("basin", "year").agg(ranked.alias("all"))
    return kept.select("basin", "year", F.array_intersect("all", F.array(*map(F.lit, available))).alias("bands"))
