"""Per-pixel time series: gap fill, temporal and frequency filters, stability.

Series are dense: a masked year is a row with a NULL class (see densify). All operators
partition by pixel and order by year, so a chain of them shares one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import masks


def by_pixel() -> WindowSpec:
    return Window.partitionBy("pixel_id")


def by_year() -> WindowSpec:
    return by_pixel().orderBy("year")


def densify(df: DataFrame, pixels: DataFrame, first: int, last: int) -> DataFrame:
    """One row for each of pixels (pixel_id and attributes) and year; missing ones are masked.

    The pixel-years are sorted and merged: Spark's estimate of their size does not count
    the years, and once masked years are filtered out it would broadcast them.
    """
    years = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year")
    return pixels.select("*", years).hint("merge").join(df, ["pixel_id", "year"], "left")


def _at(name: str, years: int) -> Column:
    """The value so many years later (earlier if negative)."""
    return (F.lead(name, years) if years > 0 else F.lag(name, -years)).over(by_year())


def _fill(name: str, window: int, cls: int, last: int) -> Column:
    c = F.col(name)
    run = window - 2
    hits = F.lit(False)
    for before in range(1, run + 1):  # the year is the before-th of its run
        inside = F.lit(True)
        for step in range(-before + 1, run - before + 1):
            if step:
                inside = inside & (_at(name, step) != cls)
        hits = hits | ((_at(name, -before) == cls) & inside & (_at(name, run - before + 1) == cls))
    hits = (c != cls) & hits
    if window == 3:
        first = _at("year", -1).isNull() & (c != cls) & (_at(name, 1) == cls) & (_at(name, 2) == cls)
        hits = hits | first
    return F.when(hits & (F.col("year") < last), F.lit(cls)).otherwise(c)


def temporal_fill(df: DataFrame, window: int, classes: Sequence[int], name: str = "class") -> DataFrame:
    """Fills runs of window - 2 years without a class between two years with it.

    Window 3 also fills the first year if the next two have the class. The last year
    never changes; NULL matches nothing. Classes go one after another, each on what the
    one before left. For one class, left-to-right filling equals looking at the input.
    """
    last = df.select("*", F.max("year").over(by_pixel()).alias("_last"))
    for cls in classes:
        last = last.withColumn(name, _fill(name, window, cls, F.col("_last")))
    return last.drop("_last")


def temporal_chain(df: DataFrame, classes: Sequence[int], windows: Sequence[int] = (3, 4, 5), name: str = "class") -> DataFrame:
    """The windows one after another."""
    for window in windows:
        df = temporal_fill(df, window, classes, name)
    return df


def frequency_filter(df: DataFrame, native: int = 90, savanna: int = 80, forest: int = 70, name: str = "class") -> DataFrame:
    """Makes a stable native pixel one class in all years.

    Shares are of the years; a pixel with a masked year stays as it is. Where 3, 4 and
    12 together exceed native percent and the last year is not 4: all years 4 if 4
    exceeds savanna percent; all years 3 if 3 exceeds forest percent, which wins.
    """
    years = F.count("*").over(by_pixel())
    percent = lambda *classes: 100 * F.count_if(F.col(name).isin(*classes)).over(by_pixel()) / years
    whole = F.count(name).over(by_pixel()) == years
    is_native = whole & (percent(3, 4, 12) > native) & (F.max_by(name, "year").over(by_pixel()) != 4)
    rules = [(is_native & (percent(4) > savanna), 4), (is_native & (percent(3) > forest), 3)]
    return df.withColumn(name, masks.where_set(F.col(name), rules))


def gap_fill(df: DataFrame, reference: DataFrame, codes: dict[int, int]) -> DataFrame:
    """Remaps strictly, fills masked years from the reference map, the last from the year before.

    reference: pixel_id, year, class. What stays masked is 0.
    """
    ref = reference.select("pixel_id", "year", F.col("class").alias("_ref"))
    own = masks.remap_strict(F.col("class"), codes)
    filled = df.join(ref, ["pixel_id", "year"], "left").withColumn("class", F.coalesce(own, "_ref", F.lit(0))).drop("_ref")
    is_last = F.lead("year").over(by_year()).isNull()
    before = F.lag("class").over(by_year())
    return filled.withColumn("class", F.when(is_last & (F.col("class") == 0), F.coalesce(before, F.lit(0))).otherwise(F.col("class")))


def canopy_override(df: DataFrame, height: str, above: float = 6, name: str = "class") -> DataFrame:
    """Tall pixels become 3; others whose class is under 5 become 4."""
    tall = F.coalesce(F.col(height) > above, F.lit(False))
    return df.withColumn(name, F.when(tall, 3).when(F.col(name) < 5, 4).otherwise(F.col(name)))


def trailing_any(df: DataFrame, flag: Column, out: str, years: int = 5) -> DataFrame:
    """1 where flag held in this year or the years - 1 before."""
    span = by_year().rangeBetween(-(years - 1), 0)
    return df.withColumn(out, F.max(F.coalesce(flag.cast("int"), F.lit(0))).over(span))


def series_changes(df: DataFrame, name: str = "class") -> DataFrame:
    """Per pixel: n_changes between consecutive observed maps, n_states, mode (lowest of ties), first and last."""
    seen = df.where(F.col(name).isNotNull())
    changed = (F.col(name) != F.lag(name).over(by_year())).cast("int")
    rows = seen.select("pixel_id", "year", F.col(name).alias("c"), changed.alias("changed"))
    return rows.groupBy("pixel_id").agg(
        F.coalesce(F.sum("changed"), F.lit(0)).alias("n_changes"),
        F.countDistinct("c").alias("n_states"),
        F.mode("c", True).alias("mode"),
        F.min_by("c", "year").alias("first"),
        F.max_by("c", "year").alias("last"),
    )


def stability(changes: DataFrame) -> DataFrame:
    """1 stable; 2 or 3 one change, to or from the mode; 4 or 5 two changes with two or three states."""
    n, states = F.col("n_changes"), F.col("n_states")
    rules = [
        (n == 0, 1),
        ((n == 1) & (F.col("last") == F.col("mode")), 2),
        ((n == 1) & (F.col("first") == F.col("mode")), 3),
        ((n == 2) & (states == 2), 4),
        ((n == 2) & (states == 3), 5),
    ]
    return changes.withColumn("stability", masks.where_set(F.lit(None).cast("int"), rules))


def new_use(df: DataFrame, cls: int = 21, name: str = "class") -> DataFrame:
    """1 where the class comes in the next year and is not there yet."""
    comes = (F.lead(name).over(by_year()) == cls) & (F.col(name) != cls)
    return df.withColumn("new_use", F.coalesce(comes, F.lit(False)).cast("int"))


def folds(df: DataFrame, k: int, *cls: str, key: str = "pixel_id", block: int = 1 << 16) -> DataFrame:
    """Stratified fold numbers: round robin inside each class, in the order of whole-number keys.

    Rows are numbered inside blocks of keys and the earlier blocks' rows added, so a
    class of any size is split over tasks.
    """
    cls = cls or ("class",)
    rows = df.withColumn("_block", F.floor(F.col(key) / block))
    sizes = rows.groupBy(*cls, "_block").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*cls).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*cls, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*cls, "_block").orderBy(key)) - 1
    numbered = rows.withColumn("_inside", inside).join(sizes, [*cls, "_block"])
    return numbered.select(*df.columns, ((F.col("_before") + F.col("_inside")) % k).cast("int").alias("fold"))
