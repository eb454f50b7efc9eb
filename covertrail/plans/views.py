"""The driver's tables seen as maps, scenes and points; the same views as SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import temporal

FIRST, LAST = 1995, 2001
YEARS = range(FIRST, LAST + 1)

#: WITH list for DuckDB: cell, maps (classes of three maps), a, b, c, scene, points.
VIEWS = """
WITH cell AS (
  SELECT l_partkey AS pixel_id, year(l_shipdate)::INT AS year,
         max(l_suppkey * 7 + l_linenumber) % 10 AS ka, min(l_suppkey * 7 + l_linenumber) % 10 AS kb,
         sum(l_suppkey + l_linenumber) % 10 AS kc
  FROM lineitem GROUP BY ALL
), maps AS (
  SELECT p_partkey AS pixel_id, (p_partkey % 50)::INT AS x, (p_partkey // 50)::INT AS y, p_brand AS basin,
         p_type AS territory, p_size, (900 + p_size)::BIGINT AS area_m2, t.year::INT AS year,
         CASE WHEN ka < 4 THEN 4 WHEN ka < 6 THEN 3 WHEN ka = 6 THEN 12 WHEN ka = 7 THEN 21 WHEN ka = 8 THEN 22 WHEN ka = 9 THEN 33 END AS class_a,
         CASE WHEN kb < 4 THEN 4 WHEN kb < 6 THEN 3 WHEN kb = 6 THEN 12 WHEN kb = 7 THEN 21 WHEN kb = 8 THEN 22 WHEN kb = 9 THEN 33 END AS class_b,
         CASE WHEN kc < 4 THEN 4 WHEN kc < 6 THEN 3 WHEN kc = 6 THEN 12 WHEN kc = 7 THEN 21 WHEN kc = 8 THEN 22 WHEN kc = 9 THEN 33 END AS class_c
  FROM part CROSS JOIN range(1995, 2002) t(year)
  LEFT JOIN cell ON cell.pixel_id = p_partkey AND cell.year = t.year
), base AS (SELECT pixel_id, x, y, basin, territory, p_size, area_m2, year FROM maps),
a AS (SELECT * EXCLUDE (class_a, class_b, class_c), class_a AS class FROM maps),
b AS (SELECT * EXCLUDE (class_a, class_b, class_c), class_b AS class FROM maps),
c AS (SELECT * EXCLUDE (class_a, class_b, class_c), class_c AS class FROM maps),
pairs AS (SELECT * EXCLUDE (class_a, class_b, class_c), class_a AS a, class_b AS b FROM maps),
points AS (
  SELECT pixel_id, basin, year, class_a AS reference, class_b AS classification
  FROM maps WHERE class_a IS NOT NULL AND class_b IS NOT NULL
), region AS (
  SELECT 'basin' AS region_kind, p_brand AS region_id, p_partkey AS pixel_id FROM part
  UNION ALL SELECT 'territory', p_type, p_partkey FROM part
  UNION ALL SELECT 'protected', 'small', p_partkey FROM part WHERE p_size <= 10
), scene AS (
  SELECT l_partkey AS pixel_id, year(l_shipdate)::INT AS year, l_orderkey, l_linenumber,
         l_discount + 0.01e0 AS blue_median, l_tax + 0.02e0 AS green_median, l_quantity / 100 AS red_median,
         l_extendedprice / 100000 AS nir_median, (l_suppkey % 50 + 1) / 100.0e0 AS swir1_median, l_linenumber / 10.0e0 AS swir2_median,
         month(l_shipdate)::INT AS month, (l_returnflag = 'A')::INT + 2 * (l_discount > 0.085)::INT AS quality
  FROM lineitem
)
"""


def _classes(k: Column) -> Column:
    return F.when(k < 4, 4).when(k < 6, 3).when(k == 6, 12).when(k == 7, 21).when(k == 8, 22).when(k == 9, 33)


class Views:
    """Lazily built views over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def maps(self) -> DataFrame:
        """Dense pixel-years with the classes of three maps."""
        mixed, plain = F.col("l_suppkey") * 7 + F.col("l_linenumber"), F.col("l_suppkey") + F.col("l_linenumber")
        cells = (
            self.table("lineitem")
            .groupBy(F.col("l_partkey").alias("pixel_id"), F.year("l_shipdate").alias("year"))
            .agg(*(_classes(k % 10).alias(f"class_{n}") for n, k in (("a", F.max(mixed)), ("b", F.min(mixed)), ("c", F.sum(plain)))))
        )
        return temporal.densify(cells, self.pixels, FIRST, LAST)

    @property
    def pixels(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("pixel_id"),
            (key % 50).cast("int").alias("x"),
            F.expr("p_partkey div 50").cast("int").alias("y"),
            F.col("p_brand").alias("basin"),
            F.col("p_type").alias("territory"),
            "p_size",
            (F.col("p_size") + 900).cast("long").alias("area_m2"),
        )

    def map(self, which: str) -> DataFrame:
        """Map a, b or c with its class as class."""
        others = [f"class_{n}" for n in "abc" if n != which]
        return self.maps.drop(*others).withColumnRenamed(f"class_{which}", "class")

    @property
    def a(self) -> DataFrame:
        return self.map("a")

    @property
    def b(self) -> DataFrame:
        return self.map("b")

    @property
    def pairs(self) -> DataFrame:
        """Both classes of maps a and b as columns a and b."""
        return self.maps.drop("class_c").withColumnsRenamed({"class_a": "a", "class_b": "b"})

    @property
    def points(self) -> DataFrame:
        """Reference points: map a is the reference, map b the classification."""
        both = self.maps.where("class_a is not null and class_b is not null")
        return both.select("pixel_id", "basin", "year", F.col("class_a").alias("reference"), F.col("class_b").alias("classification"))

    @property
    def regions(self) -> DataFrame:
        kinds = F.array(
            F.struct(F.lit("basin").alias("region_kind"), F.col("p_brand").alias("region_id")),
            F.struct(F.lit("territory").alias("region_kind"), F.col("p_type").alias("region_id")),
            F.struct(F.lit("protected").alias("region_kind"), F.when(F.col("p_size") <= 10, "small").alias("region_id")),
        )
        rows = self.table("part").select(F.col("p_partkey").alias("pixel_id"), F.inline(kinds))
        return rows.where("region_id is not null")

    @property
    def scenes(self) -> DataFrame:
        """Line items as scenes with six bands; quality has a bit for clouds (returned) and one for haze (high discount)."""
        c = F.col
        return self.table("lineitem").select(
            c("l_partkey").alias("pixel_id"),
            F.year("l_shipdate").alias("year"),
            "l_orderkey",
            "l_linenumber",
            (c("l_discount") + 0.01).alias("blue_median"),
            (c("l_tax") + 0.02).alias("green_median"),
            (c("l_quantity") / 100).alias("red_median"),
            (c("l_extendedprice") / 100000).alias("nir_median"),
            ((c("l_suppkey") % 50 + 1) / F.lit(100.0)).alias("swir1_median"),
            (c("l_linenumber") / F.lit(10.0)).alias("swir2_median"),
            F.month("l_shipdate").alias("month"),
            ((c("l_returnflag") == "A").cast("int") + 2 * (c("l_discount") > 0.085).cast("int")).alias("quality"),
        )


def micro(col: Column) -> Column:
    """Millionths, rounded: floating results that engines sum in different orders.

    Values beyond a thousand million (a denominator of rounding noise) are NULL.
    """
    return F.when(F.abs(col) < 1e9, F.floor(col * 1e6 + 0.5).cast("long"))


def micro_sql(expression: str) -> str:
    return f"CASE WHEN abs({expression}) < 1e9 THEN floor(({expression}) * 1e6 + 0.5)::BIGINT END"
