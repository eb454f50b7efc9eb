"""Queries that write tables and maps to scratch and read them back, and work ledgers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import areas, tables
from ..scratch import new_path
from ..sources import files
from ..sources import ledger as ledgers
from .maps import HA
from .maps import query as _query
from .views import Views

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    return _query(name, sql, into=(Q, SQL))


@query("s1_s3_s10_csv", f"SELECT basin, year, class, {HA} AS area FROM a WHERE class IS NOT NULL GROUP BY ALL")
def csv_round_trip(v: Views):
    path = new_path(v.spark, "areas")
    files.write_table(areas.area_by(v.a, "basin", "year", "class"), path, "csv")
    return files.read_csv_glob(v.spark, f"{path}/*.csv", "basin string, year int, class int, area double", "UTF-8").drop("file_name")


@query("s2_parse_names", "SELECT basin, 'GTB' AS model, 5 AS version, year, count(*) AS n FROM a GROUP BY ALL")
def parse_names(v: Views):
    name = F.concat_ws("_", F.lit("areaXclasse"), "basin", F.lit("GTB"), F.lit("5"), F.concat(F.col("year").cast("string"), F.lit(".csv")))
    parsed = files.parse_name(v.a.select(name.alias("file_name")), ("*", "basin", "model", "version", "year"))
    return parsed.groupBy("basin", "model", F.col("version").cast("int").alias("version"), F.col("year").cast("int").alias("year")).agg(F.count("*").alias("n"))


@query("s4_s9_maps", "SELECT pixel_id, year, class, 'probability' AS product FROM a WHERE basin = 'Brand#12'")
def maps(v: Views):
    path = new_path(v.spark, "map")
    files.write_map(v.a.select("pixel_id", "year", "class", "basin"), path, version="9", model="GTB")
    found = files.scan_map(v.spark, path, version="9", basin="Brand#12")
    return found.select("pixel_id", "year", "class", files.product_of(F.col("version").cast("int")).alias("product"))


@query("s5_scan_scenes", "SELECT pixel_id, year, red_median FROM scene WHERE year IN (1996, 1999) AND l_linenumber IN (1, 2)")
def scan_scenes(v: Views):
    return files.scan_scenes(v.scenes, ["pixel_id", "year", "red_median"], year=(1996, 1999), l_linenumber=(1, 2))


@query("s6_scan_samples", "SELECT pixel_id, year, class FROM a WHERE basin IN ('Brand#11', 'Brand#23') AND year = 1998")
def scan_samples(v: Views):
    return files.scan_scenes(v.a, ["pixel_id", "year", "class"], basin=("Brand#11", "Brand#23"), year=(1998,))


@query("s7_s11_registry", ", k AS (SELECT DISTINCT basin, p_size FROM a) SELECT basin AS key, count(*) AS n, max(p_size) AS most FROM k GROUP BY 1")
def registry(v: Views):
    path = new_path(v.spark, "registry")
    files.write_registry(v.a.select("basin", "p_size").distinct(), path, "basin", "p_size")
    lines = files.load_registry(v.spark, path, "array<int>", whole=False)
    return lines.select("key", F.size("value").cast("long").alias("n"), F.array_max("value").alias("most"))


def _ranked(v: Views):
    counted = v.a.where("class is not null").groupBy("basin", "year", F.col("territory").alias("band")).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("basin", "year").orderBy(F.desc("n"), "band"))
    return counted.select("basin", "year", "band", rank.alias("rank"))


@query("s12_selected_bands", ", g AS (SELECT basin, year, territory AS band, count(*) AS n FROM a WHERE class IS NOT NULL GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY basin, year ORDER BY n DESC, band)::INT AS rank FROM g) SELECT basin, year, band, rank, count(*) OVER (PARTITION BY basin, year) AS limear FROM r WHERE rank <= 3")
def selected_bands(v: Views):
    return files.selected_bands(_ranked(v), 3).select("basin", "year", "band", "rank", "limear")


@query("j11_l13_band_registry", ", g AS (SELECT basin, year, territory AS band, count(*) AS n FROM a WHERE class IS NOT NULL GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY basin, year ORDER BY n DESC, band) AS rank FROM g) SELECT basin, year, coalesce(string_agg(band, ',' ORDER BY rank) FILTER (band NOT LIKE 'PROMO%'), '') AS bands FROM r GROUP BY ALL")
def band_registry(v: Views):
    names = [r.band for r in v.table("part").select(F.col("p_type").alias("band")).distinct().collect() if not r.band.startswith("PROMO")]  # a few types
    return tables.usable_bands(_ranked(v), names).select("basin", "year", F.array_join("bands", ",").alias("bands"))


@query("s13_s14_ledger", ", keys AS (SELECT DISTINCT basin, territory, year FROM a), done AS (SELECT DISTINCT basin, territory, year FROM a WHERE class = 22) SELECT basin, territory, year FROM keys ANTI JOIN done USING (basin, territory, year)")
def ledger(v: Views):
    """Work that a ledger, written and read back, does not record as done."""
    path = new_path(v.spark, "ledger")
    files.write_table(v.a.where("class = 22").select("basin", "territory", "year").distinct(), path)
    return tables.missing(v.a.select("basin", "territory", "year").distinct(), v.spark.read.parquet(path))


@query("s13_resumed_areas", f"SELECT basin, year, class, {HA} AS area FROM a WHERE class IS NOT NULL GROUP BY ALL")
def resumed_areas(v: Views):
    """Areas by (basin, year), made by a run that stops after the early years and one that goes on where it stopped."""
    path, work = new_path(v.spark, "resumed"), v.a.select("basin", "year").distinct()
    make = lambda keys: areas.area_by(v.a.join(keys, ["basin", "year"], "left_semi"), "basin", "year", "class")
    ledgers.run(work.where("year < 1998"), make, path)
    return ledgers.run(work, make, path, batches=2)


@query("w15_window_of_tiles", "SELECT pixel_id, x, y, year, class FROM a WHERE x BETWEEN 7 AND 30 AND y BETWEEN 3 AND 21")
def window_of_tiles(v: Views):
    """The profile of a window of a map in tiles."""
    path = new_path(v.spark, "tiled")
    files.write_tiled(v.a.select("pixel_id", "x", "y", "year", "class"), path, side=16)
    return files.read_window(v.spark, path, 7, 3, 30, 21, side=16)


@query("s7_whole_registry", ", k AS (SELECT DISTINCT basin, p_size FROM a) SELECT basin AS key, count(*) AS n, sum(p_size)::BIGINT AS total FROM k GROUP BY 1")
def whole_registry(v: Views):
    """One JSON object in one file, as registries of basins come."""
    path = new_path(v.spark, "registry")
    values = v.a.select("basin", "p_size").distinct().groupBy("basin").agg(F.sort_array(F.collect_list("p_size")).alias("sizes"))
    entry = F.map_from_entries(F.sort_array(F.collect_list(F.struct("basin", "sizes"))))  # an entry for each basin: some dozens
    values.agg(F.to_json(entry).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    found = files.load_registry(v.spark, path, "array<int>")
    return found.select("key", F.size("value").cast("long").alias("n"), F.aggregate("value", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))
