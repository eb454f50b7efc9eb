"""Queries on maps: areas, comparison, time series, neighbourhoods."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import legend, masks
from ..operators import areas, compare, spatial, temporal
from .views import FIRST, LAST, VIEWS, Views, micro, micro_sql

Q: dict = {}
SQL: dict[str, str] = {}

HA = "sum(area_m2)::BIGINT / 10000"


def query(name: str, sql: str | None = None, views: bool = True, into: tuple[dict, dict] | None = None):
    """Registers a function of Views, and its SQL after the view list."""
    found, texts = into or (Q, SQL)

    def add(f):
        found[name] = lambda spark, folder: f(Views(spark, folder))
        if sql:
            texts[name] = (VIEWS if views else "") + sql
        return f

    return add


def _values(codes: dict) -> str:
    return ", ".join(f"({k}, {v})" for k, v in codes.items())


def _fill_sql(window: int, source: str, cls: int = 4, out: str = "class") -> str:
    """One pass of the temporal filter over source."""
    at = lambda k: f"lead(class, {k}) OVER w" if k > 0 else f"lag(class, {-k}) OVER w"
    run, hits = window - 2, []
    for before in range(1, run + 1):
        tests = [f"{at(-before)} = {cls}", f"{at(run - before + 1)} = {cls}"]
        tests += [f"{at(k)} <> {cls}" for k in range(1 - before, run - before + 1) if k]
        hits.append("(" + " AND ".join(tests) + ")")
    if window == 3:
        hits.append(f"(year = {FIRST} AND {at(1)} = {cls} AND {at(2)} = {cls})")
    rest = "pixel_id, x, y, basin, year"
    return f"SELECT {rest}, CASE WHEN class <> {cls} AND year < {LAST} AND ({' OR '.join(hits)}) THEN {cls} ELSE class END AS {out} FROM {source} WINDOW w AS (PARTITION BY pixel_id ORDER BY year)"


# areas


@query("a1_area_by_class", f"SELECT basin, year, class, {HA} AS area FROM a WHERE class IS NOT NULL GROUP BY ALL")
def area_by_class(v: Views):
    return areas.area_by(v.a, "basin", "year", "class")


@query("a2_area_by_territory", "SELECT territory, class, sum(area_m2)::BIGINT / 1000000 AS area FROM a WHERE class IS NOT NULL GROUP BY ALL")
def area_by_territory(v: Views):
    return areas.area_by(v.a, "territory", "class", unit=areas.SQUARE_KM)


@query("a3_area_by_regions", f"SELECT region_kind, region_id, year, class, {HA} AS area FROM a JOIN region USING (pixel_id) WHERE class IS NOT NULL GROUP BY ALL")
def area_by_regions(v: Views):
    return areas.area_by_regions(v.a, v.regions)


@query(
    "a4_transitions",
    f"SELECT f.class * 100 + t.class AS code, sum(f.area_m2)::BIGINT / 10000 AS area FROM a f JOIN a t USING (pixel_id) WHERE f.year = {FIRST} AND t.year = {LAST} AND f.class IS NOT NULL AND t.class IS NOT NULL GROUP BY ALL",
)
def transitions(v: Views):
    return areas.transitions(v.a, FIRST, LAST)


@query("a5_basin_rollup", f"SELECT basin, year, class, {HA} AS area FROM a WHERE class IS NOT NULL GROUP BY GROUPING SETS ((basin, year, class), (year, class))")
def basin_rollup(v: Views):
    return areas.rollup_basins(v.a)


@query("a6_region_group", f"SELECT region_kind, class, year, {HA} AS area FROM a JOIN region USING (pixel_id) WHERE class IS NOT NULL GROUP BY ALL")
def region_group(v: Views):
    return v.a.where("class is not null").join(v.regions.hint("merge"), "pixel_id").groupBy("region_kind", "class", "year").agg(areas.area())


@query(
    "a7_class_share",
    f"SELECT basin, year, class, {micro_sql('area / sum(area) OVER (PARTITION BY basin, year)')} AS share FROM (SELECT basin, year, class, {HA} AS area FROM a WHERE class IS NOT NULL GROUP BY ALL)",
)
def class_share(v: Views):
    found = areas.shares(areas.area_by(v.a, "basin", "year", "class"), "basin", "year")
    return found.select("basin", "year", "class", micro(F.col("share")).alias("share"))


@query("a9_composite_min", "SELECT pixel_id, year, min(red_median) AS red_min, max(red_median) AS red_max FROM scene GROUP BY ALL")
def composite_min(v: Views):
    lows = areas.composite(v.scenes, ["pixel_id", "year"], ["red_median"], "min").withColumnRenamed("red_median", "red_min")
    highs = areas.composite(v.scenes, ["pixel_id", "year"], ["red_median"], "max").withColumnRenamed("red_median", "red_max")
    return lows.join(highs, ["pixel_id", "year"])


@query("a8_composite_median", f"SELECT pixel_id, year, {micro_sql('median(red_median)')} AS red, {micro_sql('median(nir_median)')} AS nir FROM scene GROUP BY ALL")
def composite_median(v: Views):
    found = areas.composite(v.scenes, ["pixel_id", "year"], ["red_median", "nir_median"])
    return found.select("pixel_id", "year", micro(F.col("red_median")).alias("red"), micro(F.col("nir_median")).alias("nir"))


@query("a10_class_histogram", "SELECT basin, class, count(*) AS n FROM a GROUP BY ALL")
def class_histogram(v: Views):
    return areas.histogram(v.a, "basin")


@query("a11_distinct_values", "SELECT DISTINCT basin, territory FROM a")
def distinct_values(v: Views):
    return v.a.select("basin", "territory").distinct()


@query("a12_incomplete_groups", "SELECT pixel_id, count(DISTINCT year) AS n FROM a WHERE class IS NOT NULL GROUP BY 1 HAVING n < 7")
def incomplete_groups(v: Views):
    return areas.incomplete(v.a.where("class is not null"), "pixel_id", "year", 7)


@query("a13_any_event", "SELECT pixel_id, max(coalesce((class = 33)::INT, 0)) AS event FROM a GROUP BY 1")
def any_event(v: Views):
    return v.a.groupBy("pixel_id").agg(F.max(F.coalesce((F.col("class") == 33).cast("int"), F.lit(0))).alias("event"))


@query(
    "a19_axis_range",
    f"""SELECT class, CASE WHEN lo < hi THEN lo - abs(lo * 0.3e0) ELSE lo END AS axis_low, CASE WHEN lo < hi THEN hi + hi * 0.2e0 ELSE hi END AS axis_high,
        CASE WHEN lo < hi THEN floor(((hi + hi * 0.2e0) - (lo - abs(lo * 0.3e0))) / 5)::BIGINT ELSE 0 END AS tick
        FROM (SELECT class, min(area) AS lo, max(area) AS hi FROM (SELECT year, class, {HA} AS area FROM a WHERE class IS NOT NULL GROUP BY ALL) GROUP BY 1)""",
)
def axis_range(v: Views):
    return areas.axis_ranges(areas.area_by(v.a, "year", "class"))


@query(
    "a23_majority_key",
    "SELECT basin, class, n FROM (SELECT *, row_number() OVER (PARTITION BY basin ORDER BY n DESC, class) AS r FROM (SELECT basin, class, count(*) AS n FROM a WHERE class IS NOT NULL GROUP BY ALL)) WHERE r = 1",
)
def majority(v: Views):
    return areas.majority_key(v.a.where("class is not null"), "basin", "class")


@query("a24_select_series", f"SELECT basin, year, class, {HA} AS area FROM a WHERE class IN (3, 4, 12) AND basin <> 'Brand#11' GROUP BY ALL")
def select_series(v: Views):
    kept = v.a.where(masks.in_classes(F.col("class"), (3, 4, 12)) & (F.col("basin") != "Brand#11"))
    return areas.area_by(kept, "basin", "year", "class")


@query(
    "j8_gain_loss",
    f"""SELECT basin, class, f AS area_first, t AS area_last, abs(t - f) AS difference, round((100 * (t - f) / nullif(f, 0))::DECIMAL(18,6), 2)::DECIMAL(18,2) AS percent
        FROM (SELECT basin, class, max(area) FILTER (year = {FIRST}) AS f, max(area) FILTER (year = {LAST}) AS t
              FROM (SELECT basin, year, class, {HA} AS area FROM a WHERE class IS NOT NULL AND year IN ({FIRST}, {LAST}) GROUP BY ALL) GROUP BY ALL)""",
)
def gain_loss(v: Views):
    found = areas.gain_loss(areas.area_by(v.a, "basin", "year", "class"), FIRST, LAST, "basin", "class")
    return found.withColumn("percent", F.col("percent").cast("decimal(18,2)"))


# masks and remaps

@query("p2_remap_strict", f"SELECT pixel_id, year, m.k AS class FROM a LEFT JOIN (VALUES {_values(legend.MAP_CODES)}) m(c, k) ON c = class * 1 + 1")
def remap_strict(v: Views):
    return v.a.select("pixel_id", "year", masks.remap_strict(F.col("class") + 1, legend.MAP_CODES).alias("class"))


@query("p3_remap_keep", f"SELECT pixel_id, year, coalesce(m.k, class + 6) AS class FROM a LEFT JOIN (VALUES {_values(legend.TABLE_CODES)}) m(c, k) ON c = class + 6")
def remap_keep(v: Views):
    return v.a.select("pixel_id", "year", masks.remap_keep(F.col("class") + 6, legend.TABLE_CODES).alias("class"))


@query(
    "p4_p7_masks",
    """SELECT pixel_id, year, coalesce(a, 0) AS unmasked, CASE WHEN b = 4 THEN a END AS updated, CASE WHEN b - 4 <> 0 THEN b - 4 END AS self_masked,
              CASE WHEN a = 33 THEN 50 WHEN a <= 4 THEN 40 WHEN a = 3 THEN 30 ELSE a END AS chained, coalesce(b, a) AS blended, (a = 4)::INT AS is_4 FROM pairs""",
)
def mask_functions(v: Views):
    a, b = F.col("a"), F.col("b")
    return v.pairs.select(
        "pixel_id",
        "year",
        masks.unmask(a).alias("unmasked"),
        masks.update_mask(a, b == 4).alias("updated"),
        masks.self_mask(b - 4).alias("self_masked"),
        masks.where_set(a, [(a == 3, 30), (a <= 4, 40), (a == 33, 50)]).alias("chained"),
        masks.blend(a, b).alias("blended"),
        masks.binarize(a, 4).alias("is_4"),
    )


@query(
    "p16_legend",
    f"SELECT year, class, area, m.n AS cobertura, m.l AS cob_level1, m.c AS cob_color, CASE m.l WHEN 'Natural' THEN '#32a65e' WHEN 'Antrópico' THEN '#FFFFB2' ELSE '#112013' END AS nat_color, 'cobertura' AS total FROM (SELECT year, class, {HA} AS area FROM a WHERE class IS NOT NULL GROUP BY ALL) LEFT JOIN (VALUES "
    + ", ".join(f"({k}, '{n}', '{w}', '{c}')" for k, (n, w, c) in legend.LEGEND.items())
    + ") m(k, n, l, c) ON k = class",
)
def legend_enrich(v: Views):
    return legend.enrich(areas.area_by(v.a, "year", "class"))


@query(
    "p20_levels",
    f"SELECT m.l1, m.l2, m.l3, {HA} AS area FROM a JOIN (VALUES " + ", ".join(f"({k}, {x}, {y}, {z})" for k, (x, y, z) in legend.LEVELS.items()) + ") m(k, l1, l2, l3) ON k = class GROUP BY ALL",
)
def levels(v: Views):
    made = {f"l{i}": legend.level(F.col("class"), i) for i in (1, 2, 3)}
    return v.a.withColumns(made).where("l1 is not null").groupBy("l1", "l2", "l3").agg(areas.area())


# comparison


_CODE = "CASE WHEN coalesce(a = k, false) AND coalesce(b = k, false) THEN 1 WHEN coalesce(b = k, false) THEN 2 WHEN coalesce(a = k, false) THEN 3 END"


@query("c1_agreement", f"SELECT pixel_id, year, {_CODE.replace('= k', '= 4')} AS code FROM pairs")
def agreement(v: Views):
    found = compare.pair_maps(v.a, v.b)
    return found.select("pixel_id", "year", compare.agreement(4, F.col("a"), F.col("b")).alias("code"))


@query("c2_agreement_older", f"SELECT basin, year, code, {HA} AS area FROM (SELECT basin, year, area_m2, CASE WHEN a = 3 AND coalesce(b = 3, false) THEN 1 WHEN a = 3 THEN 2 WHEN b = 3 THEN 3 END AS code FROM pairs) WHERE code IS NOT NULL GROUP BY ALL")
def agreement_older(v: Views):
    """The numbering in which the first map is the newer one."""
    coded = v.pairs.withColumn("code", compare.agreement(3, F.col("a"), F.col("b"), newer="a")).where("code is not null")
    return coded.groupBy("basin", "year", "code").agg(areas.area())


@query("c3_synthesis", f"SELECT pixel_id, year, CASE WHEN code IN (1, 3) THEN a WHEN code = 2 THEN b END AS plain, CASE WHEN code IN (1, 3) THEN b WHEN code = 2 THEN a END AS swapped FROM (SELECT *, {_CODE.replace('= k', '= 3')} AS code FROM pairs)")
def agreement_synthesis(v: Views):
    a, b = F.col("a"), F.col("b")
    code = compare.agreement(3, a, b)
    return v.pairs.select("pixel_id", "year", compare.synthesis(code, a, b).alias("plain"), compare.synthesis(code, a, b, swapped=True).alias("swapped"))


@query(
    "c4_agreement_area",
    f"SELECT basin, year, class, code, {HA} AS area FROM (SELECT basin, year, k AS class, area_m2, {_CODE} AS code FROM pairs, (VALUES (3), (4), (12), (21), (22), (33)) t(k)) WHERE code IS NOT NULL GROUP BY ALL",
)
def agreement_area(v: Views):
    return compare.agreement_area(v.pairs, list(legend.CONFUSION), "basin", "year")


@query("c5_presence", "SELECT pixel_id, year, 2 * coalesce((a = 4)::INT, 0) + coalesce((b = 4)::INT, 0) AS presence FROM pairs")
def presence(v: Views):
    return v.pairs.select("pixel_id", "year", compare.presence(4, F.col("a"), F.col("b")).alias("presence"))


@query("c6_point_disagreement", "SELECT pixel_id, year, reference, classification FROM points WHERE reference <> classification")
def point_disagreement(v: Views):
    return v.points.where("reference <> classification").select("pixel_id", "year", "reference", "classification")


_STABILITY = """CASE WHEN n_changes = 2 AND n_states = 3 THEN 5 WHEN n_changes = 2 AND n_states = 2 THEN 4 WHEN n_changes = 1 AND first = mode THEN 3 WHEN n_changes = 1 AND last = mode THEN 2 WHEN n_changes = 0 THEN 1 END"""


def _changes_sql(source: str) -> str:
    return f"""SELECT pixel_id, coalesce(sum(changed), 0)::BIGINT AS n_changes, count(DISTINCT class) AS n_states,
  (SELECT m.class FROM (SELECT class, count(*) AS n FROM {source} s WHERE s.pixel_id = o.pixel_id AND class IS NOT NULL GROUP BY 1 ORDER BY n DESC, class LIMIT 1) m) AS mode,
  arg_min(class, year) AS first, arg_max(class, year) AS last
FROM (SELECT *, (class <> lag(class) OVER (PARTITION BY pixel_id ORDER BY year))::INT AS changed FROM {source} WHERE class IS NOT NULL) o GROUP BY pixel_id"""


@query(
    "c7_three_maps",
    ", three AS (SELECT pixel_id * 10000 + year AS pixel_id, 1 AS year, class FROM a UNION ALL SELECT pixel_id * 10000 + year, 2, class FROM b UNION ALL SELECT pixel_id * 10000 + year, 3, class FROM c), "
    f"changes AS ({_changes_sql('three')}) SELECT *, {_STABILITY} AS stability FROM changes",
)
def three_maps(v: Views):
    cell = (F.col("pixel_id") * 10000 + F.col("year")).alias("pixel_id")  # a pixel in each year is a series of three maps
    rows = v.maps.select(cell, F.inline(F.array(*(F.struct(F.lit(i).alias("year"), F.col(f"class_{n}").alias("class")) for i, n in enumerate("abc", 1)))))
    return temporal.stability(temporal.series_changes(rows))


@query("c8_any_layer", "SELECT pixel_id, year, (coalesce((a = 33)::INT, 0) + coalesce((b = 33)::INT, 0) > 0)::INT AS any_layer FROM pairs")
def any_layer(v: Views):
    return v.pairs.select("pixel_id", "year", compare.any_layer((F.col("a") == 33).cast("int"), (F.col("b") == 33).cast("int")).alias("any_layer"))


@query("c9_basin_mask", "SELECT pixel_id, year, (basin IN ('Brand#11', 'Brand#23', 'Brand#45'))::INT AS flagged FROM a")
def basin_mask(v: Views):
    return v.a.select("pixel_id", "year", F.col("basin").isin("Brand#11", "Brand#23", "Brand#45").cast("int").alias("flagged"))


# time series


def _window(size: int):
    @query(f"w{size - 2}_temporal_fill_{size}", " " + _fill_sql(size, "a"))
    def fill(v: Views):
        return temporal.temporal_fill(v.a.select("pixel_id", "x", "y", "basin", "year", "class"), size, [4])

    return fill


for _size in (3, 4, 5):
    _window(_size)


@query("w5_temporal_chain", ", f1 AS (" + _fill_sql(3, "a", 4) + "), f2 AS (" + _fill_sql(3, "f1", 3) + "), f3 AS (" + _fill_sql(4, "f2", 4) + "), f4 AS (" + _fill_sql(4, "f3", 3) + "), f5 AS (" + _fill_sql(5, "f4", 4) + ") " + _fill_sql(5, "f5", 3))
def temporal_chain(v: Views):
    return temporal.temporal_chain(v.a.select("pixel_id", "x", "y", "basin", "year", "class"), [4, 3])


@query(
    "w6_frequency_filter",
    """, f AS (SELECT *, count(*) OVER w AS n, count(class) OVER w AS seen, 100.0e0 * count(*) FILTER (class IN (3, 4, 12)) OVER w / count(*) OVER w AS nat,
    100.0e0 * count(*) FILTER (class = 4) OVER w / count(*) OVER w AS sav, 100.0e0 * count(*) FILTER (class = 3) OVER w / count(*) OVER w AS wood, arg_max(class, year) OVER w AS last
    FROM a WINDOW w AS (PARTITION BY pixel_id))
    SELECT pixel_id, year, CASE WHEN n = seen AND nat > 60 AND last <> 4 AND wood > 20 THEN 3 WHEN n = seen AND nat > 60 AND last <> 4 AND sav > 30 THEN 4 ELSE class END AS class FROM f""",
)
def frequency_filter(v: Views):
    return temporal.frequency_filter(v.a, 60, 30, 20).select("pixel_id", "year", "class")


@query(
    "w7_gap_fill",
    f""", g AS (SELECT a.pixel_id, a.year, coalesce(m.k, b.class, 0) AS class FROM a JOIN b USING (pixel_id, year) LEFT JOIN (VALUES {_values({3: 3, 12: 12, 21: 21, 22: 22, 33: 33})}) m(c, k) ON m.c = a.class)
    SELECT pixel_id, year, CASE WHEN year = {LAST} AND class = 0 THEN coalesce(lag(class) OVER (PARTITION BY pixel_id ORDER BY year), 0) ELSE class END AS class FROM g""",
)
def gap_fill(v: Views):
    return temporal.gap_fill(v.a, v.b, {3: 3, 12: 12, 21: 21, 22: 22, 33: 33}).select("pixel_id", "year", "class")


@query("w8_canopy", "SELECT pixel_id, year, CASE WHEN p_size > 25 THEN 3 WHEN class < 5 THEN 4 ELSE class END AS class FROM a")
def canopy(v: Views):
    return temporal.canopy_override(v.a, "p_size", 25).select("pixel_id", "year", "class")


_TRAIL = "WINDOW w AS (PARTITION BY pixel_id ORDER BY year RANGE BETWEEN 4 PRECEDING AND CURRENT ROW)"


@query("w9_fire_mask", f"SELECT pixel_id, year, max(coalesce((class = 33)::INT, 0)) OVER w AS burned FROM a {_TRAIL}")
def fire_mask(v: Views):
    return temporal.trailing_any(v.a, F.col("class") == 33, "burned").select("pixel_id", "year", "burned")


@query("w10_alert_mask", f"SELECT pixel_id, year, (max(coalesce((year > {FIRST} AND class * 100 // 100 = 22)::INT, 0)) OVER w = 0)::INT AS clear FROM a {_TRAIL}")
def alert_mask(v: Views):
    alert = (F.col("year") > FIRST) & (F.expr("class * 100 div 100") == 22)
    found = temporal.trailing_any(v.a, alert, "alert")
    return found.select("pixel_id", "year", (F.col("alert") == 0).cast("int").alias("clear"))


@query("w11_annual_masks", "SELECT pixel_id, year, (max(coalesce((a = 33)::INT, 0)) = 0)::INT AS unburned, (max(coalesce((b = 22)::INT, 0)) = 0)::INT AS unalerted FROM pairs GROUP BY ALL")
def annual_masks(v: Views):
    none = lambda c, k: (F.max(F.coalesce((F.col(c) == k).cast("int"), F.lit(0))) == 0).cast("int")
    return v.pairs.groupBy("pixel_id", "year").agg(none("a", 33).alias("unburned"), none("b", 22).alias("unalerted"))


@query("w12_w13_stability", f", changes AS ({_changes_sql('a')}) SELECT *, {_STABILITY} AS stability FROM changes")
def stability(v: Views):
    return temporal.stability(temporal.series_changes(v.a))


@query("w14_new_use", "SELECT pixel_id, year, coalesce(lead(class) OVER w = 21 AND class <> 21, false)::INT AS new_use FROM a WINDOW w AS (PARTITION BY pixel_id ORDER BY year)")
def new_use(v: Views):
    return temporal.new_use(v.a).select("pixel_id", "year", "new_use")


@query("w15_pixel_profile", "SELECT pixel_id, list(class ORDER BY year)::VARCHAR AS profile FROM (SELECT pixel_id, year, coalesce(class, 0) AS class FROM a) GROUP BY 1")
def pixel_profile(v: Views):
    series = F.transform(F.sort_array(F.collect_list(F.struct("year", F.coalesce("class", F.lit(0)).alias("c")))), lambda x: x["c"].cast("string"))
    return v.a.groupBy("pixel_id").agg(F.concat(F.lit("["), F.array_join(series, ", "), F.lit("]")).alias("profile"))


@query("w16_folds", "SELECT pixel_id, year, class, ((row_number() OVER (PARTITION BY year, class ORDER BY pixel_id) - 1) % 5)::INT AS fold FROM a WHERE class IS NOT NULL")
def folds(v: Views):
    return temporal.folds(v.a.where("class is not null").select("pixel_id", "year", "class"), 5, "year", "class")


# neighbourhoods, inside each year of the map


def _grid(v: Views):
    return v.a.select("x", "y", "year", "class")


_GRID = ", grid AS (SELECT x, y, year, class FROM a)"
_MODE = """ modes AS (SELECT x, y, year, class AS focal FROM (
  SELECT g.x, g.y, g.year, n.class, row_number() OVER (PARTITION BY g.x, g.y, g.year ORDER BY count(*) DESC, n.class) AS r
  FROM grid g JOIN grid n ON g.year = n.year AND n.x BETWEEN g.x - 2 AND g.x + 2 AND n.y BETWEEN g.y - 2 AND g.y + 2 AND n.class IS NOT NULL GROUP BY g.x, g.y, g.year, n.class) WHERE r = 1)"""


def _component_sql(most: int) -> str:
    return f""" edges AS (
  SELECT g.year, g.x, g.y, n.x AS nx, n.y AS ny FROM grid g, (VALUES (-1), (0), (1)) i(i), (VALUES (-1), (0), (1)) j(j), grid n
  WHERE n.x = g.x + i AND n.y = g.y + j AND n.year = g.year AND n.class = g.class
), reach AS (
  SELECT year, x AS ox, y AS oy, x, y FROM grid WHERE class IS NOT NULL
  UNION
  SELECT r.year, r.ox, r.oy, e.nx, e.ny FROM reach r JOIN edges e ON e.year = r.year AND e.x = r.x AND e.y = r.y
), conns AS (SELECT year, ox AS x, oy AS y, least(count(*), {most})::INT AS conn FROM reach GROUP BY ALL)"""


_RECURSIVE = VIEWS.replace("WITH cell", "WITH RECURSIVE cell")


@query("n1_connected_count", _RECURSIVE + _GRID + "," + _component_sql(10) + " SELECT x, y, year, class, conn FROM grid LEFT JOIN conns USING (x, y, year)", views=False)
def connected_count(v: Views):
    return spatial.connected_count(_grid(v), 10, "year").select("x", "y", "year", "class", "conn")


@query("n2_focal_mode", _GRID + "," + _MODE + " SELECT x, y, year, class, focal FROM grid LEFT JOIN modes USING (x, y, year)")
def focal_mode(v: Views):
    return spatial.focal_mode(_grid(v), 2, "year").select("x", "y", "year", "class", "focal")


@query(
    "n3_spatial_filter",
    _RECURSIVE + _GRID + "," + _component_sql(13) + "," + _MODE + " SELECT x, y, year, CASE WHEN conn <= 12 THEN coalesce(focal, class) ELSE class END AS class FROM grid LEFT JOIN conns USING (x, y, year) LEFT JOIN modes USING (x, y, year)",
    views=False,
)
def spatial_filter(v: Views):
    return spatial.spatial_filter(_grid(v), 12, 200, "year").select("x", "y", "year", "class")


@query(
    "n4_opening",
    _GRID
    + """, flags AS (SELECT x, y, year, coalesce((class <= 4)::INT, 0) AS f FROM grid),
    low AS (SELECT g.x, g.y, g.year, min(n.f) AS f FROM flags g JOIN flags n ON g.year = n.year AND n.x BETWEEN g.x - 1 AND g.x + 1 AND n.y BETWEEN g.y - 1 AND g.y + 1 GROUP BY ALL)
    SELECT g.x, g.y, g.year, max(n.f) AS f FROM low g JOIN low n ON g.year = n.year AND n.x BETWEEN g.x - 4 AND g.x + 4 AND n.y BETWEEN g.y - 4 AND g.y + 4 GROUP BY ALL""",
)
def opening(v: Views):
    flags = _grid(v).select("x", "y", "year", F.coalesce((F.col("class") <= 4).cast("int"), F.lit(0)).alias("f"))
    return spatial.opening(flags, "f", 1, 4, "year")


@query(
    "n5_contrast",
    ", grid AS (SELECT x, y, year, p_size AS band FROM a) SELECT g.x, g.y, g.year, avg((n.band - g.band) * (n.band - g.band)) AS contrast FROM grid g JOIN grid n ON g.year = n.year AND n.x BETWEEN g.x - 1 AND g.x + 1 AND n.y BETWEEN g.y - 1 AND g.y + 1 AND (g.x, g.y) <> (n.x, n.y) GROUP BY ALL",
)
def contrast(v: Views):
    return spatial.contrast(v.a.select("x", "y", "year", "p_size"), "p_size", "year")


@query(
    "n6_within_extent",
    ", extent AS (SELECT basin, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM a GROUP BY 1) SELECT DISTINCT p.pixel_id, e.basin AS extent FROM a p JOIN extent e ON x BETWEEN x0 - 2 AND x1 + 2 AND y BETWEEN y0 - 2 AND y1 + 2",
)
def within_extent(v: Views):
    return spatial.within_extent(v.pixels.select("pixel_id", "x", "y"), spatial.extent_of(v.pixels, "basin"), 2, "basin").select("pixel_id", "extent")


@query(
    "n7_small_patches",
    _RECURSIVE
    + ", grid AS (SELECT x, y, nullif(coalesce(lead(class) OVER (PARTITION BY pixel_id ORDER BY year) = 21 AND class <> 21, false)::INT, 0) AS class, year FROM a),"
    + _component_sql(6)
    + " SELECT x, y, year, (conn <= 5)::INT AS small FROM conns",
    views=False,
)
def small_patches(v: Views):
    changes = temporal.new_use(v.a).select("x", "y", "year", masks.self_mask(F.col("new_use")).alias("class"))
    counted = spatial.connected_count(changes, 6, "year").where("conn is not null")
    return counted.select("x", "y", "year", (F.col("conn") <= 5).cast("int").alias("small"))
