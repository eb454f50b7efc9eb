"""Queries on features and samples: spectral indices, normalisation, joins, sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import indices, legend, masks
from ..operators import areas, compare, sampling, tables
from .maps import HA
from .maps import query as _query
from .views import Views, micro, micro_sql

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    return _query(name, sql, into=(Q, SQL))


# The index formulas again, as SQL over b, g, r, n, s1, s2.
INDEX_SQL = {
    "ratio": "n / nullif(r, 0)",
    "rvi": "r / nullif(n, 0)",
    "ndvi": "(n - r) / nullif(n + r, 0)",
    "ndwi": "(n - s2) / nullif(n + s2, 0)",
    "awei": "4 * (g - s2) - (0.25e0 * n + 2.75e0 * s1)",
    "iia": "(g - 4 * n) / nullif(g + 4 * n, 0)",
    "evi": "2.4e0 * (n - r) / nullif(1 + n + r, 0)",
    "lai": "3.618e0 * (2.4e0 * (n - r) / nullif(1 + n + r, 0) - 0.118e0)",
    "gcvi": "n / nullif(g, 0) - 1",
    "gemi": "(2 * (n * n - r * r) + 1.5e0 * n + 0.5e0 * r) / nullif(n + g + 0.5e0, 0)",
    "cvi": "n * g / nullif(b * b, 0)",
    "gli": "(2 * g - r - b) / nullif(2 * g - r - b, 0)",
    "shape": "(2 * r - g - b) / nullif(g - b, 0)",
    "afvi": "(n - 0.5e0 * s2) / nullif(n + 0.5e0 * s2, 0)",
    "avi": "n * (1 - r) * (n - r) / 3",
    "bsi": "((s1 - r) - (n + b)) / nullif((s1 + r) + (n + b), 0)",
    "brba": "r / nullif(s1, 0)",
    "dswi5": "(n + g) / nullif(s1 + r, 0)",
    "lswi": "(n - s1) / nullif(n + s1, 0)",
    "mbi": "(s1 - s2 - n) / nullif(s1 + s2 + n, 0) + 0.5e0",
    "ui": "(s2 - n) / nullif(s2 + n, 0)",
    "osavi": "(n - r) / nullif(0.16e0 + n + r, 0)",
    "ri": "(n - g) / nullif(n + g, 0)",
    "brightness": "0.3037e0 * b + 0.2793e0 * g + 0.4743e0 * r + 0.5585e0 * n + 0.5082e0 * s1 + 0.1863e0 * s2",
    "wetness": "0.1509e0 * b + 0.1973e0 * g + 0.3279e0 * r + 0.3406e0 * n + 0.7112e0 * s1 + 0.4572e0 * s2",
    "msi": "n / nullif(s1, 0)",
    "gvmi": "((n + 0.1e0) - (s1 + 0.02e0)) / nullif((n + 0.1e0) + (s1 + 0.02e0), 0)",
    "spri": "((g - b) / nullif(g + b, 0) + 1) / 2",
    "co2flux": "(n - s2) / nullif(n + s2, 0) * (((g - b) / nullif(g + b, 0) + 1) / 2)",
}
_BANDS = ", bands AS (SELECT pixel_id, year, l_orderkey, l_linenumber, blue_median AS b, green_median AS g, red_median AS r, nir_median AS n, swir1_median AS s1, swir2_median AS s2 FROM scene)"
_KEYS = ["pixel_id", "year", "l_orderkey", "l_linenumber"]


@query("x1_indices", _BANDS + " SELECT pixel_id, year, l_orderkey, l_linenumber, " + ", ".join(f"{micro_sql(e)} AS {n}" for n, e in INDEX_SQL.items()) + " FROM bands")
def all_indices(v: Views):
    """Every index of every scene, in millionths."""
    made = v.scenes.select(*_KEYS, *(indices.index(n).alias(n) for n in indices.INDICES))
    return made.select(*_KEYS, *(micro(F.col(n)).alias(n) for n in indices.INDICES))


@query(
    "x2_index_pack_uint16",
    _BANDS + " SELECT pixel_id, year, l_orderkey, l_linenumber, " + ", ".join(f"least(greatest(trunc((({INDEX_SQL[n]}) + {o}) * 10000)::BIGINT, 0), 65535)::INT AS {n}" for n, o in (("ndwi", 1), ("brba", 0), ("lswi", 1))) + " FROM bands",
)
def index_pack(v: Views):
    return v.scenes.select(*_KEYS, *(indices.index(n, scale="uint16").alias(n) for n in ("ndwi", "brba", "lswi")))


_SEASONS = {"": "true", "_wet": "month <= 6", "_dry": "month > 6"}
_SEASON_SQL = (
    ", m AS (SELECT pixel_id, year, "
    + ", ".join(f"median({b}_median) FILTER ({test}) AS {s}{k}" for k, test in _SEASONS.items() for b, s in zip(indices.BANDS, ("b", "g", "r", "n", "s1", "s2")))
    + " FROM scene GROUP BY ALL), "
    + ", ".join(f"p{k} AS (SELECT pixel_id, year, " + ", ".join(f"least(greatest(trunc((({INDEX_SQL[n]}) + {indices.INDICES[n][1]}) * 10000), 0), 65535)::INT AS {n}_median{k}" for n in indices.PACK) + f" FROM (SELECT pixel_id, year, b{k} AS b, g{k} AS g, r{k} AS r, n{k} AS n, s1{k} AS s1, s2{k} AS s2 FROM m))" for k in _SEASONS)
    + " SELECT * FROM p JOIN p_wet USING (pixel_id, year) JOIN p_dry USING (pixel_id, year)"
)


@query("x4_index_pack_seasons", _SEASON_SQL)
def index_pack_seasons(v: Views):
    """The whole index pack of the annual, wet and dry mosaic of each pixel-year, as unsigned 16-bit numbers."""
    parts = {"": F.lit(True), "_wet": F.col("month") <= 6, "_dry": F.col("month") > 6}
    mosaic = areas.medians_by_part(v.scenes, ["pixel_id", "year"], [f"{b}_median" for b in indices.BANDS], parts)
    made = [f"{n}_median{k}" for k in parts for n in indices.PACK]
    return indices.add_pack(mosaic, ("annual", "wet", "dry"), "uint16").select("pixel_id", "year", *made)


@query("w15_index_profile", _BANDS + f", m AS (SELECT pixel_id, year, median(r) AS r, median(n) AS n FROM bands GROUP BY ALL) SELECT pixel_id, string_agg(year || '=' || coalesce({micro_sql('(n - r) / nullif(n + r, 0)')}::VARCHAR, ''), ',' ORDER BY year) AS profile FROM m GROUP BY 1")
def index_profile(v: Views):
    """The series of a vegetation index at each pixel."""
    found = tables.index_profile(v.scenes, "ndvi")
    line = F.transform("profile", lambda x: F.concat_ws("=", x["year"], F.coalesce(micro(x["value"]).cast("string"), F.lit(""))))
    return found.select("pixel_id", F.array_join(line, ",").alias("profile"))


@query("x3_fraction_index", f", f AS (SELECT *, red_median AS gv, green_median AS npv, blue_median AS soil FROM scene) SELECT pixel_id, year, l_orderkey, l_linenumber, {micro_sql('(gv - soil) / nullif(gv + 2 * npv + soil, 0) + 1')} AS ndfia FROM f")
def fraction_index(v: Views):
    fractions = v.scenes.withColumns({"gv": F.col("red_median"), "npv": F.col("green_median"), "soil": F.col("blue_median")})
    return indices.fraction_index(fractions).select(*_KEYS, micro(F.col("ndfia")).alias("ndfia"))


@query("p1_select_rename", "SELECT pixel_id AS id, red_median AS red, nir_median AS nir FROM scene")
def select_rename(v: Views):
    return tables.select_rename(v.scenes, {"pixel_id": "id", "red_median": "red", "nir_median": "nir"})


@query("p8_clip", "SELECT pixel_id, year, class FROM a WHERE pixel_id IN (SELECT pixel_id FROM region WHERE region_kind = 'protected')")
def clip(v: Views):
    return tables.clip(v.a, v.regions.where("region_kind = 'protected'")).select("pixel_id", "year", "class")


@query("p9_filters", "SELECT pixel_id, year, class FROM a WHERE basin NOT IN ('Brand#11', 'Brand#12') AND class IS NOT NULL AND year >= 1997 AND p_size < 30")
def filters(v: Views):
    return v.a.where(~F.col("basin").isin("Brand#11", "Brand#12") & F.col("class").isNotNull() & (F.col("year") >= 1997) & (F.col("p_size") < 30)).select("pixel_id", "year", "class")


@query("p10_rescale", "SELECT p_partkey AS pixel_id, p_retailprice / 10000 AS red_median, p_size AS slope, p_size / 1500 AS slopeA FROM part")
def rescale(v: Views):
    bands = v.table("part").select(F.col("p_partkey").alias("pixel_id"), F.col("p_retailprice").alias("red_median"), F.col("p_size").alias("slope"))
    return indices.rescale_reflectance(bands, ["red_median"])


@query("p12_p13_constants_casts", "SELECT pixel_id, year, 2016 AS band_year, least(greatest(trunc(red_median * 1000)::BIGINT, 0), 255) AS byte, trunc(-nir_median * 10)::INT AS whole, l_orderkey, l_linenumber FROM scene")
def casts(v: Views):
    return v.scenes.select("pixel_id", "year", F.lit(2016).alias("band_year"), masks.to_unsigned(F.col("red_median") * 1000, 8).alias("byte"), (-F.col("nir_median") * 10).cast("int").alias("whole"), "l_orderkey", "l_linenumber")


_LABELS = list(legend.LABEL_CODES)
_FIELDS = list(legend.FIELD_CODES)
_lists = lambda names: "[" + ", ".join(f"'{x}'" for x in names) + "]"


@query(
    "p14_p15_labels",
    f""", t AS (SELECT pixel_id, year, {_lists(_LABELS)}[(pixel_id % {len(_LABELS)} + 1)::INT] AS label, {_lists(_FIELDS)}[(pixel_id % {len(_FIELDS)} + 1)::INT] AS field FROM a)
    SELECT pixel_id, year, label, l.k AS code, f.k AS field_code FROM t LEFT JOIN (VALUES {", ".join(f"('{n}', {c})" for n, c in legend.LABEL_CODES.items())}) l(n, k) ON l.n = label
    LEFT JOIN (VALUES {", ".join(f"('{n}', {c})" for n, c in legend.FIELD_CODES.items())}) f(n, k) ON f.n = field""",
)
def labels(v: Views):
    pick = lambda names: F.element_at(F.array(*map(F.lit, names)), (F.col("pixel_id") % len(names) + 1).cast("int"))
    rows = v.a.select("pixel_id", "year", pick(_LABELS).alias("label"), pick(_FIELDS).alias("field"))
    return rows.select("pixel_id", "year", "label", masks.remap_strict(F.col("label"), legend.LABEL_CODES).alias("code"), masks.remap_strict(F.col("field"), legend.FIELD_CODES).alias("field_code"))


@query("p18_binarize", "SELECT pixel_id, year, (class = 3)::INT AS is_3, (class = 4)::INT AS is_4, (class = 21)::INT AS is_21 FROM a")
def binarize(v: Views):
    return v.a.select("pixel_id", "year", *(masks.binarize(F.col("class"), k).alias(f"is_{k}") for k in (3, 4, 21)))


@query("p19_class_in_basin", "SELECT pixel_id, year, class FROM a WHERE NOT coalesce(basin = 'Brand#13' AND class = 12, false)")
def class_in_basin(v: Views):
    return tables.allowed_classes(v.a, [("Brand#13", 12)]).select("pixel_id", "year", "class")


@query("p21_quality_mask", "SELECT pixel_id, year, l_orderkey, l_linenumber, nir_median / 10000 AS nir FROM scene WHERE quality = 0")
def quality_mask(v: Views):
    return masks.clear(v.scenes).select(*_KEYS, (F.col("nir_median") / 10000).alias("nir"))


@query(
    "p11_j1_logistic",
    f""", s AS (SELECT basin, s.* FROM scene s JOIN a USING (pixel_id, year)), st AS (SELECT basin, year, avg(nir_median) AS m, stddev_samp(nir_median) AS sd FROM s GROUP BY ALL)
    SELECT pixel_id, year, l_orderkey, l_linenumber, {micro_sql('1 / (1 + exp(-((nir_median - m) / nullif(sd, 0))))')} AS nir FROM s JOIN st USING (basin, year)""",
)
def logistic(v: Views):
    scenes = v.scenes.join(v.a.select("pixel_id", "year", "basin").hint("merge"), ["pixel_id", "year"])
    stats = scenes.groupBy("basin", "year").agg(F.avg("nir_median").alias("nir_median_mean"), F.stddev_samp("nir_median").alias("nir_median_stdDev"))
    return tables.normalise(scenes, stats, ["nir_median"]).select(*_KEYS, micro(F.col("nir_median")).alias("nir"))


# joins and sets


_BOXES = """, seen AS (SELECT l_orderkey, (pixel_id % 50)::DOUBLE AS x0, (pixel_id // 50)::DOUBLE AS y0, pixel_id % 50 + l_linenumber / 2.0e0 AS x1, pixel_id // 50 + red_median * 4 AS y1 FROM scene),
 land AS (SELECT p_partkey AS region, p_partkey % 50 - p_size / 40.0e0 AS x0, p_partkey // 50 - p_size / 25.0e0 AS y0, p_partkey % 50 + p_size / 40.0e0 AS x1, p_partkey // 50 + p_size / 25.0e0 AS y1 FROM part)"""


@query("j2_bounds_overlap", _BOXES + " SELECT region, count(*) AS scenes, sum(l_orderkey)::BIGINT AS orders FROM seen s JOIN land r ON s.x0 <= r.x1 AND r.x0 <= s.x1 AND s.y0 <= r.y1 AND r.y0 <= s.y1 GROUP BY 1")
def bounds_overlap(v: Views):
    """Scenes whose footprint meets a region's bounds."""
    x, y = (F.col("pixel_id") % 50).cast("double"), F.expr("pixel_id div 50").cast("double")
    seen = v.scenes.select("l_orderkey", x.alias("x0"), y.alias("y0"), (x + F.col("l_linenumber") / 2).alias("x1"), (y + F.col("red_median") * 4).alias("y1"))
    wide, high = F.col("p_size") / 40, F.col("p_size") / 25
    land = v.pixels.select(F.col("pixel_id").alias("region"), (x - wide).alias("x0"), (y - high).alias("y0"), (x + wide).alias("x1"), (y + high).alias("y1"))
    met = tables.overlaps(seen, land, finest=1.0)
    return met.groupBy("region").agg(F.count("*").alias("scenes"), F.sum("l_orderkey").alias("orders"))


@query("j3_map_pairs", "SELECT pixel_id, year, a, b FROM pairs WHERE a = b")
def map_pairs(v: Views):
    return compare.pair_maps(v.a, v.b).where("a = b").select("pixel_id", "year", "a", "b")


@query("j4_sample_at_points", "SELECT p.pixel_id, p.year, p.reference, coalesce(c.class, 0) AS class FROM points p LEFT JOIN c USING (pixel_id, year)")
def sample_at_points(v: Views):
    return tables.sample_at_points(v.points, v.map("c")).select("pixel_id", "year", "reference", "class")


@query("j5_j6_neighbours", "SELECT n.n_name AS basin, m.n_name AS neighbour, r.r_name FROM nation n JOIN nation m ON n.n_regionkey = m.n_regionkey AND n.n_nationkey <> m.n_nationkey JOIN main.region r ON r.r_regionkey = n.n_regionkey")
def neighbours(v: Views):
    """Nations as basins: those of the same region are neighbours; the region is looked up."""
    nations = v.table("nation")
    other = nations.select(F.col("n_name").alias("neighbour"), "n_regionkey", F.col("n_nationkey").alias("other"))
    joined = nations.join(other, "n_regionkey").where("n_nationkey <> other")
    return joined.join(v.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("basin"), "neighbour", "r_name")


@query("j9_m13_missing_work", ", keys AS (SELECT DISTINCT basin, territory, year FROM a), done AS (SELECT DISTINCT basin, territory, year FROM a WHERE class = 33) SELECT * FROM keys EXCEPT SELECT * FROM done")
def missing_work(v: Views):
    keys = v.a.select("basin", "territory", "year").distinct()
    return tables.missing(keys, v.a.where("class = 33").select("basin", "territory", "year").distinct())


@query("j10_intersect", "SELECT pixel_id FROM region WHERE region_kind = 'protected' INTERSECT SELECT pixel_id FROM region WHERE region_id = 'Brand#12'")
def intersect(v: Views):
    return tables.intersect_regions(v.regions.where("region_kind = 'protected'"), v.regions.where("region_id = 'Brand#12'"))


@query("j12_tuned_year", f"SELECT DISTINCT basin, CASE WHEN year + 19 > 2018 THEN 2021 ELSE 2016 END AS tuned, year FROM a")
def tuned_year(v: Views):
    return v.a.select("basin", tables.tuned_year(F.col("year") + 19).alias("tuned"), "year").distinct()


# every third basin has no entry and takes the defaults; the numbers follow from the map
_TUNED = "SELECT basin, tuned, round(0.1 + n % 6 * 0.02, 2) AS rate, (35 + n % 8 * 5)::INT AS trees FROM (SELECT basin, CASE WHEN year + 19 > 2018 THEN 2021 ELSE 2016 END AS tuned, count(DISTINCT class) AS n FROM a WHERE p_size % 3 <> 0 GROUP BY ALL)"


@query("l14_tuned_parameters", f", registry AS ({_TUNED}), keys AS (SELECT DISTINCT basin, year, CASE WHEN year + 19 > 2018 THEN 2021 ELSE 2016 END AS tuned FROM a) SELECT basin, year, coalesce(rate, 0.1)::DOUBLE AS rate, coalesce(trees, 25) AS trees FROM keys LEFT JOIN registry USING (basin, tuned)")
def tuned_parameters(v: Views):
    tuned = tables.tuned_year(F.col("year") + 19)
    counted = v.a.where("p_size % 3 <> 0").groupBy("basin", tuned.alias("tuned")).agg(F.countDistinct("class").alias("n"))
    registry = counted.select("basin", "tuned", F.round(0.1 + F.col("n") % 6 * 0.02, 2).alias("rate"), (35 + F.col("n") % 8 * 5).cast("int").alias("trees"))
    return tables.tuned_parameters(v.a.select("basin", "year").distinct(), registry, shift=19)


_SHARES = f", areas AS (SELECT basin, year, class, {HA} AS area FROM a WHERE class IS NOT NULL AND class <> 12 GROUP BY ALL), shares AS (SELECT basin, year, class, area / sum(area) OVER (PARTITION BY basin, year) AS share FROM areas)"


def _shares(v: Views):
    return areas.shares(areas.area_by(v.a.where("class <> 12"), "basin", "year", "class"), "basin", "year")


@query("j13_share_lookup", _SHARES + f" SELECT k.basin, k.year, k.class, {micro_sql('coalesce(share, 0.01)')} AS share FROM (SELECT DISTINCT basin, year, class FROM a WHERE class IS NOT NULL) k LEFT JOIN shares USING (basin, year, class)")
def share_lookup(v: Views):
    keys = v.a.where("class is not null").select("basin", "year", "class").distinct()
    found = keys.join(_shares(v).drop("area"), ["basin", "year", "class"], "left")
    return found.select("basin", "year", "class", micro(F.coalesce("share", F.lit(0.01))).alias("share"))


@query("m5_share_rules", _SHARES + f" SELECT basin, year, class, {micro_sql('CASE WHEN class = 21 THEN share + 0.1 WHEN class = 3 AND share < 0.05 THEN 0.15 ELSE share END')} AS share FROM shares")
def share_rules(v: Views):
    return sampling.share_rules(_shares(v)).select("basin", "year", "class", micro(F.col("share")).alias("share"))


@query("m11_m12_union_distinct", "SELECT DISTINCT pixel_id, class FROM (SELECT pixel_id, class FROM a UNION ALL SELECT pixel_id, class FROM b)")
def union_distinct(v: Views):
    return v.a.select("pixel_id", "class").unionByName(v.b.select("pixel_id", "class"), allowMissingColumns=True).distinct()


@query("m9_m10_sort_limit", f"SELECT basin, year, class, area FROM (SELECT basin, year, class, {HA} AS area FROM a WHERE class IS NOT NULL GROUP BY ALL) ORDER BY area DESC, basin, year, class LIMIT 50")
def sort_limit(v: Views):
    return areas.area_by(v.a, "basin", "year", "class").orderBy(F.desc("area"), "basin", "year", "class").limit(50)


# sampling

_U = "('0x' || substr(md5(pixel_id || ':' || year || ':{s}'), 1, 13))::BIGINT / 4503599627370496.0e0"
_DRAWN = ", u AS (SELECT pixel_id, year, basin, class, " + _U.format(s=0) + " AS u FROM a WHERE class IS NOT NULL)"


def _observed(v: Views):
    return v.a.where("class is not null").select("pixel_id", "year", "basin", "class")


@query("m1_stable_mask", "SELECT pixel_id, year, (a = b AND coalesce((c.class = 33)::INT, 0) = 0 AND coalesce((c.class = 22)::INT, 0) = 0 AND coalesce(abs(a - b), 9) < 3) AS stable FROM pairs JOIN c USING (pixel_id, year)")
def stable_mask(v: Views):
    both = v.maps.withColumnsRenamed({"class_a": "a", "class_b": "b", "class_c": "c"})
    flag = lambda k: (F.col("c") == k).cast("int")
    test = sampling.stable_area(F.col("a") == F.col("b"), flag(33), flag(22), F.coalesce(F.abs(F.col("a") - F.col("b")), F.lit(9)))
    return both.select("pixel_id", "year", test.alias("stable"))


@query("m2_stratified", _DRAWN + " SELECT pixel_id, year, basin, class FROM u QUALIFY row_number() OVER (PARTITION BY basin, class ORDER BY u, pixel_id, year) <= 5")
def stratified(v: Views):
    return sampling.stratified(_observed(v), 5, "basin", "class")


@query("m3_uniform_sample", _DRAWN + " SELECT pixel_id, year, basin, class FROM u ORDER BY u, pixel_id, year LIMIT 100")
def uniform_sample(v: Views):
    return sampling.uniform_sample(_observed(v), 100)


@query("m4_quota", _DRAWN + ", n AS (SELECT class, count(*) AS n FROM u GROUP BY 1) SELECT pixel_id, year, basin, u.class FROM u JOIN n USING (class) WHERE u <= 100 * 0.5e0 / n")
def quota(v: Views):
    limits = v.a.select("class").distinct().where("class is not null").withColumns({"limit": F.lit(100), "share": F.lit(0.5)})
    return sampling.quota(_observed(v), limits, "class").select("pixel_id", "year", "basin", "class")


@query("m6_balance", _DRAWN + ", n AS (SELECT class, count(*) AS n FROM u GROUP BY 1) SELECT pixel_id, year, basin, u.class FROM u JOIN n USING (class) WHERE u <= CASE WHEN class = 4 AND n > 300 THEN 300.0e0 / n WHEN class = 12 AND n > 60 THEN 50.0e0 / n ELSE 1 END")
def balance(v: Views):
    return sampling.balance(_observed(v), {4: (300, 300), 12: (60, 50)}).select("pixel_id", "year", "basin", "class")


@query("m7_keep_by_class", _DRAWN + " SELECT pixel_id, year, basin, class FROM u WHERE CASE WHEN class = 4 THEN u >= 0.5 WHEN class = 21 THEN true ELSE u <= 0.9 END")
def keep_by_class(v: Views):
    return sampling.keep_by_class(_observed(v))


@query("m8_split", _DRAWN + " SELECT pixel_id, year, CASE WHEN u < 0.8 THEN 'train' ELSE 'test' END AS part FROM u")
def split(v: Views):
    return sampling.split(_observed(v)).select("pixel_id", "year", "part")


@query("m14_sample_size", ", s AS (SELECT class, n / sum(n) OVER () AS share FROM (SELECT class, count(*) AS n FROM a WHERE class IS NOT NULL GROUP BY class)) SELECT class, ceil(7.568e0 * share * (1 - share) / (0.05e0 * 0.05e0))::BIGINT AS n FROM s")
def sample_size(v: Views):
    counts = areas.histogram(_observed(v))  # a row for each class
    shares = counts.select("class", (F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).alias("share"))
    return sampling.tortora_size(shares, 7.568, 0.05).select("class", "n")
