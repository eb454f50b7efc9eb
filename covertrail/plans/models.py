"""Queries that train and apply models on the embeddings table, whose labels are classes."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import indices
from ..operators import accuracy, areas, forests, ml, selection, temporal
from ..scratch import stored
from . import features
from .maps import query as _query
from .views import LAST, Views, micro, micro_sql

Q: dict = {}
SQL: dict[str, str] = {}
SIZE, CLASSES = 64, range(10)
_BINS, _LISTED = 16, 10


def query(name: str, sql: str | None = None):
    return _query(name, sql, into=(Q, SQL))


def samples(v: Views):
    """id, features, label, fold, vec; three fifths of the folds train."""
    rows = v.table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"), "label")
    return ml.vectors(temporal.folds(rows, 5, "label", key="id"))


def _split(v: Views):
    rows = samples(v)
    return rows.where("fold < 3"), rows.where("fold >= 3")


def _small(trees: int = 10):
    return ml.forest(trees=trees, leaf=2)


@query("l1_l4_forest")
def forest(v: Views):
    train, test = _split(v)
    return ml.max_probability(ml.forest(trees=40, leaf=2).fit(train).transform(test)).select("id", "label", F.col("prediction").cast("int").alias("prediction"), "prob")


@query("l2_l4_boosting")
def boosting(v: Views):
    train, test = _split(v)
    models = ml.boost_one_vs_rest(train, CLASSES, trees=5)
    return ml.predict_one_vs_rest(models, test).select("id", "label", "prediction", "prob")


@query("l3_svm")
def svm(v: Views):
    rows = stored(ml.fourier(samples(v), SIZE, gamma=0.05).select("id", "label", "fold", "vec"), "fourier")
    fitted = ml.svm().fit(rows.where("fold < 3"))
    return ml.predict_margins(fitted.models, rows.where("fold >= 3")).select("id", "label", "prediction")


@query("l5_models_by_fold")
def by_fold(v: Views):
    """One model with a feature list of its own for each group of samples (folds stand for basin-years), applied to the next group."""
    rows, out = samples(v), None
    for k in range(5):
        train, test = rows.where(F.col("fold") == k), rows.where(F.col("fold") == (k + 1) % 5)
        picked = ml.top_features(_small().fit(train), SIZE, 32)
        made = _small().fit(ml.vectors(train, picked=picked)).transform(ml.vectors(test, picked=picked))
        made = made.select("id", F.lit(k).alias("model"), F.lit(",".join(map(str, picked))).alias("features"), F.col("prediction").cast("int").alias("prediction"))
        out = made if out is None else out.unionByName(made)
    return out


@query("l6_l7_elimination")
def elimination(v: Views):
    return ml.eliminate(samples(v).withColumn("fold", F.col("fold") % 3), SIZE, least=16, step=8, folds=3, make=lambda: ml.forest(trees=10, per_split=4, leaf=2))


@query("l7_model_comparison")
def comparison(v: Views):
    """Tree against forest, five folds each."""
    return ml.compare_models(samples(v), {"tree": ml.tree(leaf=2), "forest": _small()}, folds=5)


@query("l8_importance")
def importance(v: Views):
    train, _ = _split(v)
    return ml.importances(train, _small().fit(train), SIZE)


@query("l9_permutation_importance")
def permutation(v: Views):
    """Accuracy that each feature's permutation takes from a forest, on samples that it has not seen; ten repeats."""
    rows = samples(v).select(F.lit("all").alias("group"), "id", "label", "fold", "features")
    rows = stored(forests.binned(rows, forests.equal_width(rows, _BINS)), "binned")
    model = forests.grow_forest(forests.packed(rows.where("fold < 3"), block=1024), len(CLASSES), trees=165, per_split=15, leaf=5, depth=8)
    return selection.permutation_drops(rows.where("fold >= 3"), model, len(CLASSES), trees=165, depth=8, repeats=10, block=512).drop("group")


@query("l10_a21_grid_search")
def grid(v: Views):
    """Five rates by 35 to 70 trees, cross-validated in two folds: ten boosted models of all classes, grown side by side."""
    rates, trees = (0.1, 0.125, 0.15, 0.175, 0.2), range(35, 71, 5)
    rows = samples(v).select(F.lit("all").alias("group"), "id", "label", (F.col("fold") % 2).alias("fold"), "features")
    blocks = forests.packed(forests.binned(rows, forests.equal_width(rows, 16)))
    settings = v.spark.createDataFrame([("all", 2 * i + k, rate, trees[-1], k) for i, rate in enumerate(rates) for k in range(2)], "group string, setting int, rate double, trees int, held int")
    judged = forests.boosted_classes(forests.with_settings(blocks, settings), len(CLASSES), trees[-1], depth=2, stages=trees, held_out=True)
    by_fold = judged.groupBy("setting", "stage").agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("score"))
    scores = by_fold.join(settings, "setting").select("rate", F.col("stage").alias("trees"), "score")
    return ml.cv_pivot(scores, trees)


@query("l10_leaf_grid")
def leaf_grid(v: Views):
    """Five rates by four numbers of leaves, cross-validated in two folds of four fifths of the samples: mean, deviation, rank; the best one fitted to all of these and tested on the last fifth."""
    rates, leaves, trees, depth = (0.01, 0.1, 1.0, 5.0, 10.0), (3, 10, 30, 50), 10, 6
    rows = samples(v).select(F.lit("all").alias("group"), "id", "label", "fold", "features")
    rows = stored(forests.binned(rows, forests.equal_width(rows, _BINS)), "binned")
    kinds = "group string, setting int, rate double, leaves int, trees int, held int"
    grid = [("all", 2 * i + k, rate, most, trees, k) for i, (rate, most) in enumerate(itertools.product(rates, leaves)) for k in range(2)]
    settings = v.spark.createDataFrame(grid, kinds)

    def judged(rows: DataFrame, settings: DataFrame) -> DataFrame:
        made = forests.boosted_classes(forests.with_settings(forests.packed(rows), settings), len(CLASSES), trees, depth=depth, leaf=1, bag=1.0, held_out=True)
        right = made.groupBy("setting").agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("score"))
        return right.join(settings, "setting").select("rate", "leaves", "score")

    scores = judged(rows.where("fold < 4").withColumn("fold", F.col("fold") % 2), settings)
    results = stored(ml.cv_results(scores, "rate", "leaves"), "results")
    best = results.orderBy("rank", "rate", "leaves").limit(1).select(F.lit("all").alias("group"), F.lit(0).alias("setting"), "rate", "leaves", F.lit(trees).alias("trees"), F.lit(4).alias("held"))
    tested = judged(rows, stored(best, "best"))
    return results.join(tested.withColumnRenamed("score", "test_score"), ["rate", "leaves"], "left")


@query("l11_class_roc")
def class_roc(v: Views):
    """Area under each class's ROC over five folds, from the scores of forests that did not see the fold: mean, deviation, number of folds."""
    rows = samples(v).select(F.lit("all").alias("group"), "id", "label", "fold", "features")
    blocks = stored(forests.without_folds(forests.packed(forests.binned(rows, forests.equal_width(rows, _BINS)), block=1024), 5).where("held >= 0"), "held-out")
    model = stored(forests.grow_forest(blocks, len(CLASSES), trees=100, per_split=8, leaf=2, depth=8), "forest")
    scores = forests.class_shares(blocks, model, len(CLASSES), trees=100, depth=8).where(F.col("group") == F.concat(F.lit("all|"), "fold"))
    one = scores.select("fold", F.col("label").alias("is"), F.posexplode("shares").alias("class", "score"))
    areas_ = accuracy.auc(one.select("class", "fold", (F.col("is") == F.col("class")).cast("int").alias("label"), F.round("score", 9).alias("score")), "class", "fold")
    return areas_.groupBy("class").agg(F.avg("auc").alias("mean_auc"), F.stddev_pop("auc").alias("std_auc"), F.count("auc").alias("folds"))


@query("l12_dominant_cluster")
def cluster(v: Views):
    return ml.dominant_cluster(samples(v), 10).select("id", "label", "cluster")


# models for each basin and year

_LEGEND = (3, 4, 12, 21, 22, 33)
_MIXED = ("ndvi", "ndwi", "gcvi", "osavi", "lswi", "bsi", "gemi", "brightness")
_BANDS = [f"{b}_median" for b in ("blue", "green", "red", "nir", "swir1", "swir2")]


def _group(year: Column) -> Column:
    return F.concat_ws(":", "basin", year)


def _features() -> Column:
    return F.array(*_BANDS, *(indices.index(n) for n in _MIXED))


def basin_samples(v: Views) -> DataFrame:
    """Scenes with the class that map a has for their pixel and year: group (basin:year), id, label (place in the legend), features."""
    known = v.a.where("class is not null").select("pixel_id", "year", "basin", "class").hint("merge")
    label = F.array_position(F.array(*map(F.lit, _LEGEND)), F.col("class")) - 1
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return v.scenes.join(known, ["pixel_id", "year"]).select(_group(F.col("year")).alias("group"), key.alias("id"), label.cast("int").alias("label"), _features().alias("features"))


def _binned_samples(v: Views) -> tuple[DataFrame, DataFrame]:
    """basin_samples() binned and written, and the edges."""
    rows = basin_samples(v)
    edges = stored(forests.equal_width(rows, _BINS), "edges")
    return stored(forests.binned(rows, edges), "binned"), edges


def listed_features(rows: DataFrame, n: int = _LISTED) -> DataFrame:
    """group, picked: the n features of binned rows whose bins differ most between classes, by the share of squares that class means explain."""
    each = rows.select("group", "label", F.posexplode("bins").alias("feature", "bin"))
    by_class = each.groupBy("group", "feature", "label").agg(F.count("*").alias("n"), F.sum("bin").cast("long").alias("s"), F.sum(F.col("bin").cast("long") * F.col("bin")).alias("q"))
    mean = lambda k: F.coalesce(F.sum(F.when(F.col("label") == k, F.col("s").cast("double") * F.col("s") / F.col("n"))), F.lit(0.0)).alias(f"m{k}")
    totals = by_class.groupBy("group", "feature").agg(*(mean(k) for k in range(len(_LEGEND))), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    base = F.col("s").cast("double") * F.col("s") / F.col("n")
    between = sum((F.col(f"m{k}") for k in range(1, len(_LEGEND))), F.col("m0")) - base
    share = F.coalesce(between / F.nullif(F.col("q") - base, F.lit(0.0)), F.lit(0.0))
    ranked = F.sort_array(F.collect_list(F.struct((-share).alias("rank"), "feature")))
    return totals.groupBy("group").agg(F.transform(F.slice(ranked, 1, n), lambda x: x["feature"]).alias("picked"))


def _level_sql(level: int) -> str:
    """The splits of a level, from rows at(g, r, node, class, feature, bin)."""
    classes = [f"s{k}" for k in range(len(_LEGEND))]
    over = lambda c, side, w: f"sum({c}) OVER {w} AS {side}_{c}"
    squares = lambda side: " + ".join(f"{side(c)}::DOUBLE * {side(c)}::DOUBLE" for c in classes)
    score = lambda side: f"({squares(side)}) / nullif({side('n')}, 0)"
    left, every, right = (lambda c: f"l_{c}"), (lambda c: f"a_{c}"), (lambda c: f"(a_{c} - l_{c})")
    return f"""
, c{level} AS (SELECT g, node, feature, bin, count(*)::BIGINT AS n, {", ".join(f"count(*) FILTER (class = {code})::BIGINT AS s{k}" for k, code in enumerate(_LEGEND))} FROM at{level} GROUP BY ALL),
w{level} AS (SELECT g, node, feature, bin, {", ".join(over(c, "l", "w") for c in ["n", *classes])}, {", ".join(over(c, "a", "v") for c in ["n", *classes])} FROM c{level}
  WINDOW w AS (PARTITION BY g, node, feature ORDER BY bin), v AS (PARTITION BY g, node, feature)),
g{level} AS (SELECT g, node, feature, bin, l_n, a_n, {score(left)} + {score(right)} - {score(every)} AS gain FROM w{level}),
n{level} AS (SELECT g, node, max(a_n)::BIGINT AS n FROM g{level} GROUP BY ALL),
b{level} AS (SELECT g, node, feature, bin, l_n::BIGINT AS left_n, gain FROM g{level} WHERE l_n >= 5 AND a_n - l_n >= 5 AND gain > 1e-9
  QUALIFY row_number() OVER (PARTITION BY g, node ORDER BY gain DESC, feature, bin) = 1),
t{level} AS (SELECT g, node, feature, bin, n, left_n, gain FROM n{level} LEFT JOIN b{level} USING (g, node))"""


_TREE_SQL = (
    features._BANDS
    + f""", s AS (
  SELECT row_number() OVER () AS r, a.basin || ':' || a.year AS g, a.class, [b, g, r, n, s1, s2, {", ".join(features.INDEX_SQL[n] for n in _MIXED)}] AS f
  FROM bands JOIN a USING (pixel_id, year) WHERE class IS NOT NULL
), u AS (SELECT r, g, class, unnest(f) AS value, unnest(range(len(f)))::INT AS feature FROM s),
lim AS (SELECT g, feature, min(value) AS low, max(value) AS high FROM u GROUP BY ALL),
binned AS (SELECT r, g, class, feature, ({" + ".join(f"coalesce((low + {k} * ((high - low) / {_BINS}) < value)::INT, 0)" for k in range(1, _BINS))}) AS bin FROM u JOIN lim USING (g, feature)),
byclass AS (SELECT g, feature, class, count(*) AS n, sum(bin) AS s, sum(bin * bin) AS q FROM binned GROUP BY ALL),
totals AS (SELECT g, feature, {", ".join(f"coalesce(sum(s::DOUBLE * s / n) FILTER (class = {code}), 0) AS m{k}" for k, code in enumerate(_LEGEND))}, sum(n) AS n, sum(s) AS s, sum(q) AS q FROM byclass GROUP BY ALL),
picked AS (SELECT g, feature FROM totals QUALIFY row_number() OVER (PARTITION BY g ORDER BY coalesce((m0 + m1 + m2 + m3 + m4 + m5 - s::DOUBLE * s / n) / nullif(q - s::DOUBLE * s / n, 0), 0) DESC, feature) <= {_LISTED}),
at0 AS (SELECT r, g, 1 AS node, class, feature, bin FROM binned SEMI JOIN picked USING (g, feature))"""
    + _level_sql(0)
    + """, side AS (SELECT at0.r, 2 + (at0.bin > t0.bin)::INT AS node FROM at0 JOIN t0 ON at0.g = t0.g AND at0.feature = t0.feature),
at1 AS (SELECT r, g, side.node, class, feature, bin FROM at0 JOIN side USING (r))"""
    + _level_sql(1)
    + f""" SELECT g AS "group", node::INT AS node, feature, bin AS cut, n, left_n, {micro_sql("gain")} AS gain FROM (FROM t0 UNION ALL FROM t1)"""
)


@query("l5_tree_splits", _TREE_SQL)
def tree_splits(v: Views):
    """The two upper levels of one tree of all samples for each basin and year, over the features listed for it."""
    rows, _ = _binned_samples(v)
    blocks, found = forests.packed(rows, listed_features(rows), block=1024), None
    for level in range(2):
        cells = forests.class_histograms(blocks, found, level, len(_LEGEND), 1, _LISTED, 1.0, 0)
        nodes = stored(forests.choose_splits(cells, len(_LEGEND), leaf=5), "splits")
        found = nodes if found is None else found.unionByName(nodes)
    return found.select("group", "node", "feature", "cut", "n", "left_n", micro(F.col("gain")).alias("gain"))


def _mosaic(v: Views) -> DataFrame:
    """One row for each pixel-year with scenes: the medians of its bands. The last year is classified by the samples of the year before."""
    medians = areas.composite(v.scenes, ["pixel_id", "year"], _BANDS)
    return medians.join(v.pixels.select("pixel_id", "basin").hint("merge"), "pixel_id").select(
        _group(F.least(F.col("year"), F.lit(LAST - 1))).alias("group"), (F.col("pixel_id") * 10_000 + F.col("year")).alias("id"), F.lit(-1).alias("label"), _features().alias("features")
    )


def _prepared(v: Views) -> tuple[DataFrame, DataFrame]:
    """Blocks of samples and of pixel-years to classify, binned alike, each basin and year with its own features."""
    train, edges = _binned_samples(v)
    return forests.packed(train, listed_features(train)), forests.packed(forests.binned(_mosaic(v), edges))


def _classified(found: DataFrame) -> DataFrame:
    cls = F.element_at(F.array(*map(F.lit, _LEGEND)), F.col("prediction") + 1)
    return found.select(F.expr("id div 10000").alias("pixel_id"), (F.col("id") % 10_000).cast("int").alias("year"), cls.alias("class"), "prob")


@query("l5_basin_years")
def basin_years(v: Views):
    """Every pixel-year classified by the forest of its basin and year: 165 trees, at most 15 features a split, 40 samples a leaf, bags of 0.8."""
    train, mosaic = _prepared(v)
    model = forests.grow_forest(train, len(_LEGEND), trees=165, per_split=15, leaf=40, bag=0.8, depth=6)
    return _classified(forests.classify(mosaic, model, len(_LEGEND), trees=165, depth=6))


@query("l6_basin_elimination")
def basin_elimination(v: Views):
    """Features of each basin and year by recursive elimination, one a round, three folds; those selected by the ranking rule."""
    rows = temporal.folds(basin_samples(v), 3, "group", "label", key="id")
    blocks = forests.packed(forests.binned(rows, forests.equal_width(rows, _BINS)))
    ranked = stored(selection.eliminate(blocks, len(_BANDS) + len(_MIXED), len(_LEGEND), trees=20, per_split=4, leaf=5, bag=0.8, depth=6), "ranking")
    picked = selection.selected(ranked)
    return ranked.join(picked, "group").select("group", "feature", "ranking", "best", F.array_contains("picked", F.col("feature")).alias("selected"))


@query("l14_tuned_boosting")
def tuned_boosting(v: Views):
    """Samples classified by the boosted model of their basin and year, with the rate and number of trees that the registry holds for it."""
    train, _ = _binned_samples(v)
    tuned = features.tuned_parameters(v).select(_group(F.col("year")).alias("group"), F.lit(0).alias("setting"), "rate", "trees", F.lit(None).cast("int").alias("held"))
    blocks = forests.with_settings(forests.packed(train, listed_features(train)), tuned)
    return forests.boosted_classes(blocks, len(_LEGEND), rounds=70, depth=2, leaf=20, bag=0.8).select("group", "id", "label", "prediction", "prob")
