"""Queries on reference points: accuracy, disagreement, confusion matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import legend
from ..operators import accuracy, tables
from .maps import query as _query
from .views import YEARS, Views, micro, micro_sql

Q: dict = {}
SQL: dict[str, str] = {}
LABELS = list(legend.CONFUSION)


def query(name: str, sql: str | None = None):
    return _query(name, sql, into=(Q, SQL))


_COUNTS = ", cnt AS (SELECT basin, year, reference AS ref, classification AS pred, count(*) AS n FROM points GROUP BY ALL)"
_PER = """, per AS (SELECT basin, year, label, sum(d) AS tp, sum(r) AS in_ref, sum(p) AS in_pred FROM (
  SELECT basin, year, ref AS label, n AS r, 0 AS p, CASE WHEN ref = pred THEN n ELSE 0 END AS d FROM cnt
  UNION ALL SELECT basin, year, pred, 0, n, 0 FROM cnt) GROUP BY ALL)"""


@query(
    "a14_confusion_matrix",
    ", m AS (SELECT basin, reference AS ref, " + ", ".join(f"count(*) FILTER (classification = {k}) AS c_{k}" for k in LABELS) + ", count(*) AS total FROM points GROUP BY ALL) "
    "SELECT * FROM m UNION ALL SELECT basin, NULL, " + ", ".join(f"sum(c_{k})::BIGINT" for k in LABELS) + ", sum(total)::BIGINT FROM m GROUP BY basin",
)
def confusion_matrix(v: Views):
    return accuracy.confusion_matrix(v.points, LABELS, "basin")


@query(
    "a15_metrics",
    _COUNTS + _PER + f""" SELECT basin, year, {micro_sql('sum(tp) / sum(in_ref)')} AS accuracy, {micro_sql('avg(CASE WHEN in_ref > 0 THEN tp / in_ref END)')} AS balanced,
    {micro_sql('avg(coalesce(tp / nullif(in_pred, 0), 0))')} AS precision, {micro_sql('avg(coalesce(tp / nullif(in_ref, 0), 0))')} AS recall,
    {micro_sql('avg(coalesce(2 * tp / nullif(in_ref + in_pred, 0), 0))')} AS f1, {micro_sql('avg(coalesce(tp / nullif(in_ref + in_pred - tp, 0), 0))')} AS jaccard FROM per GROUP BY ALL""",
)
def metrics(v: Views):
    found = accuracy.metrics(v.points, "basin", "year")
    return found.select("basin", "year", *(micro(F.col(c)).alias(c) for c in ("accuracy", "balanced", "precision", "recall", "f1", "jaccard")))


_TWO = "round((100 * {} / t)::DECIMAL(18,8), 2)::DOUBLE"
_DISAGREE = """, cells AS (SELECT basin, k, j, sum(o) AS o, sum(i) AS i FROM (
  SELECT basin, reference AS k, classification AS j, count(*) AS o, 0 AS i FROM points GROUP BY ALL
  UNION ALL SELECT basin, classification, reference, 0, count(*) FROM points GROUP BY ALL) GROUP BY ALL),
 per AS (SELECT basin, k, sum(o) AS r, sum(i) AS c, sum(CASE WHEN k = j THEN o ELSE 0 END) AS d, sum(CASE WHEN k <> j THEN least(o, i) ELSE 0 END) AS le,
   sum(CASE WHEN k <> j THEN abs(o - i) ELSE 0 END) AS ap FROM cells GROUP BY ALL),
 per2 AS (SELECT *, sum(r) OVER (PARTITION BY basin) AS t FROM per),
 dis AS (SELECT basin, k AS label, """ + ", ".join(
    f"{_TWO.format(e)} AS {n}" for n, e in (("quantity", "abs(r - c)"), ("allocation", "2 * least(r - d, c - d)"), ("exchange", "2 * le"), ("shift", "(ap - abs(r - c))"))
) + " FROM per2)"


@query("a16_disagreement", _DISAGREE + " SELECT * FROM dis")
def disagreement(v: Views):
    found = accuracy.disagreement(v.points, LABELS, "basin")
    return found.select("basin", "label", *(F.col(c).cast("double").alias(c) for c in ("quantity", "allocation", "exchange", "shift")))


@query("a16_overall", _DISAGREE + f""", half AS (SELECT basin, sum(quantity) / 2 AS quantity, sum(exchange) / 2 AS exchange, sum(shift) / 2 AS shift FROM dis GROUP BY 1),
 acc AS (SELECT basin, round((100 * count(*) FILTER (reference = classification) / count(*))::DECIMAL(18,8), 2)::DOUBLE AS global_accuracy FROM points GROUP BY 1)
 SELECT basin, {micro_sql('global_accuracy')} AS global_accuracy, {micro_sql('quantity')} AS quantity, {micro_sql('exchange')} AS exchange, {micro_sql('shift')} AS shift,
 {micro_sql('100 - global_accuracy - quantity')} AS allocation FROM half JOIN acc USING (basin)""")
def overall(v: Views):
    found = accuracy.overall_disagreement(v.points, LABELS, "basin")
    return found.select("basin", *(micro(F.col(c)).alias(c) for c in ("global_accuracy", "quantity", "exchange", "shift", "allocation")))


@query("a17_class_accuracy", _COUNTS + _PER + f""" SELECT basin, year, label, {micro_sql('100 * tp / nullif(in_ref, 0)')} AS row_accuracy, {micro_sql('100 * tp / nullif(in_pred, 0)')} AS column_accuracy FROM per""")
def class_accuracy(v: Views):
    found = accuracy.class_accuracy(v.points, LABELS, "basin", "year")
    return found.select("basin", "year", "label", micro(F.col("row_accuracy")).alias("row_accuracy"), micro(F.col("column_accuracy")).alias("column_accuracy"))


@query("a17_triangles", "SELECT basin, count(*) FILTER (reference < classification) / count(*) AS commission, count(*) FILTER (reference > classification) / count(*) AS omission FROM points GROUP BY 1")
def triangles(v: Views):
    return accuracy.triangle_errors(v.points, LABELS, "basin")


@query("a18_stacked_matrices", _COUNTS + " SELECT c.* FROM cnt c JOIN (SELECT basin FROM cnt GROUP BY 1 HAVING count(DISTINCT year) >= 7) USING (basin)")
def stacked(v: Views):
    """The counts of all basins and years, of basins whose years are complete."""
    counts = accuracy.pair_counts(v.points, "basin", "year")
    whole = counts.groupBy("basin").agg(F.countDistinct("year").alias("years")).where("years >= 7").select("basin")
    return counts.join(whole, "basin", "left_semi")


_ACC = ", acc AS (SELECT basin, year, count(*) FILTER (reference = classification) / count(*) AS acc_a, count(*) FILTER (reference + 1 > classification) / count(*) AS acc_b FROM points GROUP BY ALL)"


def _deltas(v: Views):
    share = lambda test: (F.count_if(test) / F.count("*")).alias("accuracy")
    by = v.points.groupBy("basin", "year")
    return tables.accuracy_delta(by.agg(share(F.col("reference") == F.col("classification"))), by.agg(share(F.col("reference") + 1 > F.col("classification"))))


@query("j7_accuracy_delta", _ACC + " SELECT basin, year, acc_a, acc_b, abs(acc_a - acc_b) AS delta FROM acc")
def accuracy_delta(v: Views):
    return _deltas(v)


@query("a20_delta_wide", _ACC + " SELECT basin, " + ", ".join(f"max({c}) FILTER (year = {y}) AS {n}_{y}" for y in YEARS for n, c in (("acc_a", "acc_a"), ("acc_b", "acc_b"), ("delta", "abs(acc_a - acc_b)"))) + " FROM acc GROUP BY 1")
def delta_wide(v: Views):
    return tables.wide_by_year(_deltas(v), YEARS)


@query("p17_drop_unobserved", "SELECT pixel_id, year, reference, classification FROM points WHERE pixel_id NOT IN (SELECT pixel_id FROM points WHERE reference = 33 OR classification = 33)")
def drop_unobserved(v: Views):
    return tables.drop_unobserved(v.points, 33).select("pixel_id", "year", "reference", "classification")


_SCORED = ", s AS (SELECT year, (reference = 4)::INT AS label, (pixel_id * 7 + classification) % 10 AS score FROM points)"
_CURVE = ", steps AS (SELECT year, score, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY ALL), curve AS (SELECT year, score, sum(neg) OVER w / sum(neg) OVER (PARTITION BY year) AS fpr, sum(pos) OVER w / sum(pos) OVER (PARTITION BY year) AS tpr FROM steps WINDOW w AS (PARTITION BY year ORDER BY score DESC))"


def _scored(v: Views):
    score = (F.col("pixel_id") * 7 + F.col("classification")) % 10
    return v.points.select("year", (F.col("reference") == 4).cast("int").alias("label"), score.alias("score"))


@query("l11_roc", _SCORED + _CURVE + " SELECT * FROM curve")
def roc(v: Views):
    return accuracy.roc(_scored(v), "year")


@query("a22_auc_mean_std", _SCORED + _CURVE + f""", auc AS (SELECT year, sum(part) AS auc FROM (SELECT year, (fpr - coalesce(lag(fpr) OVER w, 0)) * (tpr + coalesce(lag(tpr) OVER w, 0)) / 2 AS part FROM curve WINDOW w AS (PARTITION BY year ORDER BY score DESC)) GROUP BY 1)
 SELECT {micro_sql('avg(auc)')} AS mean_auc, {micro_sql('stddev_pop(auc)')} AS std_auc FROM auc""")
def auc_mean_std(v: Views):
    found = accuracy.auc(_scored(v), "year")
    return found.agg(micro(F.avg("auc")).alias("mean_auc"), micro(F.stddev_pop("auc")).alias("std_auc"))
