"""Accuracy of maps at reference points, all from one grouped count.

Points have reference and classification; keys name what is reported separately.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stored


def pair_counts(points: DataFrame, *keys: str) -> DataFrame:
    """keys, ref, pred, n: the one scan that all measures share."""
    return points.groupBy(*keys, F.col("reference").alias("ref"), F.col("classification").alias("pred")).agg(F.count("*").alias("n"))


def confusion_matrix(points: DataFrame, labels: Sequence[int], *keys: str) -> DataFrame:
    """Rows are reference labels, columns c_<label> predictions; total, and a row NULL of totals."""
    kept = points.where(F.col("reference").isin(*labels) & F.col("classification").isin(*labels))
    counts = [F.count_if(F.col("classification") == k).alias(f"c_{k}") for k in labels]
    rows = kept.groupBy(*keys, F.col("reference").alias("ref")).agg(*counts, F.count("*").alias("total"))
    sums = rows.groupBy(*keys).agg(F.lit(None).cast("int").alias("ref"), *(F.sum(c).alias(c) for c in [*(f"c_{k}" for k in labels), "total"]))
    return rows.unionByName(sums)


def _per_class(counts: DataFrame, *keys: str) -> DataFrame:
    """tp, in_ref, in_pred by label, over labels seen in either."""
    sides = F.array(
        F.struct(F.col("ref").alias("label"), F.col("n").alias("r"), F.lit(0).cast("long").alias("p"), F.when(F.col("ref") == F.col("pred"), F.col("n")).otherwise(0).alias("d")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("r"), F.col("n").alias("p"), F.lit(0).cast("long").alias("d")),
    )
    rows = counts.select(*keys, F.inline(sides))
    return rows.groupBy(*keys, "label").agg(F.sum("d").alias("tp"), F.sum("r").alias("in_ref"), F.sum("p").alias("in_pred"))


def _over(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def metrics(points: DataFrame, *keys: str) -> DataFrame:
    """accuracy, balanced accuracy, and macro precision, recall, f1 and jaccard; x / 0 is 0.

    Macro means are over labels in reference or prediction, balanced accuracy over those
    in the reference.
    """
    per = _per_class(pair_counts(points, *keys), *keys)
    tp, ref, pred = F.col("tp"), F.col("in_ref"), F.col("in_pred")
    per = per.withColumns({"p": _over(tp, pred), "r": _over(tp, ref), "f": _over(2 * tp, ref + pred), "j": _over(tp, ref + pred - tp)})
    return per.groupBy(*keys).agg(
        (F.sum("tp") / F.sum("in_ref")).alias("accuracy"),
        F.avg(F.when(ref > 0, F.col("r"))).alias("balanced"),
        F.avg("p").alias("precision"),
        F.avg("r").alias("recall"),
        F.avg("f").alias("f1"),
        F.avg("j").alias("jaccard"),
    )


def disagreement(points: DataFrame, labels: Sequence[int], *keys: str) -> DataFrame:
    """quantity, allocation, exchange and shift of each label, in percent of the total.

    The counts are met with their transpose; r, c, d are row total, column total, diagonal.
    """
    kept = points.where(F.col("reference").isin(*labels) & F.col("classification").isin(*labels))
    counts = pair_counts(kept, *keys)
    both = F.array(
        F.struct(F.col("ref").alias("k"), F.col("pred").alias("j"), F.col("n").alias("out"), F.lit(0).cast("long").alias("into")),
        F.struct(F.col("pred").alias("k"), F.col("ref").alias("j"), F.lit(0).cast("long").alias("out"), F.col("n").alias("into")),
    )
    cells = counts.select(*keys, F.inline(both)).groupBy(*keys, "k", "j").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
    other = F.col("k") != F.col("j")
    per = cells.groupBy(*keys, "k").agg(
        F.sum("out").alias("r"),
        F.sum("into").alias("c"),
        F.sum(F.when(~other, F.col("out")).otherwise(0)).alias("d"),
        F.sum(F.when(other, F.least("out", "into")).otherwise(0)).alias("least"),
        F.sum(F.when(other, F.abs(F.col("out") - F.col("into"))).otherwise(0)).alias("apart"),
    )
    total = per.groupBy(*keys).agg(F.sum("r").alias("t"))
    per = per.join(total, list(keys)) if keys else per.withColumn("t", F.lit(total.first()["t"]))
    off = F.abs(F.col("r") - F.col("c"))
    percent = lambda x: F.round((100 * x / F.col("t")).cast("decimal(18,8)"), 2)
    return per.select(
        *keys,
        F.col("k").alias("label"),
        percent(off).alias("quantity"),
        percent(2 * F.least(F.col("r") - F.col("d"), F.col("c") - F.col("d"))).alias("allocation"),
        percent(2 * F.col("least")).alias("exchange"),
        percent(F.col("apart") - off).alias("shift"),
    )


def overall_disagreement(points: DataFrame, labels: Sequence[int], *keys: str) -> DataFrame:
    """Per key: global_accuracy, and half the sums of quantity, exchange and shift; allocation is the rest."""
    per = disagreement(points, labels, *keys).groupBy(*keys).agg(*((F.sum(c) / 2).cast("double").alias(c) for c in ("quantity", "exchange", "shift")))
    right = F.count_if(F.col("reference") == F.col("classification")) / F.count("*")
    acc = points.groupBy(*keys).agg(F.round((100 * right).cast("decimal(18,8)"), 2).cast("double").alias("global_accuracy"))
    joined = acc.join(per, list(keys))
    return joined.withColumn("allocation", F.round(100 - F.col("global_accuracy") - F.col("quantity"), 4))


def class_accuracy(points: DataFrame, labels: Sequence[int], *keys: str) -> DataFrame:
    """Per label, right points in percent of its row (reference) and column (map), and the errors."""
    kept = points.where(F.col("reference").isin(*labels) & F.col("classification").isin(*labels))
    per = _per_class(pair_counts(kept, *keys), *keys)
    row, column = 100 * F.try_divide("tp", "in_ref"), 100 * F.try_divide("tp", "in_pred")
    return per.select(*keys, "label", row.alias("row_accuracy"), column.alias("column_accuracy"), (100 - row).alias("row_error"), (100 - column).alias("column_error"))


def triangle_errors(points: DataFrame, labels: Sequence[int], *keys: str) -> DataFrame:
    """commission: share above the diagonal; omission: share below it."""
    kept = points.where(F.col("reference").isin(*labels) & F.col("classification").isin(*labels))
    above, below = F.col("reference") < F.col("classification"), F.col("reference") > F.col("classification")
    return kept.groupBy(*keys).agg((F.count_if(above) / F.count("*")).alias("commission"), (F.count_if(below) / F.count("*")).alias("omission"))


def _ranked(scored: DataFrame, *keys: str) -> DataFrame:
    """score, pos and neg at each distinct score, over and under (of pos and neg) above it and in all.

    Scores are dealt out in ranges; sums run inside a range and the earlier ranges' are
    added, so a key with any number of scores is split over tasks.
    """
    at = scored.groupBy(*keys, "score").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    at = stored(at.repartitionByRange(*keys, F.desc("score")).withColumn("_range", F.spark_partition_id()), "scores")
    sums = at.groupBy(*keys, "_range").agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    sums = sums.select(*keys, "_range", *(x for c in ("pos", "neg") for x in (before(f"_{c}").alias(f"{c}_before"), F.sum(f"_{c}").over(whole).alias(f"{c}_all"))))
    inside = Window.partitionBy(*keys, "_range").orderBy(F.desc("score"))
    upto = {f"{c}_upto": F.sum(c).over(inside) for c in ("pos", "neg")}
    joined = at.withColumns(upto).join(sums, [*keys, "_range"])
    return joined.withColumns({f"{c}_upto": F.col(f"{c}_upto") + F.col(f"{c}_before") for c in ("pos", "neg")})


def roc(scored: DataFrame, *keys: str) -> DataFrame:
    """Exact ROC points of (label 0/1, score): fpr and tpr at each distinct score, by falling score."""
    share = lambda c: F.try_divide(f"{c}_upto", f"{c}_all")
    return _ranked(scored, *keys).select(*keys, "score", share("neg").alias("fpr"), share("pos").alias("tpr"))


def auc(scored: DataFrame, *keys: str) -> DataFrame:
    """Area under the ROC of (label 0/1, score) by trapezoids, from (0, 0)."""
    part = F.col("neg") * (2 * F.col("pos_upto") - F.col("pos")) / 2
    area = F.try_divide(F.sum(part), F.max("neg_all") * F.max("pos_all"))
    return _ranked(scored, *keys).groupBy(*keys).agg(area.alias("auc"))
