"""Classification with MLlib: forests, one-vs-rest boosting and SVM, importance, selection, tuning.

Tables have features (array<double> or array<float>) and label (int). Models are trained
and applied by Spark; loops on the driver go over models, never over rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LinearSVC, OneVsRest, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .areas import majority_key

#: Models fitted side by side.
PARALLEL = 8


def vectors(df: DataFrame, features: str = "features", picked: Sequence[int] | None = None) -> DataFrame:
    """Adds vec from an array column, or from some of its places."""
    array = F.col(features) if picked is None else F.array(*(F.col(features)[i] for i in picked))
    return df.withColumn("vec", array_to_vector(array.cast("array<double>")))


def forest(trees: int = 165, per_split: int = 15, leaf: int = 40, bag: float = 0.8, seed: int = 0) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="vec", labelCol="label", numTrees=trees, featureSubsetStrategy=str(per_split), minInstancesPerNode=leaf, subsamplingRate=bag, seed=seed)


def tree(leaf: int = 40, seed: int = 0) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(featuresCol="vec", labelCol="label", minInstancesPerNode=leaf, seed=seed)


def max_probability(predicted: DataFrame) -> DataFrame:
    """Adds prob, the greatest class probability in percent."""
    return predicted.withColumn("prob", F.floor(100 * F.array_max(vector_to_array("probability"))).cast("int"))


def boost_one_vs_rest(train: DataFrame, classes: Iterable[int], trees: int = 25, rate: float = 0.1, bag: float = 0.8, seed: int = 0) -> dict[int, Model]:
    """A binary boosted model for each class: MLlib's boosting has two classes only."""
    made = GBTClassifier(featuresCol="vec", labelCol="is", maxIter=trees, stepSize=rate, subsamplingRate=bag, seed=seed)
    classes = list(classes)
    fit = lambda k: made.fit(train.withColumn("is", (F.col("label") == k).cast("double")))
    return dict(zip(classes, _at_once(fit, classes)))


def predict_one_vs_rest(models: dict[int, Model], df: DataFrame) -> DataFrame:
    """prediction and prob from the models' probabilities, scaled to sum 1."""
    kept = df.columns
    for k, model in models.items():
        made = model.transform(df).withColumn(f"_p{k}", vector_to_array("probability")[1])
        df = made.drop("rawPrediction", "probability", "prediction")
    pairs = F.array(*(F.struct(F.col(f"_p{k}").alias("p"), F.lit(-k).alias("k")) for k in models))
    total = sum((F.col(f"_p{k}") for k in models), F.lit(0.0))
    best = F.array_max(pairs)
    prob = F.floor(100 * F.coalesce(F.try_divide(best["p"], total), F.lit(0.0))).cast("int")
    return df.select(*kept, (-best["k"]).cast("int").alias("prediction"), prob.alias("prob"))


def fourier(df: DataFrame, size: int, gamma: float = 0.001, n: int = 64, seed: int = 0) -> DataFrame:
    """vec of random Fourier features, whose linear kernel approximates an RBF kernel.

    numpy makes them in tasks: as an expression they are size * n literals, which every
    later step would analyse again. Products are added in the order of the features.
    """
    rng = np.random.default_rng(seed)
    w, b = rng.normal(0, np.sqrt(2 * gamma), (n, size)), rng.uniform(0, 2 * np.pi, n)

    def made(features: pd.Series) -> pd.Series:
        x = np.array(features.tolist(), dtype=np.float64).reshape(-1, size)
        total = np.zeros((len(x), n))
        for i in range(size):
            total += x[:, i : i + 1] * w[:, i]
        return pd.Series(list(np.sqrt(2.0 / n) * np.cos(total + b)))

    return df.withColumn("vec", array_to_vector(F.pandas_udf(made, "array<double>")("features")))


def svm() -> OneVsRest:
    return OneVsRest(classifier=LinearSVC(maxIter=10, regParam=0.01), featuresCol="vec", labelCol="label")


def predict_margins(models: Sequence[Model], df: DataFrame) -> DataFrame:
    """prediction by the models' margins, the least of ties, as OneVsRest does, without its Python function for each model."""
    kept = df.columns
    for k, model in enumerate(models):
        df = model.transform(df).withColumn(f"_m{k}", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "prediction")
    best = F.array_max(F.array(*(F.struct(F.col(f"_m{k}").alias("m"), F.lit(-k).alias("k")) for k in range(len(models)))))
    return df.select(*kept, (-best["k"]).cast("int").alias("prediction"))


def accuracy(predicted: DataFrame) -> float:
    return MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy").evaluate(predicted.withColumn("prediction", F.col("prediction").cast("double")))


def top_features(model: Model, size: int, n: int) -> list[int]:
    """The n most important features, ties by place."""
    return sorted(sorted(range(size), key=lambda i: (-model.featureImportances[i], i))[:n])


def importances(df: DataFrame, model: Model, size: int) -> DataFrame:
    """feature and importance, least first."""
    rows = [(i, float(model.featureImportances[i])) for i in range(size)]
    return df.sparkSession.createDataFrame(rows, "feature int, importance double").orderBy("importance", "feature")


def cross_validate(df: DataFrame, estimator, folds: int) -> float:
    """Mean accuracy over the values of fold."""
    one = lambda k: accuracy(estimator.fit(df.where(F.col("fold") != k)).transform(df.where(F.col("fold") == k)))
    return sum(_at_once(one, range(folds))) / folds


def eliminate(df: DataFrame, size: int, least: int, step: int, folds: int, make) -> DataFrame:
    """Recursive elimination: feature, ranking (1 for those kept), the best cross-validated set."""
    left, dropped, best = list(range(size)), [], (-1.0, [])
    while True:
        data = vectors(df, picked=left).cache()
        score = cross_validate(data, make(), folds)
        if score >= best[0]:
            best = (score, list(left))
        if len(left) <= least:
            data.unpersist()
            break
        weights = make().fit(data).featureImportances
        data.unpersist()
        order = sorted(range(len(left)), key=lambda i: (weights[i], -left[i]))[: min(step, len(left) - least)]
        dropped.append([left[i] for i in order])
        left = [f for i, f in enumerate(left) if i not in order]
    ranks = {f: 1 for f in best[1]}
    rank = 1
    for gone in reversed(dropped):
        new = [f for f in gone if f not in ranks]
        rank += bool(new)
        ranks |= {f: rank for f in new}
    return df.sparkSession.createDataFrame(sorted((f, ranks.get(f, 1)) for f in range(size)), "feature int, ranking int")


def compare_models(df: DataFrame, estimators: dict[str, Estimator], folds: int = 5) -> DataFrame:
    """model, fold, accuracy: every estimator fitted without and judged on each value of fold."""

    def one(job: tuple[str, int]) -> tuple[str, int, float]:
        name, k = job
        made = estimators[name].fit(df.where(F.col("fold") != k)).transform(df.where(F.col("fold") == k))
        return name, k, accuracy(made)

    rows = _at_once(one, [(name, k) for name in estimators for k in range(folds)])
    return df.sparkSession.createDataFrame(rows, "model string, fold int, accuracy double")


def _at_once(work, jobs: Sequence) -> list:
    """work of each job, some side by side: each is a series of Spark jobs too small to fill a cluster."""
    with ThreadPool(min(PARALLEL, len(jobs))) as pool:
        return pool.map(work, jobs, chunksize=1)


def dominant_cluster(df: DataFrame, clusters: int, seed: int = 0) -> DataFrame:
    """Samples in the cluster that most of their class fall in."""
    found = KMeans(featuresCol="vec", k=clusters, seed=seed, predictionCol="cluster").fit(df).transform(df)
    main = majority_key(found, "label", "cluster").select("label", "cluster")
    return found.join(main, ["label", "cluster"], "left_semi")


def cv_pivot(scores: DataFrame, trees: Iterable[int], top: int = 6) -> DataFrame:
    """Scores by rate (rows) and trees (columns), best rates first."""
    wide = scores.groupBy("rate").pivot("trees", list(trees)).agg(F.avg("score"))
    best: Column = F.greatest(*(F.col(str(t)) for t in trees), F.lit(0.0))
    return wide.withColumn("best", best).orderBy(F.desc("best"), "rate").limit(top)


def cv_results(scores: DataFrame, *parameters: str) -> DataFrame:
    """Parameters with mean_score, std_score (of the population) and rank (1: greatest mean; equal means share a rank) from one score a fold."""
    found = scores.groupBy(*parameters).agg(F.round(F.avg("score"), 12).alias("mean_score"), F.stddev_pop("score").alias("std_score"))
    better = found.groupBy("mean_score").agg(F.count("*").alias("n"))
    # a grid's distinct means, not samples: one small partition
    rank = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("mean_score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1
    return found.join(better.select("mean_score", rank.cast("int").alias("rank")), "mean_score").select(*parameters, "mean_score", "std_score", "rank")
