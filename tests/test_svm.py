"""The SVM's features and predictions."""

import math

import numpy as np
from pyspark.sql import functions as F

from covertrail.operators import ml
from covertrail.plans import catalog

SIZE, N = 3, 8


def rows(spark):
    rng = np.random.default_rng(5)
    made = [(i, [float(x) for x in rng.normal(0, 1, SIZE)], i % 3) for i in range(30)]
    return spark.createDataFrame(made, "id int, features array<float>, label int")


def test_fourier_features(spark):
    """The features of the formula, made in tasks: a plan with size * n literals is analysed again by every step of ten fits."""
    rng = np.random.default_rng(0)
    w, b = rng.normal(0, math.sqrt(2 * 0.05), (N, SIZE)), rng.uniform(0, 2 * math.pi, N)
    made = ml.fourier(rows(spark), SIZE, gamma=0.05, n=N)
    assert "zip_with" not in made._jdf.queryExecution().analyzed().toString()
    for r in made.collect():
        want = [math.sqrt(2 / N) * math.cos(sum(x * y for x, y in zip(r.features, w[i])) + b[i]) for i in range(N)]
        assert np.allclose(r.vec.toArray(), want, rtol=0, atol=1e-12)


def test_margins_as_one_vs_rest(spark):
    data = ml.fourier(rows(spark), SIZE, gamma=0.05, n=N).cache()
    fitted = ml.svm().fit(data)
    models = [*fitted.models[:2], fitted.models[1]]  # the last two tie in every row
    fitted.models = models
    want = fitted.transform(data).select("id", F.col("prediction").cast("int").alias("prediction"))
    found = ml.predict_margins(models, data).select("id", "prediction")
    assert sorted(found.collect()) == sorted(want.collect())


def test_svm_predicts_all_of_two_folds(spark):
    found = catalog.QUERIES["l3_svm"](spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    labels = {r.vec_id: r.label for r in table.collect()}
    held = sum(sum(1 for i in range(n) if i % 5 >= 3) for n in (r["count"] for r in table.groupBy("label").count().collect()))
    assert len({r.id for r in found}) == len(found) == held
    assert all(labels[r.id] == r.label and r.prediction in range(10) for r in found)
