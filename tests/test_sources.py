"""Runs that are broken off and resumed; windows of maps in tiles."""

import random

import pytest
from pyspark.sql import functions as F

from covertrail.sources import files, ledger


def test_a_broken_run_is_resumed(spark, tmp_path):
    path = str(tmp_path / "out")
    keys = [("b1", y) for y in range(6)] + [("b2", 0), (None, 3)]
    work = spark.createDataFrame(keys, "basin string, year int")
    made = []

    def make(some, fail=False):
        made.append(sorted((r.basin or "", r.year) for r in some.collect()))
        broken = F.raise_error(F.lit("stopped")) if fail else F.lit(1)
        return some.withColumn("value", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("ok", F.when(F.col("value") == 2, broken).otherwise(1).cast("int"))

    calls = iter([False, True])
    with pytest.raises(Exception, match="stopped"):
        ledger.run(work, lambda some: make(some, next(calls)), path, batches=3)
    first = {(r.basin, r.year) for r in ledger.done(work, path).collect()}
    assert 0 < len(first) < len(keys)

    # rows of a key that is not in the ledger: written, but the run ended before it was recorded
    open_ = next(k for k in keys if k not in first and k[0])
    spark.createDataFrame([(*open_, 1, 1), (*open_, 99, 1)], "basin string, year int, value int, ok int").write.mode("append").partitionBy("basin", "year").parquet(f"{path}/data")
    seen = {(r.basin, r.year) for r in ledger.finished(work, make(work.limit(0)), path).collect()}
    assert seen == first
    made.clear()
    rows = ledger.run(work, make, path, batches=3).collect()
    assert sorted((r.basin or "", r.year, r.value) for r in rows) == sorted((b or "", y, v) for b, y in keys for v in (1, 2))
    again = [k for some in made for k in some]
    assert sorted(again) == sorted((b or "", y) for b, y in keys if (b, y) not in first)
    made.clear()
    assert ledger.run(work, make, path, batches=3).count() == 2 * len(keys) and not any(made)


def test_windows_of_tiles(spark, tmp_path):
    path, rng = str(tmp_path / "map"), random.Random(2)
    cells = {(rng.randint(-100, 100), rng.randint(-100, 100)): i for i in range(3000)}
    df = spark.createDataFrame([(x, y, i) for (x, y), i in cells.items()], "x int, y int, class int")
    files.write_tiled(df, path, side=32)
    for x0, y0, x1, y1 in ((-100, -100, 100, 100), (-33, -1, 40, 70), (5, 5, 5, 5), (90, -100, 100, -95)):
        found = files.read_window(spark, path, x0, y0, x1, y1, side=32)
        assert found.columns == ["x", "y", "class"]
        assert {(r.x, r.y): r["class"] for r in found.collect()} == {(x, y): i for (x, y), i in cells.items() if x0 <= x <= x1 and y0 <= y <= y1}
    small = files.read_window(spark, path, 90, -100, 100, -95, side=32)
    plan = small._jdf.queryExecution().executedPlan()
    small.collect()
    scan = next(p for p in _leaves(plan) if p.nodeName().startswith("Scan"))
    assert scan.metrics().apply("numFiles").value() < len(spark.read.parquet(path).inputFiles()) / 4


def _leaves(plan):
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return [leaves.apply(i) for i in range(leaves.size())]


def test_the_curve_rises(spark):
    at = spark.createDataFrame([(x, y) for x in range(-9, 9) for y in range(-9, 9)], "x int, y int").select("x", "y", files.morton(F.col("x"), F.col("y")).alias("z")).collect()
    z = {(r.x, r.y): r.z for r in at}
    assert len(set(z.values())) == len(z)
    assert all(z[x, y] < z[x + 1, y] and z[x, y] < z[x, y + 1] for x in range(-9, 8) for y in range(-9, 8))
