"""Plans and results that must hold when tables are large."""

import random

import pytest
from pyspark.sql import functions as F

from covertrail.operators import areas, tables, temporal
from covertrail.plans import catalog, models, points
from covertrail.plans.views import Views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    """a1_area_by_class a2_area_by_territory a3_area_by_regions a5_basin_rollup a6_region_group a7_class_share a12_incomplete_groups a14_confusion_matrix a15_metrics
    a17_triangles a19_axis_range a23_majority_key a24_select_series c2_agreement_older c6_point_disagreement m3_uniform_sample m8_split
    m14_sample_size p8_clip p9_filters w12_w13_stability""".split(),
)
def test_pixel_years_are_not_broadcast(spark, name):
    """Spark takes the pixel-years for as small as the pixels, and would build a table of them on the driver and in each task."""
    assert "Broadcast" not in plan(catalog.QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_densify_of_observed_years(spark):
    pixels = spark.createDataFrame([(p, f"b{p % 3}") for p in range(40)], "pixel_id long, basin string")
    cells = spark.createDataFrame([(p, 1990 + p % 5, p) for p in range(50)], "pixel_id long, year int, class int")
    dense = temporal.densify(cells, pixels, 1990, 1993)
    assert "Broadcast" not in plan(dense.where("class is not null"))
    found = {(r.pixel_id, r.year): r["class"] for r in dense.collect()}
    assert found == {(p, y): p if y == 1990 + p % 5 else None for p in range(40) for y in range(1990, 1994)}


def test_medians_by_part(spark):
    """The same bits as median(), for keys with none, one, an even and an odd number of values, with nulls; one list for all medians."""
    rng = random.Random(3)
    rows = [(k, rng.choice((1, 2, 3, None)), rng.choice((None, rng.uniform(-1, 1), 0.1, 0.7)), rng.uniform(0, 1e-3)) for k in range(30) for _ in range(k % 9 + 1)]
    df = spark.createDataFrame(rows, "k int, m int, u double, v double")
    parts = {"": F.lit(True), "_low": F.col("m") <= 1, "_high": F.col("m") > 1}
    found = areas.medians_by_part(df, ["k"], ["u", "v"], parts)
    medians = [F.median(F.when(test, F.col(c))).alias(c + part) for part, test in parts.items() for c in "uv"]
    assert sorted(found.collect()) == sorted(df.groupBy("k").agg(*medians).select(found.columns).collect())
    assert "percentile" not in plan(catalog.QUERIES["x4_index_pack_seasons"](spark, "/root/testdata/sf0.001")) + plan(found)


def test_overlaps_are_merged(spark):
    """Neither side is broadcast, and a small box stands in one cell of each level that the other side has."""
    rows = [(i, i % 7 * 1.0, i // 7 * 1.0, i % 7 + i % 3 * 0.5, i // 7 + 0.25 * (i % 5)) for i in range(140)]
    frame = lambda name: spark.createDataFrame(rows, f"{name} int, x0 double, y0 double, x1 double, y1 double")
    met = tables.overlaps(frame("a"), frame("b"), finest=1.0)
    assert "BroadcastHashJoin" not in plan(met)
    want = [(p[0], q[0]) for p in rows for q in rows if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]]
    assert sorted((r.a, r.b) for r in met.collect()) == sorted(want)


def broadcast(text):
    """The parts of a plan that are broadcast, without what lies below an aggregate: its groups are what is sent."""
    lines = text.splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    for i in (i for i, x in enumerate(lines) if "BroadcastExchange" in x):
        part = lines[i + 1 : next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))]
        yield part[: next((j for j, x in enumerate(part) if "Aggregate" in x), len(part))]


@pytest.mark.parametrize("name", "a16_disagreement a16_overall a17_class_accuracy a18_stacked_matrices a20_delta_wide j4_sample_at_points j9_m13_missing_work j11_l13_band_registry m2_stratified".split())
def test_only_groups_are_broadcast(spark, name):
    found = plan(catalog.QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "Generate explode" in found and not any("Generate" in x or "Scan" in x for part in broadcast(found) for x in part)


def test_scored_points_are_not_broadcast(spark):
    """l11_roc and a22_auc_mean_std store their scores while a plan is built, so the step before is held."""
    assert "Broadcast" not in plan(points._scored(Views(spark, "/root/testdata/sf0.001")))


def test_scenes_meet_merged_maps(spark):
    """p11_j1_logistic broadcasts its statistics alone; samples of models are merged too."""
    found = plan(catalog.QUERIES["p11_j1_logistic"](spark, "/root/testdata/sf0.001"))
    assert not any("Generate" in x or "Scan" in x for part in broadcast(found) for x in part)
    assert "Broadcast" not in plan(models.basin_samples(Views(spark, "/root/testdata/sf0.001")))
