"""Operators against plain Python on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from covertrail.functions import legend, masks
from covertrail.operators import accuracy, sampling, spatial, tables, temporal


def left_to_right(series, window, cls):
    """The filter as a loop over the years, each result feeding the next."""
    out, run = list(series), window - 2
    if window == 3 and len(out) > 2 and out[0] is not None and out[0] != cls and out[1] == out[2] == cls:
        out[0] = cls
    for i in range(1, len(out) - run):
        inside = out[i : i + run]
        if out[i - 1] == cls and out[i + run] == cls and all(x is not None and x != cls for x in inside):
            out[i : i + run] = [cls] * run
    return out


@pytest.mark.parametrize("window", [3, 4, 5])
def test_temporal_fill(spark, window):
    rng = random.Random(window)
    series = {p: [rng.choice([3, 4, 4, 12, None]) for _ in range(9)] for p in range(300)}
    data = [(p, y, c) for p, s in series.items() for y, c in enumerate(s)]
    df = spark.createDataFrame(data, "pixel_id long, year int, class int")
    found = {(r.pixel_id, r.year): r["class"] for r in temporal.temporal_fill(df, window, [4]).collect()}
    for p, s in series.items():
        assert [found[p, y] for y in range(9)] == left_to_right(s, window, 4), s


def flood(grid):
    seen, sizes = set(), {}
    for cell, cls in grid.items():
        if cell in seen or cls is None:
            continue
        part, todo = [], [cell]
        seen.add(cell)
        while todo:
            x, y = todo.pop()
            part.append((x, y))
            for n in ((x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
                if n not in seen and grid.get(n) == cls:
                    seen.add(n)
                    todo.append(n)
        sizes |= {c: len(part) for c in part}
    return sizes


def test_connected_count(spark):
    rng = random.Random(5)
    grid = {(x, y): rng.choice([3, 3, 4, None]) for x in range(12) for y in range(10)}
    snake = {(20 + i, 0): 21 for i in range(15)} | {(40 + i, 0): 22 for i in range(6)} | {(60 + i, 0): 33 for i in range(5)}
    grid |= snake
    df = spark.createDataFrame([(x, y, c) for (x, y), c in grid.items()], "x int, y int, class int")
    sizes = flood(grid)
    found = {(r.x, r.y): r.conn for r in spatial.connected_count(df, 6).collect()}
    assert found == {c: min(6, sizes[c]) if c in sizes else None for c in grid}


def test_masks(spark):
    df = spark.createDataFrame([(None,), (3,), (9,), (99,)], "c int")
    c = F.col("c")
    found = df.select(masks.remap_strict(c, legend.MAP_CODES), masks.remap_keep(c, legend.TABLE_CODES), masks.where_set(c, [(c > 2, 1), (c > 5, 2)])).collect()
    assert [tuple(r) for r in found] == [(None, None, None), (3, 3, 1), (3, 12, 2), (None, 99, 2)]
    assert spark.range(1).select(masks.to_unsigned(F.lit(-3.7), 8), masks.to_unsigned(F.lit(300.9), 8), masks.to_unsigned(F.lit(2.9), 8)).first()[:] == (0, 255, 2)


def test_disagreement_adds_up(spark):
    rng = random.Random(1)
    data = [(rng.choice([3, 4, 12]), rng.choice([3, 4, 12])) for _ in range(500)]
    points = spark.createDataFrame([("b", r, c) for r, c in data], "basin string, reference int, classification int")
    per = accuracy.disagreement(points, [3, 4, 12], "basin").collect()
    right = 100 * sum(r == c for r, c in data) / len(data)
    for r in per:
        assert float(r.exchange + r["shift"]) == pytest.approx(float(r.allocation), abs=0.03)
    assert sum(float(r.quantity + r.allocation) for r in per) / 2 == pytest.approx(100 - right, abs=0.05)


def test_connected_snake(spark):
    """A component far longer than the rounds that a pointer jump takes, beside a short one."""
    snake = [(x, 0, 3) for x in range(120)] + [(x, 5, 3) for x in range(4)]
    df = spark.createDataFrame(snake, "x int, y int, class int")
    found = {(r.x, r.y): r.conn for r in spatial.connected_count(df, 200).collect()}
    assert {found[x, 0] for x in range(120)} == {120} and {found[x, 5] for x in range(4)} == {4}
    assert {r.conn for r in spatial.connected_count(df, 50).where("y = 0").collect()} == {50}


def test_roc_ranges(spark):
    """Ranges of scores give the curve and the area of a plain count."""
    rows = [(k, (i * 7 + k) % 3 == 0, (i * 37 % 50) / 50) for k in (0, 1) for i in range(300)]
    df = spark.createDataFrame([(k, int(y), s) for k, y, s in rows], "k int, label int, score double")
    for k in (0, 1):
        pos, neg = ([s for q, y, s in rows if q == k and y == want] for want in (True, False))
        for r in accuracy.roc(df, "k").where(f"k = {k}").collect():
            assert abs(r.tpr - sum(s >= r.score for s in pos) / len(pos)) < 1e-12 and abs(r.fpr - sum(s >= r.score for s in neg) / len(neg)) < 1e-12
        want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
        assert abs(accuracy.auc(df, "k").where(f"k = {k}").first().auc - want) < 1e-12


def test_overlaps(spark):
    """Every pair that shares a point, once: boxes of very unlike sizes, on cell borders, turned inside out, null."""
    rng = random.Random(9)
    boxes = []
    for i in range(160):
        x, y, side = rng.choice((rng.uniform(-40, 40), rng.randint(-8, 8))), rng.uniform(-40, 40), rng.choice((0.0, 0.1, 1.0, 4.0, 30.0, 500.0))
        boxes.append((i, float(x), y, x + side * rng.choice((1, 0.3)), y + side))
    boxes += [(900, 1.0, 1.0, 0.5, 2.0), (901, None, 0.0, 1.0, 1.0), (902, -1e5, -1e5, 1e5, 1e5)]
    a, b = boxes[:80] + boxes[-3:], boxes[60:]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} int, x0 double, y0 double, x1 double, y1 double")
    found = [(r.a, r.b) for r in tables.overlaps(frame(a, "a"), frame(b, "b"), finest=1.0, levels=10).collect()]
    right = lambda p: p[1] is not None and p[1] <= p[3] and p[2] <= p[4]
    meet = lambda p, q: p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]
    assert sorted(found) == sorted((p[0], q[0]) for p in a for q in b if right(p) and right(q) and meet(p, q))


def test_draws_are_even_and_whole(spark):
    """Far more keys than a small hash could tell apart; every stratum gives its n least numbers, or all it has."""
    far = spark.range(0, 10**10, 10**5).selectExpr("id as pixel_id", "2000 as year").select("*", sampling.uniform().alias("u"))
    made = far.selectExpr("count(distinct u) as n", "avg(u) as mean", "count_if(u < 0.1) as low").first()
    assert made.n == 100_000 and abs(made.mean - 0.5) < 0.005 and abs(made.low - 10_000) < 500
    sizes = {"a": 5000, "b": 12, "c": 3, None: 40}
    rows = [(i, 2000, s) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "pixel_id long, year int, stratum string")
    drawn = sampling.stratified(df, 10, "stratum").collect()
    numbers = {(r.stratum, r.pixel_id): r.u for r in df.select("*", sampling.uniform().alias("u")).collect()}
    for s, n in sizes.items():
        least = sorted(range(n), key=lambda i: numbers[s, i])[:10]  # noqa: B023
        assert sorted(r.pixel_id for r in drawn if r.stratum == s) == sorted(least)


def test_tiles(spark, monkeypatch):
    """Windows and components across tile borders, negative places, gaps, unknown classes and other columns."""
    rng = random.Random(8)
    grid = {(x, y): rng.choice([3, 3, 4, 12, None]) for x in range(-70, 75) for y in range(-3, 4) if rng.random() < 0.9}
    grid |= {(x, 200): 21 for x in range(-100, 200)}
    df = spark.createDataFrame([(x, y, c, f"{x}:{y}") for (x, y), c in grid.items()], "x int, y int, class int, name string")
    near = lambda x, y, r: [grid[p] for p in ((x + i, y + j) for i in range(-r, r + 1) for j in range(-r, r + 1)) if grid.get(p) is not None]

    def mode(values):
        return min(set(values), key=lambda c: (-values.count(c), c)) if values else None

    found = {(r.x, r.y): (r.focal, r.name, r["class"]) for r in spatial.focal_mode(df, 2).collect()}
    assert found == {(x, y): (mode(near(x, y, 2)), f"{x}:{y}", c) for (x, y), c in grid.items()}
    most = {(r.x, r.y): r["class"] for r in spatial.focal_extreme(df, "class", 3, "max").collect()}
    assert most == {(x, y): max(near(x, y, 3), default=None) for x, y in grid}
    apart = {(r.x, r.y): r.contrast for r in spatial.contrast(df.where("class is not null"), "class").collect()}
    for (x, y), c in grid.items():
        around = [(grid[p] - c) ** 2 for p in ((x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1)) if c is not None and p != (x, y) and grid.get(p) is not None]
        assert apart.get((x, y)) == (pytest.approx(sum(around) / len(around)) if around else None)
    sizes = flood(grid)
    for cap in (5, 250):
        counted = {(r.x, r.y): (r.conn, r.name) for r in spatial.connected_count(df, cap).collect()}
        assert counted == {(x, y): (min(cap, sizes[x, y]) if c is not None else None, f"{x}:{y}") for (x, y), c in grid.items()}
    assert spatial.connected_count(df.limit(0), 5).count() == 0
