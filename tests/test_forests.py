"""Trees grown for all groups at once are those that plain recursion grows for each group."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from covertrail.operators import forests, ml, selection

CLASSES, BINS = 3, 8


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = []
    for group, n in (("a:1", 200), ("a:2", 90), ("b:1", 3)):
        for i in range(n):
            x = [rng.random(), rng.randint(0, 4) / 4, rng.gauss(0, 1), 1.0, None if rng.random() < 0.1 else rng.random()]
            label = (x[0] > 0.6) + (x[1] > 0.5 and x[2] > 0)
            out.append((group, i, -1 if rng.random() < 0.05 else int(label) if rng.random() < 0.9 else rng.randrange(CLASSES), i % 2, x))
    return out


@pytest.fixture(scope="module")
def samples(spark, rows):
    return spark.createDataFrame(rows, "group string, id long, label int, fold int, features array<double>")


def bins_of(rows):
    found = {}
    for group in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == group]
        edges = []
        for f in range(5):
            values = [r[4][f] for r in own if r[4][f] is not None]
            low, high = min(values), max(values)
            edges.append([low + k * ((high - low) / BINS) for k in range(1, BINS)])
        found[group] = [(i, label, fold, [0 if x[f] is None else sum(e < x[f] for e in edges[f]) for f in range(5)]) for _, i, label, fold, x in own]
    return found


PICKED = {"a:1": [0, 1, 2, 3, 4], "a:2": [0, 2], "b:1": [4, 1]}


def best_split(rows, asked, targets, leaf):
    """rows: (bins, sums). The split of greatest gain, by trying all."""
    total = [sum(s[k] for _, s in rows) for k in range(targets)]
    score = lambda n, s: sum(float(x) * float(x) for x in s) / n
    best = None
    for f in sorted(asked):
        for cut in sorted({b[f] for b, _ in rows}):
            left = [s for b, s in rows if b[f] <= cut]
            n = len(left)
            if n < leaf or len(rows) - n < leaf:
                continue
            sums = [sum(s[k] for s in left) for k in range(targets)]
            gain = score(n, sums) + score(len(rows) - n, [t - x for t, x in zip(total, sums)]) - score(len(rows), total)
            if gain > 1e-9 and (best is None or (gain, -f, -cut) > best):
                best = (gain, -f, -cut)
    return best and (-best[1], -best[2], best[0])


def grow(rows, node, depth, leaf, asked, targets, out):
    """rows: (bins, sums). out: node -> (feature, cut, n, sums)."""
    width = len(rows[0][1])
    split = best_split(rows, asked(node), targets, leaf) if node >> depth == 0 else None
    out[node] = (*(split or (None, None))[:2], len(rows), [sum(s[k] for _, s in rows) for k in range(width)])
    if split:
        f, cut, _ = split
        for child, side in ((2 * node, [r for r in rows if r[0][f] <= cut]), (2 * node + 1, [r for r in rows if r[0][f] > cut])):
            grow(side, child, depth, leaf, asked, targets, out)


def grow_best_first(rows, leaves, depth, leaf, asked, targets):
    """node -> (feature, cut, n, sums): the leaf of greatest gain is split, one at a time, until there are so many leaves."""
    out, held = {}, {1: rows}
    put = lambda node: out.update({node: (None, None, len(held[node]), [sum(s[k] for _, s in held[node]) for k in range(len(rows[0][1]))])})
    put(1)
    while len(held) < leaves:
        splits = {node: best_split(own, asked, targets, leaf) for node, own in held.items() if node >> depth == 0}
        open_ = [node for node, split in splits.items() if split]
        if not open_:
            break
        node = min(open_, key=lambda v: (-splits[v][2], v))
        f, cut, _ = splits[node]
        own = held.pop(node)
        out[node] = (f, cut, *out[node][2:])
        for child, side in ((2 * node, [r for r in own if r[0][f] <= cut]), (2 * node + 1, [r for r in own if r[0][f] > cut])):
            held[child] = side
            put(child)
    return out


def leaf_of(nodes, bins):
    node = 1
    while nodes[node][0] is not None:
        node = 2 * node + (bins[nodes[node][0]] > nodes[node][1])
    return node


@pytest.mark.parametrize("block", [16, 150, 4096])
def test_forest(spark, rows, samples, block):
    trees, per_split, leaf, bag, depth = 6, 2, 4, 0.7, 4
    picked = spark.createDataFrame([(g, p) for g, p in PICKED.items()], "group string, picked array<int>")
    edges = forests.equal_width(samples, BINS)
    blocks = forests.packed(forests.binned(samples, edges), picked, block)
    grown = forests.grow_forest(blocks, CLASSES, trees, per_split, leaf, bag, depth, seed=3)
    found = {(r.group, r.tree, r.node): (r.feature, r.cut, r.n, r.s) for r in grown.collect()}
    expected, told = {}, {}
    for group, own in bins_of(rows).items():
        for tree in range(trees):
            seen = forests.in_bag(np.array([i for i, *_ in own]), tree, bag, 3)
            used = [(b, [int(label == k) for k in range(CLASSES)]) for (_, label, _, b), ok in zip(own, seen) if ok and label >= 0]
            out = {}
            if used:
                asked = lambda node: forests.asked_features(np.array(sorted(PICKED[group])), tree, node, per_split, 3).tolist()  # noqa: B023, E731
                grow(used, 1, depth, leaf, asked, CLASSES, out)
            expected |= {(group, tree, node): v for node, v in out.items()}
            for i, _, _, b in own:
                if out:
                    _, _, n, s = out[leaf_of(out, b)]
                    shares = told.setdefault((group, i), [0.0] * CLASSES)
                    told[group, i] = [x + y / n for x, y in zip(shares, s)]
    assert found == expected and len(found) > 60
    made = {(r.group, r.id): r.prediction for r in forests.classify(blocks, grown, CLASSES, trees, depth).collect()}
    assert made == {k: max(range(CLASSES), key=lambda c: (v[c], -c)) for k, v in told.items()}


def test_bags_and_features_differ():
    ids = np.arange(20000)
    seen = np.stack([forests.in_bag(ids, tree, 0.8, 0) for tree in range(5)])
    assert abs(seen.mean() - 0.8) < 0.01 and abs((seen[0] & seen[1]).mean() - 0.64) < 0.02
    assert forests.in_bag(ids, 0, 1, 0).all()
    asked = [tuple(forests.asked_features(np.arange(30), tree, 1, 5, 0)) for tree in range(50)]
    assert len(set(asked)) > 45 and all(len(a) == 5 for a in asked) and len({f for a in asked for f in a}) == 30


@pytest.mark.parametrize("block", [64, 120, 4096])
def test_boosting(spark, rows, samples, block):
    """Two settings a group, softmax rounds, trees and rates of their own, one without fold 1: against loops over rows."""
    settings = [("a:1", 0, 0.3, 3, None), ("a:1", 1, 0.5, 2, 1), ("a:2", 0, 0.1, 3, 0)]
    depth, leaf, bag = 2, 5, 0.8
    edges = forests.equal_width(samples, BINS)
    blocks = forests.with_settings(forests.packed(forests.binned(samples, edges), block=block), spark.createDataFrame(settings, "group string, setting int, rate double, trees int, held int"))
    done, staged = forests.boost(blocks, CLASSES, 3, depth, leaf, bag, seed=1, stages=(2,), keep=2)
    found = {(r.group, r.setting, r.id): (r.prediction, r.prob) for r in forests.best_classes(done, CLASSES).collect()}
    early = {(r.group, r.setting, r.id): (r.prediction, r.prob) for r in forests.best_classes(staged[2], CLASSES).collect()}

    def softmax(score):
        e = [math.exp(x - max(score)) for x in score]
        return [x / sum(e) for x in e]

    def told(score):
        share = softmax(score)
        best = max(range(CLASSES), key=lambda k: (share[k], -k))
        return best, math.floor(100 * share[best])

    late, first = {}, {}
    for group, setting, rate, trees, held in settings:
        own = bins_of(rows)[group]
        score = {i: [0.0] * CLASSES for i, *_ in own}
        for number in range(3):
            if number == 2:
                first |= {(group, setting, i): told(s) for i, s in score.items()}
            if number >= trees:
                continue
            seen = forests.in_bag(np.array([i for i, *_ in own]), number, bag, 1)
            steps = {i: [0.0] * CLASSES for i in score}
            for k in range(CLASSES):
                used = []
                for (i, label, fold, b), ok in zip(own, seen):
                    if ok and fold != held and label >= 0:
                        r = (label == k) - softmax(score[i])[k]
                        used.append((b, [round(r * 2**24), round(abs(r) * (1 - abs(r)) * 2**24)]))
                out = {}
                grow(used, 1, depth, leaf, lambda _: range(5), 1, out)
                for i, _, _, b in own:
                    s = out[leaf_of(out, b)][3]
                    steps[i][k] = rate * (CLASSES - 1) / CLASSES * s[0] / s[1] if s[1] > 0 else 0.0
            score = {i: [x + y for x, y in zip(s, steps[i])] for i, s in score.items()}
        late |= {(group, setting, i): told(s) for i, s in score.items()}
    near = lambda a, b: a.keys() == b.keys() and all(a[k][0] == b[k][0] and abs(a[k][1] - b[k][1]) <= 1 for k in a)
    assert near(found, late) and near(early, first) and found != early


@pytest.mark.parametrize("block", [64, 4096])
def test_boosting_with_limited_leaves(spark, rows, samples, block):
    """Trees of at most so many leaves are those that best-first growth makes, leaf by leaf; settings without a number have all leaves."""
    settings = [("a:1", 0, 0.3, 2, None, 3), ("a:1", 1, 0.5, 2, 1, 5), ("a:1", 2, 0.5, 2, None, None), ("a:2", 0, 0.4, 2, 0, 2)]
    depth, leaf = 4, 5
    blocks = forests.packed(forests.binned(samples, forests.equal_width(samples, BINS)), block=block)
    blocks = forests.with_settings(blocks, spark.createDataFrame(settings, "group string, setting int, rate double, trees int, held int, leaves int"))
    done, _ = forests.boost(blocks, CLASSES, 2, depth, leaf, 1.0, seed=1)
    size = {g: sum(r[0] == g for r in rows) for g, *_ in settings}
    found = {}
    for r in done.select("group", "rows.id", "scores", F.size("settings").alias("n")).collect():
        scores = np.array(r.scores).reshape(len(r.id), r.n, CLASSES)
        found |= {(r.group, setting, i): scores[at, setting] for at, i in enumerate(r.id) for setting in range(r.n)}
    assert len(found) == sum(size[g] for g, *_ in settings)
    sizes = set()
    for group, setting, rate, trees, held, leaves in settings:
        own = bins_of(rows)[group]
        score = {i: [0.0] * CLASSES for i, *_ in own}
        for _ in range(trees):
            share = {i: np.exp(np.array(s) - max(s)) / np.exp(np.array(s) - max(s)).sum() for i, s in score.items()}
            steps = {i: [0.0] * CLASSES for i in score}
            for k in range(CLASSES):
                used = []
                for i, label, fold, b in own:
                    if fold != held and label >= 0:
                        r = (label == k) - share[i][k]
                        used.append((b, [round(r * 2**24), round(abs(r) * (1 - abs(r)) * 2**24)]))
                out = grow_best_first(used, leaves or 1 << depth, depth, leaf, range(5), 1)
                sizes.add((setting, group, sum(v[0] is None for v in out.values())))
                for i, _, _, b in own:
                    s = out[leaf_of(out, b)][3]
                    steps[i][k] = rate * (CLASSES - 1) / CLASSES * s[0] / s[1] if s[1] > 0 else 0.0
            score = {i: [x + y for x, y in zip(s, steps[i])] for i, s in score.items()}
        assert all(np.allclose(found[group, setting, i], s, rtol=0, atol=1e-5) for i, s in score.items()), (group, setting)
    assert {(0, "a:1", 3), (1, "a:1", 5), (0, "a:2", 2)} <= sizes and max(n for setting, _, n in sizes if setting == 2) > 5


def test_best_first():
    gains = {1: 5.0, 2: 1.0, 3: 4.0, 4: 9.0, 6: 3.0, 7: 3.0}
    sets = [sorted(forests.best_first(list(gains), list(gains.values()), n)) for n in range(1, 9)]
    assert sets == [[], [1], [1, 3], [1, 3, 6], [1, 3, 6, 7], [1, 2, 3, 6, 7], [1, 2, 3, 4, 6, 7], [1, 2, 3, 4, 6, 7]]
    assert forests.best_first([], [], 4) == set()


def test_cv_results(spark):
    scores = [(0.1, 3, 0.5), (0.1, 3, 0.7), (0.1, 10, 0.8), (0.1, 10, 0.4), (1.0, 3, 0.9), (1.0, 3, 0.9), (1.0, 10, 0.1), (1.0, 10, 0.1)]
    found = {(r.rate, r.leaves): (r["mean_score"], round(r["std_score"], 9), r["rank"]) for r in ml.cv_results(spark.createDataFrame(scores, "rate double, leaves int, score double"), "rate", "leaves").collect()}
    assert found == {(0.1, 3): (0.6, 0.1, 2), (0.1, 10): (0.6, 0.2, 2), (1.0, 3): (0.9, 0.0, 1), (1.0, 10): (0.1, 0.0, 4)}


def test_no_rows(spark, samples):
    blocks = forests.packed(forests.binned(samples.limit(0), forests.equal_width(samples.limit(0), BINS)))
    assert forests.grow_forest(blocks, CLASSES, 2).count() == 0


def test_quantile_edges(spark):
    rows = spark.createDataFrame([("g", i, 0, [float(i * i)]) for i in range(1000)], "group string, id long, label int, features array<double>")
    counts = forests.binned(rows, forests.quantiles(rows, 10)).groupBy("bins").count().collect()
    assert len(counts) == 10 and all(80 <= r["count"] <= 120 for r in counts)


TREES, DEPTH, LEAF, BAG = 5, 3, 4, 0.8


def brute_forest(own, listed, held=None):
    """Trees of (id, label, fold, bins) rows, by recursion."""
    out = []
    for tree in range(TREES):
        seen = forests.in_bag(np.array([i for i, *_ in own]), tree, BAG, 0)
        used = [(b, [int(label == k) for k in range(CLASSES)]) for (_, label, fold, b), ok in zip(own, seen) if ok and label >= 0 and fold != held]
        out.append({})
        if used:
            grow(used, 1, DEPTH, LEAF, lambda node: forests.asked_features(np.array(sorted(listed)), tree, node, 2, 0).tolist(), CLASSES, out[-1])  # noqa: B023
    return out


def vote(trees, bins):
    shares = [0.0] * CLASSES
    for nodes in trees:
        if nodes:
            _, _, n, s = nodes[leaf_of(nodes, bins)]
            shares = [x + y / n for x, y in zip(shares, s)]
    return max(range(CLASSES), key=lambda k: (round(shares[k], 9), -k))


def test_elimination(spark, rows, samples):
    blocks = forests.packed(forests.binned(samples, forests.equal_width(samples, BINS)))
    ranked = selection.eliminate(blocks, 5, CLASSES, folds=2, least=1, trees=TREES, per_split=2, leaf=LEAF, bag=BAG, depth=DEPTH)
    found = {(r.group, r.feature): (r.ranking, r.best) for r in ranked.collect()}
    score = lambda s, n: sum(float(x) * x for x in s) / n
    expected = {}
    for group, own in bins_of(rows).items():
        means, path = {}, {}
        for held in (0, 1, None):
            listed = list(range(5))
            for size in range(5, 0, -1):
                trees = brute_forest(own, listed, held)
                if held is not None:
                    tested = [(label, vote(trees, b)) for _, label, fold, b in own if fold == held and label >= 0]
                    if tested:
                        means.setdefault(size, []).append(sum(a == b for a, b in tested) / len(tested))
                weight = dict.fromkeys(listed, 0.0)
                for nodes in trees:
                    for node, (f, _, n, s) in nodes.items():
                        if f is not None:
                            weight[f] += sum(score(nodes[c][3], nodes[c][2]) for c in (2 * node, 2 * node + 1)) - score(s, n)
                goes = min(listed, key=lambda f: (round(weight[f], 9), -f))
                listed.remove(goes)
                if held is None:
                    path[goes] = size
        best = max(means, key=lambda size: (round(sum(means[size]) / len(means[size]), 12), -size))
        expected |= {(group, f): (max(1, size - best + 1), best) for f, size in path.items()}
    assert found == expected
    picked = {r.group: r.picked for r in selection.selected(ranked).collect()}
    assert picked == {g: sorted(f for (h, f), (rank, best) in expected.items() if h == g and rank < 30 - best) for g in {g for g, _ in expected}}


def test_permutation_is_one_of_the_whole_group(spark):
    n = 3000
    rows = spark.range(n).selectExpr("cast(id % 2 as string) as group", "id", "array(cast(id as int)) as bins").repartition(7)
    found = selection.permuted(rows, 2).selectExpr("group", "repeat", "id", "other[0] as other").collect()
    for repeat in range(2):
        mine = {r.id: r.other for r in found if r.repeat == repeat}
        assert sorted(mine) == sorted(mine.values()) == list(range(n)) and all(k % 2 == v % 2 for k, v in mine.items())
        assert sum(k == v for k, v in mine.items()) < 20  # as few stay as chance leaves
        far = sum(abs(k - v) for k, v in mine.items()) / n
        assert 0.9 < far / (n / 3) < 1.1  # values come from the whole group, not from near by
    assert [r.other for r in found if r.repeat == 0] != [r.other for r in found if r.repeat == 1]


def test_permutation_drops(spark, rows, samples):
    known = samples.where("label >= 0")
    binned = forests.binned(known, forests.equal_width(samples, BINS))
    forest = forests.grow_forest(forests.packed(binned), CLASSES, TREES, 2, LEAF, BAG, DEPTH)
    drops = selection.permutation_drops(binned, forest, CLASSES, TREES, DEPTH, repeats=3, block=32)
    found = {(r.group, r.feature): r.drop for r in drops.collect()}
    others = {(r.repeat, r.group, r.id): r.other for r in selection.permuted(binned.select("group", "id", "bins"), 3).collect()}
    for group, own in bins_of(rows).items():
        own = [o for o in own if o[1] >= 0]
        trees = brute_forest(own, range(5))
        if not own:
            continue
        base = sum(vote(trees, b) == label for _, label, _, b in own)
        for f in range(5):
            right = [sum(vote(trees, [*b[:f], others[r, group, i][f], *b[f + 1 :]]) == label for i, label, _, b in own) for r in range(3)]
            assert abs(found[group, f] - (base - sum(right) / 3) / len(own)) < 1e-9


def test_packed_blocks_are_dealt_out(spark, samples):
    """Blocks of small groups stand in files of their own: together they would be one task's work."""
    blocks = forests.packed(forests.binned(samples, forests.equal_width(samples, BINS)))
    assert {r["of"] for r in blocks.collect()} == {1} and [r.group for r in blocks.orderBy("number").collect()] == ["a:1", "a:2", "b:1"]
    assert blocks.select(F.input_file_name()).distinct().count() == 3
    dealt = forests._dealt(forests.without_folds(blocks, 2))
    assert sorted(r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) == [1] * 9


@pytest.mark.parametrize("trees", [1, 7, 40])
def test_trees_side_by_side(spark, samples, trees):
    """However trees are dealt over tasks, they are those that grow level by level over several blocks; all features or some for each split."""
    binned = forests.binned(samples, forests.equal_width(samples, BINS))
    for per_split in (2, 5):
        told = [{(r.group, r.tree, r.node): (r.feature, r.cut, r.n, r.s) for r in forests.grow_forest(forests.packed(binned, block=block), CLASSES, trees, per_split, 3, 0.8, 4).collect()} for block in (None, 64)]
        assert told[0] == told[1] and len({t for _, t, _ in told[0]}) == trees


@pytest.mark.parametrize("leaves", [None, 3])
def test_boosted_classes(spark, samples, leaves):
    """What settings say one by one, at stages too, is what scored blocks of all settings say; held_out leaves the fold that was not seen."""
    settings = [("a:1", 0, 0.3, 3, None, leaves), ("a:1", 1, 0.5, 2, 1, leaves), ("a:2", 0, 0.1, 3, 0, leaves)]
    settings = spark.createDataFrame(settings, "group string, setting int, rate double, trees int, held int, leaves int")
    binned = forests.binned(samples, forests.equal_width(samples, BINS))
    for block in (None, 64):
        blocks = forests.with_settings(forests.packed(binned, block=block), settings)
        done, staged = forests.boost(blocks, CLASSES, 3, depth=3, leaf=5, stages=(1,))
        every = {(s, tuple(r)) for s, rows in {**staged, 3: done}.items() for r in forests.best_classes(rows, CLASSES).collect()}
        plain, held = (forests.boosted_classes(blocks, CLASSES, 3, depth=3, leaf=5, stages=(1,), held_out=h).collect() for h in (False, True))
        assert {(r.stage, tuple(r)[:-1]) for r in plain} == every and len(plain) == len(every) == 2 * (200 * 2 + 90)
        assert {tuple(r) for r in held} == {tuple(r) for r in plain if r.fold == r.held} and len(held) == 2 * (100 + 45)


def test_elimination_of_whole_and_dealt_groups(spark, samples):
    """Runs that one task makes from first to last end as those that go round by round."""
    binned = forests.binned(samples, forests.equal_width(samples, BINS))
    told = [sorted(tuple(r) for r in selection.eliminate(forests.packed(binned, block=block), 5, CLASSES, folds=2, least=least, trees=TREES, per_split=2, leaf=LEAF, bag=BAG, depth=DEPTH).collect()) for least in (4,) for block in (None, 64)]
    assert told[0] == told[1] and len(told[0]) == 15
