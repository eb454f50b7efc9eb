"""Forests and boosting for many groups of samples at once, grown level by level.

A group is what gets a model of its own: a basin and year. Features are binned once and
packed into blocks of samples of one group. A level of all trees of all groups is one job:
each task walks its blocks through the splits found so far and sums up histograms in
numpy; SQL adds the histograms and chooses the splits. Blocks bound what a task holds, so
a group of any size is dealt over tasks, and no sample, histogram or model passes through
the driver. A group whose samples make one block needs no exchange: tasks grow whole trees
of it, by the same rule; each takes the block and a share of the trees or one setting.
Sums are integers, so results do not depend on how rows were dealt.

A tree's nodes are numbered as a heap: 1 is the root, 2k and 2k + 1 are the children of k;
rows whose bin is at most the cut go to 2k.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stored

#: Samples of a block, and those that a group may have in one block, which a task holds as bytes (a feature each).
BLOCK, WHOLE = 1 << 15, 1 << 18
#: Rows of the trees that a task grows side by side.
_PAIRS = 1 << 16
#: Residuals are summed in units of 2 ** -24.
_UNIT = float(1 << 24)
_NODE = ["group", "tree", "node"]


# binning and packing


def equal_width(samples: DataFrame, bins: int) -> DataFrame:
    """group, edges (array of arrays): bins - 1 cut points of each feature between its least and greatest value in the group."""
    features = samples.select("group", F.posexplode("features").alias("feature", "value"))
    ranges = features.groupBy("group", "feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    steps = F.sequence(F.lit(1), F.lit(bins - 1))
    edges = F.transform(steps, lambda k: F.col("low") + k * ((F.col("high") - F.col("low")) / bins))
    listed = F.sort_array(F.collect_list(F.struct("feature", edges.alias("edges"))))
    return ranges.groupBy("group").agg(F.transform(listed, lambda x: x["edges"]).alias("edges"))


def quantiles(samples: DataFrame, bins: int) -> DataFrame:
    """group, edges: cut points at (approximate) quantiles, for features far from uniform."""
    features = samples.select("group", F.posexplode("features").alias("feature", "value"))
    shares = F.array(*(F.lit(k / bins) for k in range(1, bins)))
    cuts = features.groupBy("group", "feature").agg(F.percentile_approx("value", shares, 10_000).alias("edges"))
    listed = F.sort_array(F.collect_list(F.struct("feature", F.array_distinct("edges").alias("edges"))))
    return cuts.groupBy("group").agg(F.transform(listed, lambda x: x["edges"]).alias("edges"))


def binned(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """rows with bins: for each feature the number of its edges below the value (missing values: 0). edges, a row for each group, is broadcast."""
    below = F.zip_with("features", "edges", lambda v, e: F.size(F.filter(e, lambda x: x < v)))
    counts = F.transform(below, lambda n: F.greatest(n, F.lit(0)).cast("tinyint"))
    return rows.join(F.broadcast(edges), "group").withColumn("bins", counts).drop("edges", "features")


def packed(rows: DataFrame, picked: DataFrame | None = None, block: int | None = None) -> DataFrame:
    """Blocks of binned rows (group, id, label, bins, perhaps fold), dealt by a hash of the id and written once.

    A group of up to WHOLE rows is one block, others are dealt into blocks of about BLOCK
    rows; block stands for both. of is the number of the group's blocks, number the group's
    place among the groups (the largest first), label the place of the class among the
    classes (-1: unknown). picked (group, picked) lists the features that a group's trees
    may use, by their places; all without it.
    """
    most, each = (block, block) if block else (WHOLE, BLOCK)
    n = F.count("*")
    sizes = rows.groupBy("group").agg(n.alias("_n"), F.when(n <= most, F.lit(1)).otherwise(F.ceil(n / each)).cast("long").alias("_blocks"))
    # a row for each group, the largest first
    order = Window.orderBy(F.desc("_n"), "group")
    before = F.sum("_blocks").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_blocks")
    sizes = stored(sizes.select("group", "_blocks", (F.row_number().over(order) - 1).alias("_number"), before.alias("_before")), "sizes")
    fold = F.col("fold") if "fold" in rows.columns else F.lit(-1)
    row = F.struct(F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"), fold.cast("int").alias("fold"), "bins")
    dealt = rows.join(F.broadcast(sizes), "group").groupBy("group", F.pmod(F.xxhash64("id"), "_blocks").alias("block"))
    whole = [F.max(c).alias(c.removeprefix("_").replace("blocks", "of")) for c in ("_blocks", "_number", "_before")]
    dealt = dealt.agg(F.collect_list(row).alias("rows"), *whole, F.lit(-2).alias("held"))
    if picked is None:
        dealt = dealt.withColumn("picked", F.lit(None).cast("array<int>"))
    else:
        dealt = dealt.join(picked.select("group", F.col("picked").cast("array<int>").alias("picked")), "group")
    # a block is few bytes and much work, and Parquet's reader takes a file's records at once: they are dealt out, not put together
    files = min(1024, sizes.agg(F.sum("_blocks")).first()[0] or 1)
    return stored(dealt.repartitionById(files, F.pmod(F.col("before") + F.col("block"), F.lit(files)).cast("int")).drop("before"), "blocks")


def _cores(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def _dealt(blocks: DataFrame, parts: int = 1, part: Column | None = None) -> DataFrame:
    """Blocks of groups that have one, each group and part of its work in a task of its own as far as 1024 tasks go."""
    part = F.lit(0) if part is None else part
    n = blocks.agg(F.max("number")).first()[0]
    tasks = min(1024, parts * (1 + (n or 0)))
    return blocks.repartitionById(tasks, F.pmod(F.col("number") * parts + part, F.lit(tasks)).cast("int"))


def _spread(blocks: DataFrame) -> DataFrame:
    """Blocks over all cores: their bytes are few for the work that they make."""
    return blocks.repartition(4 * _cores(blocks), "group", "block")


def without_folds(blocks: DataFrame, folds: int) -> DataFrame:
    """Blocks once for each fold, as groups "<group>|<fold>" whose models do not see that fold, and once whole as "<group>|"."""
    held = F.explode(F.array(*map(F.lit, range(folds)), F.lit(-2))).alias("held")
    dealt = blocks.select("group", "block", "rows", "of", "number", "picked", held)
    run = F.when(F.col("held") >= 0, F.col("held")).otherwise(folds)
    return dealt.withColumns({"number": F.col("number") * (folds + 1) + run, "group": F.concat("group", F.lit("|"), F.when(F.col("held") >= 0, F.col("held").cast("string")).otherwise(""))})


class _Block:
    """A packed block's columns as numpy arrays."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        rows = batch.column("rows")[at].values
        self.ids, self.labels, self.folds = (rows.field(k).to_numpy(zero_copy_only=False) for k in ("id", "label", "fold"))
        bins = rows.field("bins").flatten().to_numpy(zero_copy_only=False)
        self.bins = bins.reshape(len(self.ids), -1) if len(self.ids) else np.zeros((0, 0), np.int8)
        self.known = self.labels >= 0
        if "held" in batch.schema.names:
            self.known &= self.folds != batch.column("held")[at].as_py()
        own = batch.column("picked")[at].as_py()
        self.picked = np.array(range(self.bins.shape[1]) if own is None else sorted(f for f in set(own) if 0 <= f < self.bins.shape[1]), np.int64)


def _table(listed: pa.ListScalar, trees: int, depth: int, *columns: tuple[str, float]) -> list[np.ndarray]:
    """Columns of a list of nodes as (tree, node) tables; what has no node gets the default."""
    out = [np.full((trees, 1 << depth + 1), default) for _, default in columns]
    if listed.is_valid and len(listed.values):
        nodes = listed.values
        at = nodes.field("tree").to_numpy(zero_copy_only=False), nodes.field("node").to_numpy(zero_copy_only=False)
        for table, (name, default) in zip(out, columns):
            table[at] = nodes.field(name).fill_null(default).to_numpy(zero_copy_only=False)
    return out


def _walk(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node that each row reaches in one tree within so many levels."""
    node, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
    for _ in range(levels):
        asked = feature[node]
        node = np.where(asked >= 0, 2 * node + (bins[rows, asked] > cut[node]), node)
    return node


def _mix(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number."""
    with np.errstate(over="ignore"):
        x = np.asarray(x).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


def in_bag(ids: np.ndarray, tree: int, bag: float, seed: int) -> np.ndarray:
    """Which rows a tree sees: a repeatable share of them, whatever block they are in."""
    if bag >= 1:
        return np.ones(len(ids), bool)
    return _mix(ids.astype(np.uint64) ^ _mix(np.uint64(seed << 32 | tree))) < np.uint64(bag * (2**64 - 2**11))


def asked_features(picked: np.ndarray, tree: int, node: int, per_split: int, seed: int) -> np.ndarray:
    """The features that a node's split is chosen from."""
    return picked[_asked_places(picked, np.array([tree]), np.array([node]), per_split, seed)[0]]


def _asked_places(picked: np.ndarray, tree: np.ndarray, node: np.ndarray, per_split: int, seed: int) -> np.ndarray:
    """The places in picked of the features that each node's split is chosen from."""
    if per_split >= len(picked):
        return np.tile(np.arange(len(picked)), (len(node), 1))
    of = _mix((np.uint64(seed << 20) | tree.astype(np.uint64)) << np.uint64(24) | node.astype(np.uint64))
    order = _mix(picked.astype(np.uint64) ^ of[:, None])
    return np.sort(np.argsort(order, axis=1, kind="stable")[:, :per_split], axis=1)


def _counts(columns: np.ndarray, row: np.ndarray, of: np.ndarray, listed: np.ndarray | None, weights: Sequence[np.ndarray], nodes: int, top: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """n [node, place, bin] and sums [node, place, bin, width] of rows that stand at nodes: counts of labels or sums of weights.

    columns [feature, row] hold bins, without weights bin * width + label. of is the node of
    each row, listed the features that each node asks for (None: all).
    """
    m, each = len(columns) if listed is None else listed.shape[1], top if weights else top * width
    n, sums = np.zeros((m, nodes * each), np.int64), np.zeros((len(weights), m, nodes * each))
    flat, step = columns.ravel(), max(_PAIRS, 2 * nodes * each)
    for start in range(0, len(row), step):
        part = slice(start, start + step)
        rows, base = row[part], of[part] * each
        for place in range(m):
            if listed is None:
                code = columns[place].take(rows, mode="clip") + base
            else:
                code = flat.take(listed[:, place].take(of[part], mode="clip") * columns.shape[1] + rows, mode="clip") + base
            n[place] += np.bincount(code, minlength=nodes * each)
            for total, w in zip(sums, weights):
                total[place] += np.bincount(code, w[part], nodes * each)
    if not weights:
        found = np.ascontiguousarray(n.reshape(m, nodes, top, width).swapaxes(0, 1))
        return found.sum(axis=3), found
    return np.ascontiguousarray(n.reshape(m, nodes, top).swapaxes(0, 1)), np.ascontiguousarray(sums.astype(np.int64).reshape(len(weights), m, nodes, top).transpose(2, 1, 3, 0))


def _columns(bins: np.ndarray, labels: np.ndarray | None, classes: int) -> np.ndarray:
    """Rows of bins as _counts() takes them."""
    columns = np.ascontiguousarray(bins.T)
    return columns if labels is None else columns.astype(np.int16) * np.int16(classes) + labels.astype(np.int16)


def _histogram(bins: np.ndarray, node: np.ndarray, asked: Callable[[np.ndarray], np.ndarray], labels: np.ndarray | None, weights: Sequence[np.ndarray], width: int) -> tuple[np.ndarray, ...]:
    """Nodes, their features [node, place], and what _counts() gives of them."""
    distinct, of = np.unique(node, return_inverse=True)
    listed = asked(distinct)
    return distinct, listed, *_counts(_columns(bins, labels, width), np.arange(len(bins)), of, listed, weights, len(distinct), int(bins.max(initial=0)) + 1, width)


def _best(listed: np.ndarray, n: np.ndarray, sums: np.ndarray, leaf: int, scored: int | None = None) -> tuple[np.ndarray, ...]:
    """What choose_splits() says of each node of a whole histogram: feature (-1: none), cut, n, s, left n, left s, gain."""

    def score(n: np.ndarray, s: np.ndarray) -> np.ndarray:
        return np.einsum("...k,...k->...", s, s) / np.maximum(n, 1)  # counts are small enough for any order of adding their squares

    left_n, left_s = n.cumsum(axis=2), sums.cumsum(axis=2)
    all_n, all_s = left_n[:, :, -1:], left_s[:, :, -1:]
    used = left_s[..., :scored].astype(float)
    gain = score(left_n, used) + score(all_n - left_n, used[:, :, -1:] - used) - score(all_n, used[:, :, -1:])
    allowed = (left_n >= leaf) & (all_n - left_n >= leaf) & (gain > 1e-9)
    gain = np.where(allowed, gain, -1.0).reshape(len(n), -1)
    best, rows = gain.argmax(axis=1), np.arange(len(n))
    place, cut = best // n.shape[2], best % n.shape[2]
    feature = np.where(gain[rows, best] > 0, listed[rows, place], -1)
    return feature, np.where(feature >= 0, cut, -1), all_n[:, 0, 0], all_s[:, 0, 0], left_n[rows, place, cut], left_s[rows, place, cut], gain[rows, best]


def best_first(nodes: Sequence[int], gains: Sequence[float], leaves: int) -> set[int]:
    """Those of a tree's split nodes that are split if the leaf of greatest gain (of equal ones the first) always is, until there are so many leaves.

    A node's split depends on its rows alone, so these are part of the tree grown level by level.
    """
    gain, kept = dict(zip(nodes, gains)), set()
    heap = [(-gain[1], 1)] if 1 in gain else []
    while heap and len(kept) + 1 < leaves:
        _, node = heapq.heappop(heap)
        kept.add(node)
        for child in (2 * node, 2 * node + 1):
            if child in gain:
                heapq.heappush(heap, (-gain[child], child))
    return kept


def _grow_here(
    bins: np.ndarray, tree: np.ndarray, row: np.ndarray, asked: Callable[[np.ndarray, np.ndarray], np.ndarray] | None, labels: np.ndarray | None, weights: Sequence[np.ndarray], width: int, leaf: int, depth: int, scored: int | None = None
) -> tuple[np.ndarray, ...]:
    """Trees of rows that are all in this task, grown side by side: tree, node, feature (its column in bins), cut (-1 in leaves), n, s, gain.

    tree and row list the rows that each tree sees, the trees one after another; labels are
    those of bins' rows, weights those of each tree and row. asked gives the columns that
    nodes (tree, node) choose from; without it all do, and of two children only the one of
    fewer rows is counted, as the other has the rest of its parent's histogram.
    """
    top, found, every = int(bins.max(initial=0)) + 1, [], np.arange(bins.shape[1])
    columns, flat = _columns(bins, labels, width), np.ascontiguousarray(bins.T).ravel()
    sees = np.bincount(tree)
    trees = np.flatnonzero(sees)
    at, nodes, of = trees, np.ones(len(trees), np.int64), np.repeat(np.arange(len(trees)), sees[trees])
    n = sums = small = goes_small = up = None
    for level in range(depth):
        listed = None if asked is None else asked(at, nodes)
        if listed is not None or not level:
            n, sums = _counts(columns, row, of, listed, weights, len(nodes), top, width)
        else:
            least_n, least_s = _counts(columns, row[goes_small], up[goes_small], None, [w[goes_small] for w in weights], len(nodes) // 2, top, width)
            fewer, more = np.arange(len(nodes)).reshape(-1, 2)[np.arange(len(small)), small], np.arange(len(nodes)).reshape(-1, 2)[np.arange(len(small)), 1 - small]
            above_n, above_s = n, sums
            n, sums = np.empty((len(nodes), *above_n.shape[1:]), np.int64), np.empty((len(nodes), *above_s.shape[1:]), np.int64)
            n[fewer], n[more], sums[fewer], sums[more] = least_n, above_n - least_n, least_s, above_s - least_s
        feature, cut, all_n, all_s, left_n, left_s, gain = _best(np.broadcast_to(every, (len(nodes), len(every))) if listed is None else listed, n, sums, leaf, scored)
        found.append((at, nodes, feature, cut, all_n, all_s, gain))
        split = np.flatnonzero(feature >= 0)
        if not len(split):
            break
        at, nodes = np.repeat(at[split], 2), (2 * nodes[split, None] + np.arange(2)).ravel()
        if level == depth - 1:
            none = np.full(len(nodes), -1)
            rest_n, rest_s = (all_n - left_n)[split], (all_s - left_s)[split]
            found.append((at, nodes, none, none, np.stack([left_n[split], rest_n], axis=1).ravel(), np.stack([left_s[split], rest_s], axis=1).reshape(-1, all_s.shape[1]), none.astype(float)))
            break
        place = np.full(len(feature), -1)
        place[split] = np.arange(len(split))
        if len(split) < len(feature):
            stays = np.flatnonzero(place[of] >= 0)
            row, of, weights = row[stays], of[stays], [w[stays] for w in weights]
        right, up = flat.take(feature[of] * len(bins) + row, mode="clip") > cut[of], place[of]
        of = 2 * up + right
        if asked is None:
            small = (2 * left_n[split] > all_n[split]).astype(np.int64)
            goes_small, n, sums = np.flatnonzero(right == small[up]), n[split], sums[split]
    return tuple(map(np.concatenate, zip(*found)))


def _forest_here(block: _Block, picked: np.ndarray, trees: Sequence[int], classes: int, per_split: int, leaf: int, bag: float, depth: int, seed: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(tree, node, feature, cut, n, s, gain) of some trees of a whole group, a few trees at a time."""
    known = np.flatnonzero(block.known)
    if not len(known) or not len(picked):
        return
    bins, labels, ids = block.bins[known][:, picked], block.labels[known], block.ids[known]
    asked = None if per_split >= len(picked) else lambda t, v: _asked_places(picked, t, v, per_split, seed)
    step = max(1, _PAIRS // len(known))
    for start in range(0, len(trees), step):
        rows = [np.flatnonzero(in_bag(ids, tree, bag, seed)) for tree in trees[start : start + step]]
        tree = np.repeat(np.array(trees[start : start + step]), [len(r) for r in rows])
        if len(tree):
            at, node, feature, cut, n, s, gain = _grow_here(bins, tree, np.concatenate(rows), asked, labels, (), classes, leaf, depth)
            yield at, node, np.where(feature >= 0, picked[feature], -1), cut, n, s, gain


_CELLS = "group string, tree int, node int, feature int, bin int, n long, s array<bigint>"


def _cells(group: str, parts: list[tuple[np.ndarray, ...]], width: int) -> pa.RecordBatch:
    """A batch of _CELLS from (tree, node, feature, bin, n, s) arrays."""
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5 + [np.zeros((0, width), np.int64)]
    n, sums = len(columns[0]), columns[5].astype(np.int64)
    listed = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(sums.ravel(), pa.int64()))
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([group] * n, pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds)), listed], names=["group", "tree", "node", "feature", "bin", "n", "s"])


def _nodes_of_group(nodes: DataFrame, *columns: str, name: str = "splits") -> DataFrame:
    return nodes.groupBy("group").agg(F.collect_list(F.struct(*columns)).alias(name))


# splits


def choose_splits(cells: DataFrame, width: int, leaf: int, scored: int | None = None) -> DataFrame:
    """group, tree, node, feature, cut, gain, n, s, left_n, left_s of each node in a histogram.

    cells: group, tree, node, feature, bin, n and s, an array of width sums. A side's score
    is the sum of squares of its first `scored` sums (all without it) over its n: with class
    counts the split of the greatest gain is the one of least Gini impurity, with residuals
    that of least squares. Sides have at least `leaf` rows. Ties go to the first feature and
    least cut. feature is null where no split gains.
    """
    key, names = [*_NODE, "feature"], [f"s{k}" for k in range(width)]
    added = cells.groupBy(*key, "bin").agg(F.sum("n").alias("n"), *(F.sum(F.col("s")[k]).alias(c) for k, c in enumerate(names)))
    so_far = Window.partitionBy(*key).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*key)
    sides = added.select(*key, "bin", *(F.sum(c).over(so_far).alias(f"l_{c}") for c in ["n", *names]), *(F.sum(c).over(whole).alias(f"a_{c}") for c in ["n", *names]))
    used = names[:scored]

    def score(n: Column, sums: list[Column]) -> Column:
        squares = [s.cast("double") * s.cast("double") for s in sums]
        return reduce(lambda a, b: a + b, squares) / F.nullif(n, F.lit(0))

    left, every = F.col("l_n"), F.col("a_n")
    right = every - left
    gain = score(left, [F.col(f"l_{c}") for c in used]) + score(right, [F.col(f"a_{c}") - F.col(f"l_{c}") for c in used]) - score(every, [F.col(f"a_{c}") for c in used])
    lefts = F.array(*(F.col(f"l_{c}") for c in names))
    best = F.struct(F.col("gain").alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), left.alias("n"), lefts.alias("s"))
    allowed = (left >= leaf) & (right >= leaf) & (F.col("gain") > 1e-9)
    found = sides.withColumn("gain", gain).groupBy(*_NODE).agg(F.max(F.when(allowed, best)).alias("best"), F.max("a_n").alias("n"), F.max(F.array(*(F.col(f"a_{c}") for c in names))).alias("s"))
    best = F.col("best")
    return found.select(*_NODE, (-best["f"]).alias("feature"), (-best["b"]).alias("cut"), best["gain"].alias("gain"), "n", "s", best["n"].alias("left_n"), best["s"].alias("left_s"))


def _children(nodes: DataFrame) -> DataFrame:
    """Both children of split nodes, as leaves."""
    right = F.zip_with("s", "left_s", lambda a, b: a - b)
    sides = F.array(
        F.struct((2 * F.col("node")).alias("node"), F.col("left_n").alias("n"), F.col("left_s").alias("s")),
        F.struct((2 * F.col("node") + 1).alias("node"), (F.col("n") - F.col("left_n")).alias("n"), right.alias("s")),
    )
    none = F.lit(None).cast("int")
    return nodes.where("feature is not null").select("group", "tree", F.inline(sides)).select(*_NODE, none.alias("feature"), none.alias("cut"), "n", "s")


def _grown(level_nodes, depth: int) -> DataFrame:
    """Nodes of trees from level_nodes(level, nodes so far), which gives the nodes of a level with their splits."""
    found: list[DataFrame] = []
    for level in range(depth):
        nodes = stored(level_nodes(level, reduce(DataFrame.unionByName, found) if found else None), "tree-level")
        found.append(nodes)
        if nodes.where("feature is not null").isEmpty():
            break
    kept = [*_NODE, "feature", "cut", "n", "s"]
    leaves = _children(found[-1]).select(kept)
    return reduce(DataFrame.unionByName, (n.select(kept) for n in found)).unionByName(leaves)


# forests


def class_histograms(blocks: DataFrame, nodes: DataFrame | None, level: int, classes: int, trees: int, per_split: int, bag: float, seed: int) -> DataFrame:
    """Partial histograms of class counts (one row for each block, tree, node, feature and bin that has rows) of a level."""
    if nodes is None:
        given = blocks.withColumn("splits", F.lit(None).cast("array<struct<tree:int,node:int,feature:int,cut:int>>"))
    else:
        given = blocks.join(_nodes_of_group(nodes.where("feature is not null"), "tree", "node", "feature", "cut"), "group", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, group = _Block(batch, at), batch.column("group")[at].as_py()
                features, cuts = _table(batch.column("splits")[at], trees, level, ("feature", -1), ("cut", -1))
                parts = []
                for tree in range(trees):
                    rows = np.flatnonzero(in_bag(block.ids, tree, bag, seed) & block.known)
                    node = _walk(block.bins[rows], features[tree], cuts[tree], level)
                    rows, node = rows[node >> level > 0], node[node >> level > 0]
                    if not len(rows) or not len(block.picked):
                        continue
                    asked = lambda v: block.picked[_asked_places(block.picked, np.full(len(v), tree), v, per_split, seed)]  # noqa: B023, E731
                    distinct, listed, n, sums = _histogram(block.bins[rows], node, asked, block.labels[rows], (), classes)
                    v, f, b = np.nonzero(n)
                    parts.append((np.full(len(v), tree), distinct[v], listed[v, f], b, n[v, f, b], sums[v, f, b]))
                yield _cells(group, parts, classes)

    return _spread(given).select("group", "rows", "picked", "held", "splits").mapInArrow(run, _CELLS)


def _whole_forests(blocks: DataFrame, classes: int, trees: int, per_split: int, leaf: int, bag: float, depth: int, seed: int) -> DataFrame:
    """The forests of groups that have one block; few groups have their trees dealt to several tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, group, part = _Block(batch, at), batch.column("group")[at].as_py(), batch.column("part")[at].as_py()
                own = range(part * trees // parts, (part + 1) * trees // parts)
                for tree, node, feature, cut, n, s, _ in _forest_here(block, block.picked, own, classes, per_split, leaf, bag, depth, seed):
                    yield _cells(group, [(tree, node, feature, cut, n, s)], classes)

    parts = min(trees, math.ceil(2 * _cores(blocks) / max(1, blocks.count())))
    dealt = _dealt(blocks.select("group", "rows", "picked", "held", "number", F.explode(F.array(*map(F.lit, range(parts)))).alias("part")), parts, F.col("part"))
    made = dealt.select("group", "rows", "picked", "held", "part").mapInArrow(run, _CELLS)
    real = lambda c: F.when(F.col("feature") >= 0, F.col(c))
    return made.select(*_NODE, real("feature").alias("feature"), real("bin").alias("cut"), "n", "s")


def grow_forest(blocks: DataFrame, classes: int, trees: int = 165, per_split: int = 15, leaf: int = 40, bag: float = 0.8, depth: int = 10, seed: int = 0) -> DataFrame:
    """A forest for each group: group, tree, node, feature, cut (null in leaves), n and s (rows by class).

    Groups of one block are grown in one job, each in its task. The others take as many
    jobs as levels, whatever the number of groups and trees. The trees are the same either
    way. A group without known labels has no nodes.
    """
    whole = stored(_whole_forests(blocks.where("of = 1"), classes, trees, per_split, leaf, bag, depth, seed), "forests")
    large = blocks.where("of > 1")
    if large.isEmpty():
        return whole
    level_nodes = lambda level, nodes: choose_splits(class_histograms(large, nodes, level, classes, trees, per_split, bag, seed), classes, leaf)
    return whole.unionByName(_grown(level_nodes, depth))


class _Forest:
    """A group's forest as (tree, node) tables."""

    def __init__(self, nodes: pa.ListScalar, trees: int, depth: int, classes: int):
        wanted = [("feature", -1), ("cut", -1), ("n", 1), *((f"s{k}", 0) for k in range(classes))]
        self.features, self.cuts, n, *sums = _table(nodes, trees, depth, *wanted)
        self.shares, self.depth = np.stack(sums, axis=2) / n[:, :, None], depth

    @classmethod
    def of(cls, grown: Iterable[tuple[np.ndarray, ...]], trees: int, depth: int, classes: int) -> _Forest:
        """The forest that _forest_here() gave in this task."""
        made = cls.__new__(cls)
        shape = trees, 1 << depth + 1
        made.features, made.cuts, made.n, made.sums, made.depth = np.full(shape, -1), np.full(shape, -1), np.ones(shape, np.int64), np.zeros((*shape, classes), np.int64), depth
        for tree, node, feature, cut, n, s, _ in grown:
            made.features[tree, node], made.cuts[tree, node], made.n[tree, node], made.sums[tree, node] = feature, cut, n, s
        made.shares = made.sums / made.n[:, :, None]
        return made

    def importance(self, features: int) -> np.ndarray:
        """gini_importance() of each feature in a forest of of()."""
        score = reduce(lambda a, b: a + b, (self.sums[:, :, k].astype(float) * self.sums[:, :, k] for k in range(self.sums.shape[2]))) / self.n
        tree, node = np.nonzero(self.features >= 0)
        return np.bincount(self.features[tree, node], score[tree, 2 * node] + score[tree, 2 * node + 1] - score[tree, node], features)

    def votes(self, bins: np.ndarray, trees: Iterable[int]) -> np.ndarray:
        """The class shares [tree, row, class] of some trees."""
        return np.stack([self.shares[t, _walk(bins, self.features[t], self.cuts[t], self.depth)] for t in trees])


def _with_forest(blocks: DataFrame, forest: DataFrame, classes: int) -> DataFrame:
    return blocks.join(_nodes_of_group(forest, "tree", "node", "feature", "cut", "n", *(F.col("s")[k].alias(f"s{k}") for k in range(classes)), name="nodes"), "group")


def classify(blocks: DataFrame, forest: DataFrame, classes: int, trees: int, depth: int = 10) -> DataFrame:
    """group, id, label, fold, prediction (place of the class, the first of those alike), prob (percent) by the mean of the trees' class shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, group = _Block(batch, at), batch.column("group")[at].as_py()
                forest = _Forest(batch.column("nodes")[at], trees, depth, classes)
                total = np.zeros((len(block.ids), classes))
                for tree in range(trees):
                    total += forest.votes(block.bins, [tree])[0]
                best = total.argmax(axis=1)
                prob = np.floor(100 * total[np.arange(len(best)), best] / np.maximum(total.sum(axis=1), 1e-300) + 1e-9).astype(np.int32)
                columns = [block.ids, block.labels, block.folds, best.astype(np.int32), prob]
                yield pa.RecordBatch.from_arrays([pa.array([group] * len(best), pa.string()), *map(pa.array, columns)], names=["group", "id", "label", "fold", "prediction", "prob"])

    given = _spread(_with_forest(blocks, forest, classes)).select("group", "rows", "picked", "nodes")
    return given.mapInArrow(run, "group string, id long, label int, fold int, prediction int, prob int")


def class_shares(blocks: DataFrame, forest: DataFrame, classes: int, trees: int, depth: int = 10) -> DataFrame:
    """group, id, label, fold, shares: the sum of the trees' shares of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, group = _Block(batch, at), batch.column("group")[at].as_py()
                total = _Forest(batch.column("nodes")[at], trees, depth, classes).votes(block.bins, range(trees)).sum(axis=0)
                columns = [pa.array([group] * len(total), pa.string()), *map(pa.array, (block.ids, block.labels, block.folds)), pa.array(list(total), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["group", "id", "label", "fold", "shares"])

    given = _spread(_with_forest(blocks, forest, classes)).select("group", "rows", "picked", "nodes")
    return given.mapInArrow(run, "group string, id long, label int, fold int, shares array<double>")


def gini_importance(forest: DataFrame) -> DataFrame:
    """group, feature, importance: what splits on the feature take off the sum of Gini impurities, over all trees."""
    squares = F.aggregate("s", F.lit(0.0), lambda a, x: a + x.cast("double") * x) / F.col("n")
    nodes = forest.select(*_NODE, "feature", squares.alias("score"))
    up = F.when(F.col("node") > 1, F.expr("node div 2"))
    children = nodes.select("group", "tree", up.alias("node"), "score").where("node is not null").groupBy(*_NODE).agg(F.sum("score").alias("below"))
    gained = nodes.where("feature is not null").join(children, _NODE)
    return gained.groupBy("group", "feature").agg(F.sum(F.col("below") - F.col("score")).alias("importance"))


# boosting


def with_settings(blocks: DataFrame, settings: DataFrame) -> DataFrame:
    """Blocks of the groups in settings (group, setting, rate, trees, held, perhaps leaves), which number from 0 in each group.

    A setting is a boosted model: its learning rate, its number of trees a class, the fold
    that it is not trained on (null: none) and the number of leaves of a tree (null: no limit).
    """
    leaves = F.col("leaves") if "leaves" in settings.columns else F.lit(None)
    row = F.struct(F.col("setting").cast("int").alias("setting"), F.col("rate").cast("double").alias("rate"), F.col("trees").cast("int").alias("trees"), F.coalesce(F.col("held").cast("int"), F.lit(-2)).alias("held"), F.coalesce(leaves.cast("int"), F.lit(0)).alias("leaves"))
    listed = settings.groupBy("group").agg(F.sort_array(F.collect_list(row)).alias("settings"))
    return blocks.join(listed, "group").withColumn("scores", F.lit(None).cast("array<double>"))


class _Scored(_Block):
    """A block with its settings and the scores of its rows: [row, setting, class]."""

    def __init__(self, batch: pa.RecordBatch, at: int, classes: int, depth: int):
        super().__init__(batch, at)
        self.classes, self.depth = classes, depth
        settings = batch.column("settings")[at].values
        self.rates, self.trees, self.held, self.leaves = (settings.field(k).to_numpy(zero_copy_only=False) for k in ("rate", "trees", "held", "leaves"))
        shape = len(self.ids), len(self.rates), classes
        told = batch.column("scores")[at]
        self.scores = told.values.to_numpy(zero_copy_only=False).reshape(shape).copy() if told.is_valid else np.zeros(shape)
        rounds = batch.column("recent")[at]
        if rounds.is_valid:
            for nodes in rounds.values.field("nodes"):
                self._add(nodes)

    def _add(self, nodes: pa.ListScalar) -> None:
        """Add the trees of one round; a leaf steps by rate * (K - 1) / K * sum(r) / sum(|r| (1 - |r|))."""
        slots = len(self.rates) * self.classes
        names = [(c, 0) for c in ("s0", "s1", "l0", "l1")]
        features, cuts, s0, s1, l0, l1 = _table(nodes, slots, self.depth, ("feature", -1), ("cut", -1), *names)
        last = slice(1 << self.depth - 1, 1 << self.depth)  # the children of these have no rows of their own
        for own, left in ((s0, l0), (s1, l1)):
            split = features[:, last] >= 0
            children = np.stack([left[:, last], own[:, last] - left[:, last]], axis=2)
            own[:, 1 << self.depth :] = np.where(split[:, :, None], children, 0).reshape(slots, -1)
        step = np.repeat(self.rates, self.classes)[:, None] * ((self.classes - 1) / self.classes)
        values = np.where(s1 > 0, step * s0 / np.maximum(s1, 1), 0.0)
        for slot in range(slots):
            setting, k = divmod(slot, self.classes)
            self.scores[:, setting, k] += values[slot, _walk(self.bins, features[slot], cuts[slot], self.depth)]

    def seen(self, setting: int, number: int, bag: float, seed: int) -> np.ndarray:
        """Which rows the trees of a round are fitted to."""
        return in_bag(self.ids, number, bag, seed) & (self.folds != self.held[setting]) & (self.labels >= 0)

    def residuals(self, setting: int) -> np.ndarray:
        return _residuals(self.scores[:, setting], self.labels)


def _residuals(score: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """What the softmax of scores [row, class] leaves of the labels."""
    share = np.exp(score - score.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    return (labels[:, None] == np.arange(score.shape[1])) - share


def _gradients(r: np.ndarray) -> list[np.ndarray]:
    """What leaves sum up, in whole units."""
    return [np.rint(x * _UNIT) for x in (r, np.abs(r) * (1 - np.abs(r)))]


_RECENT = "array<struct<round:int,nodes:array<struct<tree:int,node:int,feature:int,cut:int,s0:bigint,s1:bigint,l0:bigint,l1:bigint>>>>"
#: What scored blocks keep.
_KEPT = ["group", "block", "rows", "picked", "settings"]
#: The levels of one round's trees.
Round = list[DataFrame]


def _with_rounds(blocks: DataFrame, rounds: Sequence[Round]) -> DataFrame:
    """Blocks with recent: the trees of rounds that their scores do not hold yet, in order."""
    if not rounds:
        return blocks.withColumn("recent", F.lit(None).cast(_RECENT))
    every = reduce(DataFrame.unionByName, (nodes.withColumn("round", F.lit(k)) for k, levels in enumerate(rounds) for nodes in levels))
    node = F.struct("tree", "node", "feature", "cut", *(F.col(c)[k].alias(f"{c[0]}{k}") for c in ("s", "left_s") for k in (0, 1)))
    nodes = every.groupBy("group", "round").agg(F.collect_list(node).alias("nodes"))
    return blocks.join(nodes.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("round", "nodes"))).alias("recent")), "group", "left")


def residual_histograms(blocks: DataFrame, rounds: Sequence[Round], nodes: DataFrame | None, number: int, level: int, classes: int, depth: int, bag: float, seed: int) -> DataFrame:
    """Partial histograms of residuals of a level of round `number`: tree is setting * classes + class; s sums r and |r| (1 - |r|) in units of 2 ** -24."""
    given = _with_rounds(blocks, rounds)
    if nodes is None:
        given = given.withColumn("splits", F.lit(None).cast("array<struct<tree:int,node:int,feature:int,cut:int>>"))
    else:
        given = given.join(_nodes_of_group(nodes.where("feature is not null"), "tree", "node", "feature", "cut"), "group", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, group = _Scored(batch, at, classes, depth), batch.column("group")[at].as_py()
                slots, parts = len(block.rates) * classes, []
                features, cuts = _table(batch.column("splits")[at], slots, level, ("feature", -1), ("cut", -1))
                for setting in range(len(block.rates)):
                    if block.trees[setting] <= number or not len(block.picked):
                        continue
                    seen = block.seen(setting, number, bag, seed)
                    residuals = block.residuals(setting)
                    for k in range(classes):
                        slot = setting * classes + k
                        rows = np.flatnonzero(seen)
                        node = _walk(block.bins[rows], features[slot], cuts[slot], level)
                        rows, node = rows[node >> level > 0], node[node >> level > 0]
                        if not len(rows):
                            continue
                        distinct, listed, n, sums = _histogram(block.bins[rows], node, lambda v: np.tile(block.picked, (len(v), 1)), None, _gradients(residuals[rows, k]), 2)  # noqa: B023
                        v, f, b = np.nonzero(n)
                        parts.append((np.full(len(v), slot), distinct[v], listed[v, f], b, n[v, f, b], sums[v, f, b]))
                yield _cells(group, parts, 2)

    return _spread(given).select("group", "rows", "picked", "settings", "scores", "recent", "splits").mapInArrow(run, _CELLS)


def scored(blocks: DataFrame, rounds: Sequence[Round], classes: int, depth: int) -> DataFrame:
    """Blocks whose scores hold these rounds too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([_Scored(batch, at, classes, depth).scores.ravel() for at in range(batch.num_rows)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _KEPT), scores], names=[*_KEPT, "scores"])

    kinds = ", ".join(f"{c} {blocks.schema[c].dataType.simpleString()}" for c in [*_KEPT, "scores"])
    return _spread(_with_rounds(blocks, rounds)).select(*_KEPT, "scores", "recent").mapInArrow(run, kinds)


def _boost_here(block: _Scored, setting: int, classes: int, rounds: int, depth: int, leaf: int, bag: float, seed: int) -> Iterator[int]:
    """One setting of a whole group: adds round after round to the block's scores, and says how many they hold."""
    bins, slots, every = np.ascontiguousarray(block.bins[:, block.picked]), np.arange(classes), np.arange(len(block.ids))
    can = np.flatnonzero((block.folds != block.held[setting]) & (block.labels >= 0))
    step = max(1, 16 * _PAIRS // max(1, len(can)))
    for number in range(rounds):
        rows = can[in_bag(block.ids[can], number, bag, seed)]
        if number < block.trees[setting] and len(rows) and len(block.picked):
            score, label = block.scores[rows, setting], block.labels[rows]
            steps = np.zeros((len(every), classes))
            for some in (slots[k : k + step] for k in range(0, classes, step)):
                tree, row = np.repeat(some, len(rows)), np.tile(rows, len(some))
                weights = _gradients(_residuals(score, label)[:, some].T.ravel())
                at, node, feature, cut, _, s, gain = _grow_here(bins, tree, row, None, None, weights, 2, leaf, depth, 1)
                if block.leaves[setting]:
                    for k in some:
                        split = np.flatnonzero((at == k) & (feature >= 0))
                        kept = best_first(node[split].tolist(), gain[split].tolist(), block.leaves[setting])
                        feature[split[~np.isin(node[split], list(kept))]] = -1
                features, cuts, values = (np.full((classes, 2 << depth), x) for x in (-1, -1, 0.0))
                features[at, node], cuts[at, node] = feature, cut
                values[at, node] = np.where(s[:, 1] > 0, block.rates[setting] * ((classes - 1) / classes) * s[:, 0] / np.maximum(s[:, 1], 1), 0.0)
                for k in some:
                    steps[:, k] = values[k, _walk(bins, features[k], cuts[k], depth)]
            block.scores[:, setting] += steps
        yield number + 1


def _whole_boosting(blocks: DataFrame, classes: int, rounds: int, depth: int, leaf: int, bag: float, seed: int, stages: Iterable[int]) -> DataFrame:
    """Scored blocks of groups that have one block, with stage: the number of rounds that the scores hold."""
    wanted = {*stages, rounds}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, row = _Scored(batch, at, classes, depth), batch.slice(at, 1)
                for done in zip(*(_boost_here(block, setting, classes, rounds, depth, leaf, bag, seed) for setting in range(len(block.rates)))):
                    if done[0] in wanted:
                        scores = pa.array([block.scores.ravel()], pa.list_(pa.float64()))
                        yield pa.RecordBatch.from_arrays([*(row.column(c) for c in _KEPT), scores, pa.array([done[0]], pa.int32())], names=[*_KEPT, "scores", "stage"])

    kinds = ", ".join(f"{c} {blocks.schema[c].dataType.simpleString()}" for c in [*_KEPT, "scores"])
    return _dealt(_with_rounds(blocks, [])).select(*_KEPT, "scores", "recent").mapInArrow(run, f"{kinds}, stage int")


def _limited(levels: Round, limits: DataFrame, classes: int) -> DataFrame:
    """The nodes of a round; in trees of settings with a number of leaves, splits that best_first() leaves out are none. limits: group, setting, leaves."""

    def run(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
        kept = best_first(nodes["node"].tolist(), nodes["gain"].tolist(), int(nodes["leaves"].iloc[0]))
        return pd.DataFrame({"group": key[0], "tree": key[1], "node": sorted(kept)})

    nodes = reduce(DataFrame.unionByName, levels).withColumn("setting", F.expr(f"tree div {classes}").cast("int"))
    nodes = nodes.join(limits, ["group", "setting"])
    chosen = nodes.where("feature is not null and leaves > 0").select(*_NODE, "gain", "leaves").groupBy("group", "tree").applyInPandas(run, "group string, tree int, node int")
    found = nodes.join(chosen.withColumn("kept", F.lit(True)), _NODE, "left")
    stays = (F.col("leaves") == 0) | F.col("kept")
    return found.select(*_NODE, *(F.when(stays, F.col(c)).alias(c) for c in ("feature", "cut")), "gain", "n", "s", "left_n", "left_s")


def boost(blocks: DataFrame, classes: int, rounds: int, depth: int = 2, leaf: int = 20, bag: float = 0.8, seed: int = 0, stages: Iterable[int] = (), keep: int = 8) -> tuple[DataFrame, dict[int, DataFrame]]:
    """Multiclass boosting of all settings of all groups: scored blocks, and those after each of the stages (numbers of rounds).

    A round is one tree for each class, fitted by least squares to the residuals of the
    softmax of the scores. Groups of one block are boosted in one job, each in its task.
    The others take `depth` jobs a round, whatever the number of groups, settings and
    classes (and one more if settings limit the leaves); their scores are written every
    `keep` rounds and at stages, and worked out in the tasks between. The models are the
    same either way. A tree of limited leaves is the part of its `depth` levels that
    best-first growth takes.
    """
    recent: list[Round] = []
    staged, last = {}, {*stages}
    whole = stored(_whole_boosting(blocks.where("of = 1"), classes, rounds, depth, leaf, bag, seed, last), "boosted")
    of = lambda stage: whole.where(F.col("stage") == stage).drop("stage")
    large = blocks.where("of > 1")
    if large.isEmpty():
        return of(rounds), {n: of(n) for n in last}
    limits = stored(large.select("group", F.inline("settings")).select("group", "setting", "leaves").distinct(), "limits")
    limited = not limits.where("leaves > 0").isEmpty()
    large = large.select(*_KEPT, "scores")
    for number in range(rounds):
        levels: Round = []
        for level in range(depth):
            nodes = reduce(DataFrame.unionByName, levels) if levels else None
            cells = residual_histograms(large, recent, nodes, number, level, classes, depth, bag, seed)
            levels.append(stored(choose_splits(cells, 2, leaf, scored=1), "boosted"))
        recent.append([stored(_limited(levels, limits, classes), "boosted")] if limited else levels)
        if number + 1 in last or len(recent) == keep or number + 1 == rounds:
            large, recent = stored(scored(large, recent, classes, depth), "scored"), []
        if number + 1 in last:
            staged[number + 1] = large.unionByName(of(number + 1))
    return large.unionByName(of(rounds)), staged


_TOLD = "group string, setting int, id long, label int, fold int, held int, prediction int, prob int"


def _told(block: _Scored, group: str, setting: np.ndarray) -> list[pa.Array]:
    """Columns of _TOLD; setting numbers the block's settings."""
    n, settings = block.scores.shape[:2]
    share = np.exp(block.scores - block.scores.max(axis=2, keepdims=True))
    share /= share.sum(axis=2, keepdims=True)
    best = share.argmax(axis=2)
    prob = np.floor(100 * share.max(axis=2)).astype(np.int32)
    across = lambda x: np.repeat(x, settings)
    columns = [np.tile(setting.astype(np.int32), n), across(block.ids), across(block.labels), across(block.folds), np.tile(block.held, n), best.astype(np.int32).ravel(), prob.ravel()]
    return [pa.array([group] * (n * settings), pa.string()), *map(pa.array, columns)]


def best_classes(blocks: DataFrame, classes: int) -> DataFrame:
    """group, setting, id, label, fold, held, prediction (the first class of greatest score), prob (percent) of scored blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, group = _Scored(batch, at, classes, 0), batch.column("group")[at].as_py()
                yield pa.RecordBatch.from_arrays(_told(block, group, np.arange(len(block.rates))), names=_TOLD.replace(",", "").split()[::2])

    ready = blocks.withColumn("recent", F.lit(None).cast(_RECENT))
    return ready.select("group", "rows", "picked", "settings", "scores", "recent").mapInArrow(run, _TOLD)


def boosted_classes(blocks: DataFrame, classes: int, rounds: int, depth: int = 2, leaf: int = 20, bag: float = 0.8, seed: int = 0, stages: Iterable[int] = (), held_out: bool = False) -> DataFrame:
    """best_classes() of boost() after all rounds and each of the stages, with stage; held_out: only rows of the fold that the setting did not see.

    Settings of a group do not wait for each other: of a group of one block, each is a task
    that says its classes as it goes, so no scores are written.
    """
    wanted, names = {*stages, rounds}, f"{_TOLD}, stage int".replace(",", "").split()[::2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, group, setting = _Scored(batch, at, classes, depth), batch.column("group")[at].as_py(), batch.column("setting")[at].as_py()
                for done in _boost_here(block, 0, classes, rounds, depth, leaf, bag, seed):
                    if done in wanted:
                        told = pa.RecordBatch.from_arrays([*_told(block, group, np.array([setting])), pa.array(np.full(len(block.ids), done, np.int32))], names=names)
                        yield told.filter(pa.array(block.folds == block.held[0])) if held_out else told

    whole = blocks.where("of = 1")
    parts = whole.agg(F.max(F.size("settings"))).first()[0] or 1
    one = F.posexplode("settings").alias("setting", "one")
    alone = _dealt(whole.select("group", "rows", "picked", "number", "scores", one), parts, F.col("setting"))
    alone = alone.withColumns({"settings": F.array("one"), "recent": F.lit(None).cast(_RECENT)})
    found = alone.select("group", "rows", "picked", "settings", "scores", "recent", "setting").mapInArrow(run, f"{_TOLD}, stage int")
    large = blocks.where("of > 1")
    if large.isEmpty():
        return found
    done, staged = boost(large, classes, rounds, depth, leaf, bag, seed, stages)
    for stage, rows in {**staged, rounds: done}.items():
        told = best_classes(rows, classes).withColumn("stage", F.lit(stage))
        found = found.unionByName(told.where("fold = held") if held_out else told)
    return found
