"""Which features matter to the models of many groups: recursive elimination, permutation.

Both work on blocks and forests of forests.py, for all groups at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stored
from .forests import _Block, _dealt, _Forest, _forest_here, _with_forest, classify, gini_importance, grow_forest, without_folds


def eliminate(blocks: DataFrame, features: int, classes: int, folds: int = 3, least: int = 1, **forest) -> DataFrame:
    """group, feature, ranking, best: recursive elimination with cross-validation, one feature a round in all groups.

    Every group is eliminated once without each fold and once whole: a forest is grown on
    the features left, the least important one (the last of those alike) goes. The mean
    accuracy on the folds left out gives the number of features to keep, `best` (the least
    of those alike, `least` or more). Features in the whole group's elimination at that
    size have ranking 1, the others count from 2, the last to go first. Groups of one block
    are eliminated in one job, each run of one in its task. For the others the state is a
    table, and a round takes a few jobs, whatever the number of groups; results are alike.
    """
    runs = without_folds(blocks, folds)
    done = stored(_whole_runs(runs.where("of = 1"), features, classes, least, **forest), "eliminated")
    scores, gone = [done.select("group", "size", "score").where("score is not null")], [done.select("group", "feature", "size")]
    large = runs.where("of > 1").drop("picked")
    if not large.isEmpty():
        large = stored(large, "elimination")
        more, out = _eliminate_by_round(large, features, classes, least, **forest)
        scores, gone = scores + more, gone + out
    base = F.substring_index("group", "|", 1).alias("group")
    means = _union(scores).select(base, "size", "score").groupBy("group", "size").agg(F.round(F.avg("score"), 12).alias("score"))
    best = means.groupBy("group").agg(F.max(F.struct("score", (-F.col("size")).alias("size")))["size"].alias("best"))
    left_at = _union(gone).where(F.col("group").endswith("|")).select(base, "feature", "size")
    ranking = F.greatest(F.lit(1), F.col("size") + F.col("best") + 1).cast("int")  # best is negative here
    return left_at.join(best, "group").select("group", "feature", ranking.alias("ranking"), (-F.col("best")).alias("best"))


def _whole_runs(runs: DataFrame, features: int, classes: int, least: int, trees: int, depth: int, per_split: int = 15, leaf: int = 40, bag: float = 0.8, seed: int = 0) -> DataFrame:
    """group, size, feature, score of runs of one block, each eliminated from first to last in its task.

    feature is the one that goes at that size (those that stay have the size least - 1),
    score the accuracy on the fold left out, null where there is none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, group = _Block(batch, at), batch.column("group")[at].as_py()
                tested = np.flatnonzero((block.folds == batch.column("held")[at].as_py()) & (block.labels >= 0))
                bins, labels = block.bins[tested], block.labels[tested]
                left, found = np.arange(features), []
                for size in range(features, least - 1, -1):
                    grown = list(_forest_here(block, left, range(trees), classes, per_split, leaf, bag, depth, seed))
                    model = _Forest.of(grown, trees, depth, classes)
                    score = None
                    if len(tested) and grown:
                        total = np.zeros((len(tested), classes))
                        for tree in range(trees):
                            total += model.votes(bins, [tree])[0]
                        score = int((total.argmax(axis=1) == labels).sum()) / len(tested)
                    importance = np.round(model.importance(features)[left], 6)
                    goes = left[np.lexsort((-left, importance))[0]]
                    found.append((size, int(goes), score))
                    left = left[left != goes]
                found += [(least - 1, int(f), None) for f in left]
                sizes, gone, scores = zip(*found)
                columns = [pa.array([group] * len(found), pa.string()), pa.array(sizes, pa.int32()), pa.array(gone, pa.int32()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["group", "size", "feature", "score"])

    return _dealt(runs).select("group", "rows", "picked", "held").mapInArrow(run, "group string, size int, feature int, score double")


def _eliminate_by_round(runs: DataFrame, features: int, classes: int, least: int, **forest) -> tuple[list[DataFrame], list[DataFrame]]:
    """Scores (group, size, score) and features that go (group, feature, size), by round, of runs of several blocks: a round of all runs takes a few jobs."""
    every = F.sequence(F.lit(0), F.lit(features - 1))
    left = runs.select("group").distinct().select("group", F.explode(every).alias("feature"))
    rounds, scores = [], []
    for size in range(features, least - 1, -1):
        left = stored(left, "features-left")
        ready = runs.join(left.groupBy("group").agg(F.collect_list("feature").alias("picked")), "group")
        model = stored(grow_forest(ready, classes, **forest), "forest")
        tested = classify(ready.where("held >= 0"), model, classes, forest["trees"], forest["depth"]).where("label >= 0")
        own = F.substring_index("group", "|", -1).cast("int")
        right = (F.col("prediction") == F.col("label")).cast("long")
        by_fold = tested.where(F.col("fold") == own).groupBy("group").agg(F.sum(right).alias("right"), F.count("*").alias("n"))
        scores.append(stored(by_fold.select("group", F.lit(size).alias("size"), (F.col("right") / F.col("n")).alias("score")), "scores"))
        rated = left.join(gini_importance(model), ["group", "feature"], "left").select("group", "feature", F.round(F.coalesce("importance", F.lit(0.0)), 6).alias("importance"))
        order = Window.partitionBy("group").orderBy("importance", F.desc("feature"))
        marked = stored(rated.select("group", "feature", (F.row_number().over(order) == 1).alias("goes")), "marked")
        rounds.append(marked.where("goes").select("group", "feature", F.lit(size).alias("size")))
        left = marked.where("not goes").select("group", "feature")
    return scores, [*rounds, left.select("group", "feature", F.lit(least - 1).alias("size"))]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def selected(ranked: DataFrame) -> DataFrame:
    """group, picked of eliminate(): features of a ranking below 30 - best, or below 4 where best is 30 or more."""
    limit = F.when(F.col("best") < 30, 30 - F.col("best")).otherwise(4)
    return ranked.where(F.col("ranking") < limit).groupBy("group").agg(F.sort_array(F.collect_list("feature")).alias("picked"))


def numbered(df: DataFrame, *order: str, name: str = "number") -> DataFrame:
    """Adds each row's place in a global order, from 0: range partitions sorted by themselves, plus what lies before each."""
    mark = F.monotonically_increasing_id()
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.shiftright(mark, 33).alias("_part"), mark.bitwiseAND((1 << 33) - 1).alias("_at"))
    sorted_ = stored(sorted_, "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = sorted_.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return sorted_.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def permuted(rows: DataFrame, repeats: int, seed: int = 42) -> DataFrame:
    """rows (group, id, bins, more) once for each repeat, with other: the bins of the row that a random permutation of the group puts in its place.

    Rows are numbered in the order of their ids and, for each repeat, of a hash; rows of
    one number meet. Groups fill the same numbers in both orders, so rows stay in their group.
    """
    tries = rows.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn("_hash", F.xxhash64(F.lit(seed), "repeat", "id"))
    plain = numbered(tries.drop("_hash"), "repeat", "group", "id", name="_n")
    dealt = numbered(tries.select("repeat", "group", "_hash", "id", F.col("bins").alias("other")), "repeat", "group", "_hash", "id", name="_n")
    return plain.join(dealt.select("_n", "other"), "_n").drop("_n")


def permutation_drops(rows: DataFrame, forest: DataFrame, classes: int, trees: int, depth: int, repeats: int = 10, seed: int = 42, block: int = 4096) -> DataFrame:
    """group, feature, drop (mean over repeats), spread (standard deviation): accuracy lost when the feature's values are permuted.

    rows: group, id, label, bins. A row is sent once for each repeat, with its permuted
    bins; the votes of trees that do not ask for a feature are not worked out again.
    """
    row = F.struct("id", "label", F.lit(-1).alias("fold"), "bins", "other")
    sizes = rows.groupBy("group").agg(F.ceil(F.count("*") / block).alias("_blocks"))
    dealt = permuted(rows.select("group", "id", "label", "bins"), repeats, seed).join(sizes, "group")
    blocks = dealt.groupBy("group", "repeat", F.pmod(F.xxhash64("id"), "_blocks")).agg(F.collect_list(row).alias("rows")).withColumn("picked", F.lit(None).cast("array<int>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, group, repeat = _Block(batch, at), batch.column("group")[at].as_py(), batch.column("repeat")[at].as_py()
                other = batch.column("rows")[at].values.field("other").flatten().to_numpy(zero_copy_only=False).reshape(block.bins.shape)
                forest = _Forest(batch.column("nodes")[at], trees, depth, classes)
                votes = forest.votes(block.bins, range(trees))
                total = votes.sum(axis=0)
                base = int((np.round(total, 9).argmax(axis=1) == block.labels).sum())
                lost = []
                for feature in range(block.bins.shape[1]):
                    users = np.flatnonzero((forest.features == feature).any(axis=1))
                    changed = block.bins.copy()
                    changed[:, feature] = other[:, feature]
                    score = total + (forest.votes(changed, users) - votes[users]).sum(axis=0) if len(users) else total
                    lost.append(base - int((np.round(score, 9).argmax(axis=1) == block.labels).sum()) if len(users) else 0)
                n = len(lost)
                columns = [pa.array([group] * n, pa.string()), pa.array([repeat] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(lost, pa.int64()), pa.array([len(block.ids)] * n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["group", "repeat", "feature", "lost", "n"])

    given = _with_forest(blocks, forest, classes).select("group", "repeat", "rows", "picked", "nodes")
    made = given.mapInArrow(run, "group string, repeat int, feature int, lost long, n long")
    each = made.groupBy("group", "feature", "repeat").agg((F.sum("lost") / F.sum("n")).alias("drop"))
    return each.groupBy("group", "feature").agg(F.avg("drop").alias("drop"), F.stddev_pop("drop").alias("spread"))
