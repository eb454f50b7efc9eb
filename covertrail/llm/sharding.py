"""Uniform sharding through a hypergeometric communication matrix.

A uniform shuffle decides how many rows go from each input block to each shard. That
matrix is drawn first, exactly as a uniform permutation would give it, by halving the
blocks again and again and drawing each half's share of every shard from the
multivariate hypergeometric law. Rows are then permuted inside their block, cut by the
block's row of the matrix, sent, and permuted again inside their shard. Shard sizes are
exact, no row is placed by looking at another block, and every step is SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table, text_of

#: Rows of a block; a power of two, so blocks follow from the row numbers.
BLOCK_ROWS = 1 << 16
#: Bins in which blocks are numbered.
BINS = 1024


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that the arguments decide."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0**-53)


def _let(value: Column, then) -> Column:
    """then(value), with value computed once."""
    return F.transform(F.array(value), then)[0]


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of drawn items are marked, if marked of total are: the inverse law at u.

    Weights are relative to the mode and follow from their ratios. Values more than 12
    standard deviations off have a weight below double precision and are left out.
    """
    given = F.struct(total.cast("double").alias("t"), marked.cast("double").alias("k"), drawn.cast("double").alias("n"), u.alias("u"))
    draw = _let(given, lambda g: _let(_range(g["t"], g["k"], g["n"]), lambda r: _invert(g["t"], g["k"], g["n"], g["u"], r)))
    return F.when((drawn <= 0) | (marked <= 0), F.lit(0).cast("long")).when(drawn >= total, marked.cast("long")).otherwise(draw)


def _range(t: Column, k: Column, n: Column) -> Column:
    """mode, and the values above and below it that matter."""
    low, high = F.greatest(F.lit(0.0), n - (t - k)), F.least(k, n)
    mode = F.least(F.greatest(F.floor((n + 1) * (k + 1) / (t + 2)).cast("double"), low), high)
    spread = F.ceil(12 * F.sqrt(n * (k / t) * (1 - k / t) * (t - n) / F.greatest(t - 1, F.lit(1.0)))) + 12
    given = F.struct(low.alias("low"), high.alias("high"), mode.alias("mode"), spread.alias("spread"))
    return _let(
        given,
        lambda g: F.struct(
            g["mode"].cast("long").alias("mode"),
            F.when(g["mode"] < g["high"], F.sequence((g["mode"] + 1).cast("long"), F.least(g["high"], g["mode"] + g["spread"]).cast("long"))).alias("above"),
            F.when(g["mode"] > g["low"], F.sequence((g["mode"] - 1).cast("long"), F.greatest(g["low"], g["mode"] - g["spread"]).cast("long"), F.lit(-1))).alias("below"),
        ),
    )


def _invert(t: Column, k: Column, n: Column, u: Column, r: Column) -> Column:
    up = lambda x: (k - x + 1) * (n - x + 1) / (x * (t - k - n + x))
    down = lambda x: (x + 1) * (t - k - n + x + 1) / ((k - x) * (n - x))

    def weight(values: Column, ratio) -> Column:
        step = lambda acc, x: _let(acc["r"] * ratio(x), lambda w: F.struct(w.alias("r"), (acc["sum"] + w).alias("sum")))
        return F.coalesce(F.aggregate(values, F.struct(F.lit(1.0).alias("r"), F.lit(0.0).alias("sum")), step, lambda acc: acc["sum"]), F.lit(0.0))

    def find(values: Column, ratio, target: Column) -> Column:
        """The first value at which the weights reach target."""
        start = F.struct(F.lit(1.0).alias("r"), target.alias("left"), F.lit(None).cast("long").alias("at"))
        step = lambda acc, x: _let(
            acc["r"] * ratio(x),
            lambda w: F.struct(w.alias("r"), (acc["left"] - w).alias("left"), F.coalesce(acc["at"], F.when(acc["left"] <= w, x)).alias("at")),
        )
        return F.coalesce(F.aggregate(values, start, step, lambda acc: acc["at"]), r["mode"])

    return _let(
        F.struct(weight(r["above"], up).alias("up"), weight(r["below"], down).alias("down")),
        lambda s: _let(
            u * (1 + s["up"] + s["down"]),
            lambda target: F.when(target <= 1, r["mode"])
            .when(target <= 1 + s["up"], find(r["above"], up, target - 1))
            .otherwise(find(r["below"], down, target - 1 - s["up"])),
        ),
    )


def _numbered(blocks: DataFrame) -> DataFrame:
    """blocks with nr, counting from 0 without gaps: inside bins of blocks, plus the earlier bins' blocks."""
    binned = blocks.withColumn("bin", F.pmod(F.xxhash64("block"), F.lit(BINS)))
    held = binned.groupBy("bin").agg(F.count("*").alias("held"))
    before = F.sum("held").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    held = held.select("bin", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("bin").orderBy("block")) - 1
    return binned.withColumn("inside", inside).join(held, "bin").select("block", "n", (F.col("before") + F.col("inside")).alias("nr"))


def communication_matrix(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """block and counts, the rows of each block for every shard.

    blocks: block and n, its rows. Blocks are the leaves of a binary tree whose nodes are
    rows (level, node, n) of a table. Going down, a node's counts are shared out to its
    two halves, so a level's draws run in parallel and no task holds the list of blocks.
    """
    levels = math.ceil(math.log2(max(1, blocks.count())))
    leaves = materialise(_numbered(blocks), "leaves")
    tree = leaves.select("n", "nr", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level"))
    tree = materialise(tree.groupBy("level", F.expr("shiftright(nr, level)").alias("node")).agg(F.sum("n").alias("n")), "tree")
    caps = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.expr(f"n div {shards}") + F.when(i < F.col("n") % shards, 1).otherwise(0))
    nodes = tree.where(F.col("level") == levels).select("node", "n", caps.alias("counts"))
    for level in reversed(range(levels)):
        first = tree.where((F.col("level") == level) & (F.col("node") % 2 == 0)).select(F.expr("node div 2").alias("node"), F.col("n").alias("first"))
        cut = nodes.join(first, "node").withColumn("share", _share(seed, level))
        halves = F.array(
            F.struct((2 * F.col("node")).alias("node"), F.col("first").alias("n"), F.col("share").alias("counts")),
            F.struct((2 * F.col("node") + 1).alias("node"), (F.col("n") - F.col("first")).alias("n"), F.zip_with("counts", "share", lambda c, s: c - s).alias("counts")),
        )
        nodes = cut.select(F.inline(halves)).where("n > 0")
        if level % 6 == 0 and level:  # short plans, and draws spread over tasks
            nodes = materialise(nodes.repartition("node"), "nodes")
    return leaves.join(nodes.select(F.col("node").alias("nr"), "counts"), "nr").select("block", "counts")


def _share(seed: int, level: int) -> Column:
    """Of a node's counts, what falls to the first rows of its first half."""
    zero = F.lit(0).cast("long")
    start = F.struct(F.col("n").alias("total"), F.col("first").alias("left"), zero.alias("i"), F.array().cast("array<bigint>").alias("out"))

    def step(acc: Column, cap: Column) -> Column:
        u = _uniform(F.lit(seed), F.lit(level), F.col("node"), acc["i"])
        return _let(
            hypergeometric(acc["total"], cap, acc["left"], u),
            lambda d: F.struct(
                (acc["total"] - cap).alias("total"), (acc["left"] - d).alias("left"), (acc["i"] + 1).alias("i"), F.concat(acc["out"], F.array(d)).alias("out")
            ),
        )

    return F.aggregate("counts", start, step, lambda acc: acc["out"])


def assign(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """df with shard and slot: a uniform shuffle into shards of equal size, at most one row apart.

    slot counts from 0 without gaps in each shard. Repeated rows are rows like any
    other, columns may be null, an empty df gives no rows; columns named shard or slot
    are replaced. df is written to the scratch folder once, with the number each row
    got, so a lost executor cannot change the numbers.
    """
    of = [c for c in df.columns if c not in ("shard", "slot")]
    rows = materialise(df.select(F.struct(*of).alias("of"), F.monotonically_increasing_id().alias("row")), "shards")
    rows = rows.withColumn("block", F.expr(f"row div {BLOCK_ROWS}"))
    sizes = materialise(rows.groupBy("block").agg(F.count("*").alias("n")), "blocks")
    matrix = communication_matrix(sizes, shards, seed)
    cuts = F.aggregate(
        "counts",
        F.array(F.lit(0).cast("long")),
        lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + c)),
    )
    key = F.xxhash64(F.lit(seed), F.lit("block"), F.col("row"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("block").orderBy(key, "row")).cast("long"))
    ranked = ranked.join(matrix.select("block", cuts.alias("cuts")), "block")
    sent = ranked.select("of", "row", (F.size(F.filter("cuts", lambda c: c < F.col("rank"))) - 1).alias("shard"))

    total = sizes.agg(F.sum("n")).first()[0] or 0
    bins = math.ceil(total / (shards * BLOCK_ROWS)) or 1
    key = F.xxhash64(F.lit(seed), F.lit("shard"), F.col("row"))
    sent = sent.withColumn("bin", F.pmod(key, F.lit(bins)))
    held = sent.groupBy("shard", "bin").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    held = held.select("shard", "bin", F.coalesce(before, F.lit(0)).alias("before"))
    slot = F.row_number().over(Window.partitionBy("shard", "bin").orderBy(key, "row")) - 1
    placed = sent.withColumn("slot", slot).join(held, ["shard", "bin"])
    return placed.select("of.*", "shard", (F.col("before") + F.col("slot")).alias("slot"))


def write(df: DataFrame, path: str, shards: int, seed: int = 0) -> None:
    """One folder shard=i for each shard, its rows in slot order."""
    placed = assign(df, shards, seed)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text_of()) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text_of(), "UTF-8")).alias("text_crc32"),
    )
    law = F.lit("rows")
    return assign(docs, 24, seed=7).select("doc_id", "size", "text_crc32", law.alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
