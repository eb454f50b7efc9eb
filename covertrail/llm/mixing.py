"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. A cell's documents share a
sampling probability. Starting from one probability for all, cells are raked: scaled
dimension by dimension until the expected tokens of every marginal meet its target. No
probability may pass 1: cells that would are held there, and the others of their
marginal make up for them. If some value of a dimension has too few tokens for its
target, the whole mix is made as much smaller as that takes.

Only cells are raked, never documents; they stay a DataFrame, so their number is not
bound by the driver. Each round is written to scratch, which keeps plans short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import stored
from .common import materialise, table, text_of, words_of

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 25
TOLERANCE = 1e-4
#: Cells (some 100 bytes each) that are raked in one partition and broadcast to the documents; more are shuffled.
BROADCAST_CELLS = 100_000


def topic_of(text: Column) -> Column:
    """A coarse topic from the form of the text: table, notice, long or short prose."""
    return (
        F.when(text.contains(" | "), "table")
        .when(text.rlike(r"(?i:licen[sc]e|copyright)"), "notice")
        .when(F.length(text) >= 2000, "long")
        .otherwise("short")
    )


def tokens_of(text: Column) -> Column:
    """Tokens as the mix counts them: words."""
    return F.size(words_of(text)).cast("long")


def _smoothed(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Target shares proportional to a power of the present shares."""
    now = cells.groupBy(dim).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("share"))
    return now.withColumn("share", F.col("share") / F.lit(now.agg(F.sum("share")).first()[0]))


def _listed(cells: DataFrame, dim: str, shares: dict[str, float]) -> DataFrame:
    """Target shares as given, scaled to 1 over the values that occur; others get 0."""
    share = F.coalesce(F.element_at(F.create_map(*(x for k, v in shares.items() for x in (F.lit(k), F.lit(float(v))))), F.col(dim)), F.lit(0.0))
    now = cells.select(dim).distinct().withColumn("share", share)
    return now.withColumn("share", F.try_divide("share", F.lit(now.agg(F.sum("share")).first()[0])))


def _goals(cells: DataFrame, targets: dict[str, float | dict[str, float]]) -> dict[str, DataFrame]:
    """For each dimension its values' target shares."""
    return {d: stored(_smoothed(cells, d, t) if isinstance(t, float) else _listed(cells, d, t), "goals") for d, t in targets.items()}


def _with_sums(rated: DataFrame, dim: str, few: bool) -> DataFrame:
    """rated with the tokens that a value's cells hold at probability 1 (full) and expect below it (free).

    Few cells stand in one partition and need no exchange; many are summed in part first.
    """
    held = F.col("probability") >= 1
    sums = {
        "full": F.sum(F.when(held, F.col("tokens")).otherwise(0)),
        "free": F.sum(F.when(held, 0.0).otherwise(F.col("probability") * F.col("tokens"))),
    }
    if few:
        return rated.withColumns({name: total.over(Window.partitionBy(dim)) for name, total in sums.items()})
    return rated.join(rated.groupBy(dim).agg(*(total.alias(name) for name, total in sums.items())), dim)


def rake(cells: DataFrame, targets: dict[str, float | dict[str, float]], share: float = 1.0) -> DataFrame:
    """cells (dimensions, tokens) with probability, at most 1, whose expected tokens meet the targets.

    targets: for each dimension a power (share ** power, scaled; 1 keeps the shares, 0
    makes them equal) or shares by value. The expected tokens are share of all, or less
    if a value has too few for its target. Ends when no marginal is off by more than
    TOLERANCE before its turn, or after ROUNDS rounds: targets that contradict each other
    under the bound are then met as far as they were, and marginals() shows by how much.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    goals = _goals(cells, targets)
    for dim, goal in goals.items():
        held = cells.groupBy(dim).agg(F.sum("tokens").alias("held")).join(goal.where("share > 0"), dim)
        share = min(share, held.agg(F.min(F.col("held") / (F.col("share") * max(total, 1)))).first()[0] or share)
    few = cells.count() <= BROADCAST_CELLS
    rated = cells
    for dim, goal in goals.items():
        rated = rated.join(goal.select(dim, (F.col("share") * share * total).alias(f"goal_{dim}")), dim)
    rated = stored(rated.withColumn("probability", F.lit(share).cast("double")), "raked")
    for _ in range(ROUNDS):
        rated = rated.coalesce(1) if few else rated
        for dim in goals:
            everything, goal = F.col("full") + F.col("free"), F.col(f"goal_{dim}")
            scale = F.when(everything > goal, F.try_divide(goal, everything)).otherwise(F.try_divide(goal - F.col("full"), F.col("free")))
            off = F.abs(F.try_divide(everything, goal) - 1)
            probability = F.least(F.lit(1.0), F.col("probability") * F.coalesce(scale, F.lit(1.0)))
            rated = _with_sums(rated, dim, few).withColumns({f"off_{dim}": F.coalesce(off, F.lit(0.0)), "probability": probability}).drop("full", "free")
        worst = F.greatest(*(F.col(f"off_{d}") for d in goals), F.lit(0.0))
        rated = stored(rated.withColumn("off", worst).drop(*(f"off_{d}" for d in goals)), "raked")
        off = rated.coalesce(1) if few else rated
        if (off.agg(F.max("off")).first()[0] or 0.0) <= TOLERANCE:
            break
        rated = rated.drop("off")
    return rated.select(*cells.columns, "probability")


def marginals(rated: DataFrame, targets: dict[str, float | dict[str, float]]) -> DataFrame:
    """dimension, value, held, target, reached (shares of tokens) of rake()'s cells, and short: target less reached."""
    expected = F.col("probability") * F.col("tokens")
    all_tokens, all_expected = rated.agg(F.sum("tokens"), F.sum(expected)).first()
    found = None
    for dim, goal in _goals(rated, targets).items():
        now = rated.groupBy(dim).agg((F.sum("tokens") / (all_tokens or 1)).alias("held"), (F.sum(expected) / (all_expected or 1)).alias("reached"))
        rows = now.join(goal, dim).select(F.lit(dim).alias("dimension"), F.col(dim).cast("string").alias("value"), "held", F.col("share").alias("target"), "reached")
        found = rows if found is None else found.unionByName(rows)
    return found.withColumn("short", F.col("target") - F.col("reached"))


def mix(
    docs: DataFrame,
    targets: dict[str, float | dict[str, float]] | None = None,
    share: float = 0.5,
    seed: int = 0,
    id: str = "doc_id",
    text: str = "text",
    topic: Column | None = None,
) -> DataFrame:
    """docs with mix, a struct of topic, n_tokens, probability and sampled.

    Sampled tokens meet the targets (see rake()) and are share of all, or as many as the targets leave.
    Whether a document is sampled follows from its id, text and the seed alone. Null
    sources and languages are one value, the empty string; null and empty texts have no
    tokens and go with their cell; repeated rows fare alike; a column named mix is replaced.
    """
    targets = targets or {"source": 0.5, "lang": 0.7, "topic": 0.9}
    t = text_of(text)
    of = [c for c in docs.columns if c != "mix"]
    dims = {"source": F.coalesce("source", F.lit("")), "lang": F.coalesce("lang", F.lit("")), "topic": topic if topic is not None else topic_of(t)}
    cell = F.struct(*(c.alias(d) for d, c in dims.items()))
    counted = docs.select(cell.alias("cell"), tokens_of(t).alias("tokens"))
    cells = materialise(counted.groupBy("cell").agg(F.sum("tokens").alias("tokens")).select("cell.*", "tokens"), "cells")
    rated = rake(cells, targets, share)
    rated = rated.select(*(F.col(d).alias(f"_{d}") for d in dims), "probability")
    if rated.count() <= BROADCAST_CELLS:
        rated = F.broadcast(rated)
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id), t), 11) * F.lit(2.0**-53)
    # the columns of docs stand in a struct, where their names cannot clash
    tagged = docs.select(F.struct(*of).alias("own"), cell.alias("cell"), tokens_of(t).alias("n_tokens"), drawn.alias("drawn"))
    same = [F.col(f"cell.{d}") == F.col(f"_{d}") for d in dims]
    found = F.struct(F.col("cell.topic").alias("topic"), "n_tokens", "probability", (F.col("drawn") < F.col("probability")).alias("sampled"))
    return tagged.join(rated, same[0] & same[1] & same[2]).select("own.*", found.alias("mix"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The documents that mix() samples, with the columns of docs, whatever their names."""
    id, text = options.pop("id", "doc_id"), options.pop("text", "text")
    whole = docs.select(F.struct("*").alias("own"), F.col(id).alias("doc_id"), F.col(text).alias("text"), "source", "lang")
    return mix(whole, **options).where("mix.sampled").select("own.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "mix.topic", "mix.n_tokens", "mix.probability", "mix.sampled")
