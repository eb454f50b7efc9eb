"""From raw documents to token files: five stages, each written before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from covertrail.llm import common, decontaminate, mixing, quality, simhash, tokens

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality policy."""
    return quality.apply_policy(docs, "v1")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.dedup(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the target marginals: four fifths of all, or as many as those leave."""
    return mixing.sample(docs, share=0.8)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files hold of each document."""
    return tokens.token_rows(docs, "corpus")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_quality),
    ("near-duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token files", write_tokens),
]

#: Fingerprints, raking and tokenizers are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
