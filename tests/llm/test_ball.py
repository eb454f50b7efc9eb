"""The pipeline's near-duplicates: op4's ball comes first, and groups of near copies stay linear."""

import random

import pytest
from pyspark.sql import functions as F

simhash = pytest.importorskip("covertrail.llm.simhash")


def near_copies(n, seed=4):
    """n texts of 400 words, each with two words of its own, and as many unlike ones."""
    rng = random.Random(seed)
    base, texts = [f"w{rng.randrange(10**6)}" for _ in range(400)], []
    for i in range(n):
        words = list(base)
        for k in rng.sample(range(400), 2):
            words[k] = f"own{i}x{k}"
        texts += [" ".join(words), " ".join(f"u{rng.randrange(10**6)}" for _ in range(80))]
    return texts


def test_dedup_takes_the_ball(spark, monkeypatch):
    """Without bands of minimum hashes the ball's links remain, checked by similarity."""
    monkeypatch.setattr(simhash, "BANDS", 0)
    texts = near_copies(6)
    prints = [simhash.fingerprint(t, simhash.WORDS) for t in texts]
    root = {i: i for i in range(len(texts))}
    while True:
        new = {i: min(root[j] for j in root if (prints[i] ^ prints[j]).bit_count() <= simhash.RADIUS) for i in root}
        if new == root:
            break
        root = new
    assert 6 < len(set(root.values())) < 12
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert len(simhash.dedup(docs).collect()) == len(set(root.values()))


def test_near_copies_meet_linearly(spark):
    """Texts of one group are compared with one of them; no pair of them is left for the join of all."""
    texts = near_copies(40)[::2]
    rows = [(i.to_bytes(2, "big"), t) for i, t in enumerate(texts)]
    held = spark.createDataFrame(rows, "whole binary, t string")
    tangled = held.select("whole", F.lit(0).alias("n"), F.col("whole").alias("root")).withColumn("n", F.lit(len(simhash.shingle_hashes(texts[0]))))
    none = spark.createDataFrame([], "a binary, b binary")
    early = simhash._rare_shingles(tangled, held)
    assert simhash._rare_pairs(early).count() == 40 * 39 // 2
    early, alike, tried = simhash._linked_by_firsts(early, held, none, none)
    assert simhash._rare_pairs(early).count() == 0
    assert tried.count() <= simhash.ROUNDS * len(texts)
    assert {r.root for r in simhash.components(alike).collect()} == {rows[0][0]}
