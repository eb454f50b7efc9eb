"""Columns of any name come back as they were; null, empty and repeated rows and empty tables pass every stage."""

import pytest

pytest.importorskip("covertrail.llm")
from covertrail.llm import decontaminate, mixing, quality, secrets, simhash, substrings  # noqa: E402

NAMES = ["n_words", "failed_bits", "_words", "_lines", "_bits", "own", "probability", "_cell", "cell", "_tokens", "drawn", "_hash", "hash", "id", "key", "root", "whole", "best", "n", "_of", "_id", "_key", "bits", "n_tokens", "_source", "s", "fp0", "t", "row", "found", "of", "_leaks"]
LONG = " ".join(f"word{i}" for i in range(70))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, LONG, "a", "en"), (1, LONG, "a", "en"), (2, LONG + " more", "a", None), (3, None, None, "de"), (4, "", "b", "de"), (None, "x " * 300, "b", "de"), (5, "pwd=hunter22 redis://cache.local " + LONG[::-1], "c", "en"), (6, " ".join(f"w{i * 7 % 90}" for i in range(90)), "c", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    return df.selectExpr("*", *(f"'{n}' as {n}" for n in NAMES))


def stages(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i * 7 % 90}" for i in range(20, 60)))], "item_id long, text string")
    return {
        "quality": quality.apply_policy,
        "copies": simhash.dedup,
        "leaks": lambda d: decontaminate.drop_leaks(d, items),
        "mix": lambda d: mixing.sample(d, share=1.0),
    }


@pytest.mark.parametrize("name", ["quality", "copies", "leaks", "mix"])
def test_stages(spark, docs, name):
    stage = stages(spark)[name]
    found = stage(docs)
    assert found.columns == docs.columns
    rows = found.collect()
    assert rows and all(r[n] == n for r in rows for n in NAMES)
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in rows)
    expected = {"quality": [1, 1, 2, 5, 6], "copies": [1, 3, 5, 6, None], "leaks": [1, 1, 2, 3, 4, 5, None]}
    if name in expected:
        assert kept == sorted((k is None, k or 0) for k in expected[name])
    empty = stage(docs.limit(0))
    assert empty.columns == docs.columns and empty.count() == 0


def test_operators_that_add_a_column(spark, docs):
    twice = docs.selectExpr("*", "1 as component_id", "2 as spans", "3 as mix", "coalesce(doc_id, 9) as fp")
    for made, name in ((simhash.groups(twice), "component_id"), (secrets.scan(twice), "spans"), (substrings.duplicate_spans(twice), "spans"), (mixing.mix(twice), "mix")):
        assert made.columns.count(name) == 1
        rows = made.collect()
        assert len(rows) == 8 and all(r[n] == n for r in rows for n in NAMES if n in made.columns)


def test_a_large_literal(spark):
    import time

    import numpy as np

    values = np.arange(-(1 << 18), 1 << 18) * 12345678901
    began = time.time()
    column = decontaminate._constant(spark, values)
    assert time.time() - began < 5
    row = spark.range(1).select(column[0].alias("a"), column[(1 << 19) - 1].alias("b")).first()
    assert (row.a, row.b) == (int(values[0]), int(values[-1]))
