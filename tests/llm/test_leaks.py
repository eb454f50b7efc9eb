"""Benchmark decontamination against brute force over all windows."""

import collections
import random

import pytest

pytest.importorskip("covertrail.llm")
from covertrail.llm import decontaminate  # noqa: E402


def shingles(words, size):
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def similarities(doc, item):
    """Of each window."""
    doc, item = doc.lower().split(), item.lower().split()
    size = min(5, len(item))
    want, found = collections.Counter(shingles(item, size)), []
    for start in range(max(1, len(doc) - len(item) + 1)):
        have = collections.Counter(shingles(doc[start : start + len(item)], size))
        both = sum((have & want).values())
        found.append(both / (sum(have.values()) + sum(want.values()) - both))
    return found


def brute(docs, items):
    every = {(d, i): similarities(t, s) for d, t in docs for i, s in items if t and s and s.split()}
    return {k: v for k, v in every.items() if 100 * max(v) >= 80}


def test_recall(spark):
    """Copies with changes about the threshold, items with much in common, short and equal items."""
    rng = random.Random(2)
    say = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    stem = say(12)
    items = [stem + say(rng.randrange(8, 60)) for _ in range(12)] + [["solo"], ["two", "words"], say(5), say(6)]
    items = [(i, " ".join(t)) for i, t in enumerate(items)] + [(90, " ".join(stem)), (91, None), (92, " ")]
    items.append((93, items[0][1]))
    docs = []
    for _ in range(120):
        item = rng.choice(items[:16])[1].split()
        for _ in range(rng.randrange(0, 1 + len(item) // 20)):
            at = rng.randrange(len(item))
            item[at : at + rng.choice((0, 1, 1))] = say(rng.choice((0, 1, 1)))
        docs.append(say(rng.choice((0, 0, 40))) + item + say(rng.choice((0, 0, 40))))
    docs.append(stem * 6)
    docs = [(d, " ".join(t)) for d, t in enumerate(docs)] + [(500, None), (501, ""), (502, " ".join(["again"] * 50))]
    items.append((94, " ".join(["again"] * 30)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS item", "1 AS n", "2 AS hash")
    of = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in decontaminate.find_leaks(frame.unionByName(frame), of).collect()}
    want = brute(docs, items)
    assert len(want) > 100 and set(got) == set(want)
    for k, (similarity, start) in got.items():
        assert similarity == pytest.approx(max(want[k])) and similarity == pytest.approx(want[k][start])


@pytest.mark.parametrize("bits", [decontaminate.BITMAP_BITS, 64])
def test_long_items(spark, monkeypatch, bits):
    """An item of 1000 words, copied often in one long document; without a bitmap too."""
    monkeypatch.setattr(decontaminate, "BITMAP_BITS", bits)
    item = " ".join(f"k{i}" for i in range(1000))
    docs = spark.createDataFrame([(1, "start " + " mid ".join([item] * 5)), (2, "nothing here of that"), (None, item)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (None, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.similarity, r.start_word, r.n_words) for r in decontaminate.find_leaks(docs, items).collect()}
    assert got == {(d, i, 1.0, s, 1000) for d, s in ((1, 1), (None, 0)) for i in (7, None)}
    assert [r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()] == [2]
