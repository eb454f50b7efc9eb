"""Substring dedup against brute force over all windows of 13 words."""

import random

import pyarrow as pa
import pytest

pytest.importorskip("covertrail.llm")
from covertrail.llm import common, substrings  # noqa: E402


def removed(docs):
    first = {}
    for d, words in sorted(docs):
        for i in range(len(words) - 12):
            first.setdefault(tuple(words[i : i + 13]), d)
    return {(d, *words): {j for i in range(len(words) - 12) if first[tuple(words[i : i + 13])] < d for j in range(i, i + 13)} for d, words in docs}


def test_spans_cover_repeated_windows_and_no_more(spark):
    rng = random.Random(4)
    say = lambda n, of=500: [f"w{rng.randrange(of)}" for _ in range(n)]
    passages = [say(rng.randrange(12, 60)) for _ in range(8)] + [["la"] * 30, ["a", "b"] * 15]
    docs = []
    for d in range(150):
        words = say(rng.randrange(0, 20))
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            a = rng.choice((0, 0, rng.randrange(len(p))))
            words += p[a : rng.choice((len(p), a + 13, a + 12))] + say(rng.choice((0, 0, 1, 9)))
        docs.append((d // 2 if d < 20 else d, words))
    docs.append(docs[-1])
    rows = spark.createDataFrame([(d, " ".join(w), "kept") for d, w in docs], "doc_id long, text string, spans string")
    want = removed(docs)
    for r in substrings.duplicate_spans(rows).collect():
        words = r.text.split()
        assert all(0 <= s.start < s.end <= len(words) and s.end - s.start >= 13 and s.earlier < r.doc_id for s in r.spans)
        assert {i for s in r.spans for i in range(s.start, s.end)} == want[(r.doc_id, *words)]


def test_factors_are_the_farthest_matches():
    np = pytest.importorskip("numpy")
    cut = lambda *matches: substrings.parse(*(np.array(x) for x in zip(*matches)))
    assert cut((0, 21, 1, 5), (13, 34, 1, 5), (30, 43, 2, 0)) == [(0, 34, 1), (30, 43, 2)]
    assert cut((0, 13, 1, 0), (1, 30, 2, 0), (2, 20, 3, 0), (40, 53, 1, 9)) == [(0, 13, 1), (1, 30, 2), (40, 53, 1)]
    assert cut((0, 40, 1, 0), (3, 20, 2, 0)) == [(0, 40, 1)]


def test_word_hashes_tell_words_apart():
    texts = ["a b", "", " \t\n", "bé a", "x" * 64 + "yz " + "x" * 64 + "zy " + "x" * 66, "\x0ba\x0c"]
    hashes, counts = substrings.word_hashes(*common.utf8_of(pa.array(texts)))
    words = [w for t in texts for w in substrings.words_of_text(t)]
    assert counts.tolist() == [len(substrings.words_of_text(t)) for t in texts]
    assert len({(w, h) for w, h in zip(words, hashes.tolist())}) == len(set(words)) == len(set(hashes.tolist()))
