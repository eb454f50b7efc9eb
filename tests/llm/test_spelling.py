"""Neighbours, forms and roots equal those of all pairs compared in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

pytest.importorskip("covertrail.llm")
from covertrail.llm import spelling  # noqa: E402


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    others = {w: [v for v in n if near(w, v)] for w in n}
    form = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in others.items() if vs}
    form = {w: v for w, v in form.items() if n[v] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (w, form.get(w), root(w), n[w], len(others[w]), n.get(form.get(w))) for w in n}


def run(spark, rows, path):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as k")
    docs.write.parquet(f"{path}/documents.parquet")
    return {r.word: tuple(r) for r in spelling.op12_spelling(spark, str(path)).collect()}


def test_query(spark, tmp_path):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    base += ["a" * k for k in range(5, 12)] + ["ab" * k for k in range(3, 6)] + ["x" * 3000, "x" * 3001, "y" + "x" * 3000, "ÀÈÌÒÙÿ", "Zebras", "zebras"]
    words = list(base)
    for word in base:
        for _ in range(3):
            at, letter = rng.randrange(len(word)), rng.choice("abcéß")
            words.append(rng.choice((word[:at] + letter + word[at + 1 :], word[:at] + word[at + 1 :], word[:at] + letter + word[at:])))
    rows, weight = [], [rng.choice((1, 2, 6, 40)) for _ in words]
    for doc in range(600):
        rows.append((doc, rng.choice((" ", ", ", "\n", "×", "語")).join(rng.choices(words, weight, k=rng.randint(0, 30)))))
    rows += [(doc, "chains " * k) for doc, k in ((7000, 5), (7001, 9))] + [(1, "chainz " * 80), (2, "chainzz " * 600), (3, "chairzz " * 3100)]
    rows += [(None, "without a number " * 6), (None, None), (5, ""), (5, "again again"), (5, "again again"), (9, "q" * 200000)]
    expected = plain(rows)
    assert run(spark, rows, tmp_path) == expected
    assert expected["chains"][2] == "chairzz" and any(v[4] > 1 for v in expected.values())


def test_noise_takes_a_letter(spark, tmp_path):
    rows = [(doc, "splendid marvellous façade") for doc in range(1500)]
    expected = plain(rows)
    assert len(expected) > 3 and run(spark, rows, tmp_path) == expected


def test_neighbours_of_few_and_of_short_words(spark):
    words = ["", "a", "b", "ab", "ba", "abc", None, "a", "abd", "zzz"]
    df = spark.createDataFrame([(w, "x") for w in words], "word string, near string")
    known = {w for w in words if w is not None}
    assert {tuple(r) for r in spelling.neighbours(df).collect()} == {(a, b) for a in known for b in known if near(a, b)}
    assert spelling.neighbours(df.limit(0)).count() == 0


def test_empty(spark, tmp_path):
    assert run(spark, [], tmp_path) == {}
