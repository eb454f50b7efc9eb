"""Operators do the whole job: cases that a narrower version passes over."""

import random

import pytest

pytest.importorskip("covertrail.llm")
from covertrail.llm import mixing, secrets, simhash, tokens  # noqa: E402


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def test_dedup_reaches_a_similarity_of_four_fifths(spark):
    base = [f"w{i}" for i in range(104)]  # 100 shingles
    changed = lambda at, mark: [mark + str(i) if i in at else w for i, w in enumerate(base)]
    far, near, below = changed((20, 40), "x"), changed((20,), "y"), changed((20, 40, 60), "z")
    texts = [base, far, below, near, [f"v{i}" for i in range(60)], [], ["one"], ["ONE"]]
    texts = [" ".join(t) for t in texts]
    similar = lambda a, b: len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    assert similar(texts[0], texts[1]) > 0.8 > similar(texts[0], texts[2])
    assert max((simhash.fingerprint(texts[0]) ^ simhash.fingerprint(t)).bit_count() for t in (texts[1], texts[3])) > 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.dedup(docs).collect()) == [0, 2, 4, 5, 6]


def test_dedup_compares_all_of_a_band(spark):
    """A chain of copies, ends unlike, whatever one each band starts with."""
    words, rows = [f"w{i}" for i in range(204)], []
    for step in range(30):
        rows.append((step, " ".join(words)))
        for i in range(3):
            words[(step * 3 + i) * 7 % 204] = f"n{step}x{i}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    root = list(range(30))
    sets = [shingles(t) for _, t in rows]
    for _ in rows:
        for i in range(30):
            for j in range(30):
                if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    assert sorted(r.doc_id for r in simhash.dedup(docs).collect()) == sorted(set(root))


def test_secrets_link_a_secret_to_an_endpoint(spark):
    rows = [(1, "pwd=hunter22 redis://cache.local"), (2, "redis://cache.local"), (3, "pwd=hunter22\n\nredis://cache.local"), (4, "login: bob redis://cache.local")]
    found = {r.id: {s.kind for s in r.spans} for r in secrets.scan(spark.createDataFrame(rows, "id int, text string")).collect()}
    assert found == {1: {"pass", "endpoint"}, 2: set(), 3: set(), 4: set()}


def test_ids_are_those_of_the_library(monkeypatch):
    tokenizers, paths = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(tokens, "AT_ONCE", 300)
    monkeypatch.setattr(tokens, "CACHE_WORDS", 60)
    definition = tokens.tokenizer_definition(paths.path("byte_bpe_50k.json"))
    encoder, plain, rng = tokens.Encoder(definition), tokenizers.Tokenizer.from_str(definition), random.Random(5)
    bits = [" ", "  ", "\n", " \n", "\n\n", "\t", "\r\n", "\u2003", "\xa0", "\x85", "\x1c", "a", "B", "the", "don't", "'s", "\u00e9", "\u00d7", "\u00df", "\u024f", "\u0250"]
    bits += ["\u65e5\u672c", "\U0001f600", "12", "...", ",", "!", "<|endoftext|>", "\x00", "-", "_", "\u0130", "x" * 70, "e\u0301", "y" * 2000]
    for _ in range(60):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(40)]
        assert [x.tolist() for x in encoder.ids(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_mix_meets_targets_of_a_skewed_corpus(spark):
    """A third of all rows from one source; cells that can give no more are made up for."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(6)}"
        lang = rng.choice(("en", "en", "en", "de", "es")) if source != "s1" else rng.choice(("es", "es", "de", "en"))
        rows.append((source, lang, rng.choice("abc"), rng.randrange(0, 80)))
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long").groupBy("source", "lang", "topic").agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "tokens")
    targets = {"source": 0.5, "lang": 0.7, "topic": 0.9}
    rated = mixing.rake(cells, targets, 0.8)
    found = rated.collect()
    assert max(r.probability for r in found) == 1 > min(r.probability for r in found)
    kept = sum(r.probability * r.tokens for r in found) / sum(r.tokens for r in found)
    assert 0.6 < kept < 0.8001
    short = {(r.dimension, r.value): r.short for r in mixing.marginals(rated, targets).collect()}
    assert max(map(abs, short.values())) < 0.002
