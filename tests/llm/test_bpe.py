"""The automaton's ids are those of the tokenizers library; decoding gives back what was encoded."""

import hashlib
import random

import numpy as np
import pytest

pytest.importorskip("covertrail.llm")
tokenizers, paths = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
from covertrail.llm import bpe  # noqa: E402


@pytest.fixture(scope="module")
def definition():
    return open(paths.path("byte_bpe_50k.json"), encoding="utf-8").read()


def ids(encoder, text):
    return np.frombuffer(encoder.ids(text), "<u4").tolist()


def test_ids_are_those_of_the_library(definition, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 500)
    automaton, library, rng = bpe.Automaton(definition), tokenizers.Tokenizer.from_str(definition), random.Random(3)
    encoder = bpe.Encoder(automaton)
    whole = [t.decode() for t in automaton.tokens.values() if t.decode("utf-8", "ignore").encode() == t]
    bits = whole + ["\t\n", "  ", "\x85", "\x1c", "<|endoftext|>", "<|endoftext", "　", "é", "\U0001f600", "࢏", " \n", "'s"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    texts += ["".join(rng.choice("ab e=-\n t") for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    texts += ["a" * 20001, " " * 999, "qx" * 3000, "", " ", "\n", "a ", "<|endoftext|>"]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids(encoder, text) == expected, text
        assert bpe.text_of_ids(encoder.ids(text), automaton.tokens) == library.decode(expected, skip_special_tokens=False)


def test_only_arcs_of_the_automaton_are_read(definition):
    """Two tokens may follow each other just if the library gives them back."""
    automaton, library, rng = bpe.Automaton(definition), tokenizers.Tokenizer.from_str(definition), random.Random(4)
    letters = [i for i, t in automaton.tokens.items() if t.isalpha() and t.isascii()]
    for _ in range(5000):
        a, b = rng.choice(letters), rng.choice(letters)
        text = (automaton.tokens[a] + automaton.tokens[b]).decode()
        assert automaton._leaves(a, b) == (library.encode(text, add_special_tokens=False).ids == [a, b])


def test_new_words_take_few_lookups(definition):
    """A word not met before is read from what is known of its beginnings, not by trying every size at every place."""

    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

    automaton, library, rng = bpe.Automaton(definition), tokenizers.Tokenizer.from_str(definition), random.Random(5)
    for name in {"labels", "longer"} & set(vars(automaton)):
        setattr(automaton, name, Counted(getattr(automaton, name)))
    encoder, parts = bpe.Encoder(automaton), "th er tion eau ché ing ble wh an re ó ciña nd ou ß keit".split()
    words = ["".join(rng.choices(parts, k=rng.randint(2, 6))) for _ in range(5000)]
    for word in words:
        assert ids(encoder, "a " + word) == library.encode("a " + word, add_special_tokens=False).ids, word
    assert Counted.asked < 8 * len(words)


def test_both_ways_of_reading_a_word_agree(definition, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 300)
    automaton, rng = bpe.Automaton(definition), random.Random(6)
    tokens = sorted(automaton.tokens[i] for i in automaton.labels.values())
    words = [b"".join(rng.choices(tokens, k=rng.randint(0, 8))) for _ in range(3000)]
    words += [bytes(rng.choices(b"aeinrst \xc3\xa9=-", k=rng.randint(1, 190))) for _ in range(1000)]
    for word in words:
        assert np.frombuffer(automaton.ids(word), "<u4").tolist() == automaton.read(word), word


def test_decoding_by_a_table(definition):
    tokens = bpe.Automaton(definition).tokens
    table, some, last = bpe.table_of(tokens), list(range(0, 50_000, 7)), max(tokens)
    for given in ([], [0], some, [last, last + 1, last + 2, 2**32 - 1, 5], [200, 130, 131]):
        packed = np.array(given, "<u4").tobytes()
        expected = b"".join(tokens.get(i, b"") for i in given).decode("utf-8", "replace")
        assert bpe.text_of_ids(packed, table) == bpe.text_of_ids(packed, tokens) == expected
    assert bpe.text_of_ids(np.array([3], "<u4").tobytes(), bpe.table_of({})) == ""


def test_no_other_kind_of_tokenizer(definition):
    with pytest.raises(ValueError):
        bpe.Automaton(definition.replace('"use_regex":true', '"use_regex":false').replace('"use_regex": true', '"use_regex": false'))


def test_columns_nulls_and_the_query(spark, definition, tmp_path):
    library = tokenizers.Tokenizer.from_str(definition)
    rows = [(1, "The cat.", "x"), (1, "The cat.", "x"), (None, None, "y"), (3, "", "z"), (4, "café <|endoftext|>" * 3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = bpe.decode(bpe.encode(docs, definition), definition).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in found) == sorted((str(k), t or "") for k, t, _ in rows)
    assert bpe.encode(docs.limit(0), definition).count() == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    made = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op13_bpe(spark, str(tmp_path)).collect()}
    expected = set()
    for k, t, _ in rows:
        want = library.encode(t or "", add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        expected.add((k, len(want), digest, hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()))
    assert made == expected
