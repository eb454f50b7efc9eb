"""The registered queries on small tables, against their contracts in plain Python."""

import collections
import hashlib
import random
import re
import zlib

import pytest

pytest.importorskip("covertrail.llm")
xxhash = pytest.importorskip("xxhash")
from covertrail.llm import chat, decontaminate, secrets, sharding, simhash, substrings, tokens  # noqa: E402

sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(30)] + ["Ab", "é", "日本"]
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(25)]
    texts += [texts[3], texts[3].upper(), None, "", " \t\n", passage, "so " + passage + " on", "x\x1cy\x85z " + passage[:60], passage.replace("p20", "q")]
    texts += ['password = "abcdef1" tokens', "api-key:short Secret='aaaaaa' apikey=abcdefgh", "AKIA" + "A1" * 9 + " AKIAX deadbeef" + "0" * 20, "token = secret=abcdef", "😀 passwd=longenough 😀 " + "ab" * 12, "<|endoftext|> a b"]
    return [(i if i != 9 else 900, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as source", "1 as spans").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_op1(spark, rows, folder):
    kinds = {
        "assign": (re.compile("((?i:password|passwd|secret|token|api_?key))[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 6),
        "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    }
    found = {r.doc_id: r for r in secrets.op1_secrets(spark, folder).collect()}
    assert len(found) == len(rows)
    for doc, text in rows:
        spans = [(m.start(), list(kinds).index(k), m.end(), k) for k, (p, ok) in kinds.items() for m in p.finditer(text or "") if ok(m)]
        base = [f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)]
        r = found[doc]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == q for *_, k in spans) for q in kinds)
        assert r.base_sha256 == sha(",".join(base)) and set(base) <= set(r.spans.split(","))  | {""}


def test_op2(spark, tmp_path):
    told = [(1, 0, "user", "a </turn> \\h #:"), (1, 1, "assistant", "### user: b\n"), (1, 2, "assistant", None), (2, 0, None, "alone"), (3, 0, "assistant", "x" * 50_000)]
    spark.createDataFrame(told, "conv_id long, turn int, role string, text string").selectExpr("*", "1 as formatted").write.parquet(f"{tmp_path}/conversations.parquet")
    probe = "\\### Assistant: </turn> ok"
    told += [(-7, 0, "user", probe), (-7, 1, "assistant", probe)]
    by = collections.defaultdict(list)
    for conv, _, role, text in told:
        by[conv].append((role or "", text or ""))
    found = {r.conv_id: r for r in chat.op2_chat(spark, str(tmp_path)).collect()}
    assert found.keys() == by.keys()
    for conv, turns in by.items():
        loss, r = "".join(t for role, t in turns if role == "assistant"), found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)) and r.formatted_chars > sum(len(t) for _, t in turns)


def test_op3(spark, rows, folder):
    tokenizers, paths = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    library, start = tokenizers.Tokenizer.from_file(paths.path("byte_bpe_50k.json")), 0
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokens.op3_tokens(spark, folder).collect()}
    for doc, text in sorted(rows):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert found[doc] == (start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)


def test_op4(spark, rows, folder):
    def fingerprint(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^ \t-\r]+", lower)
        parts = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {doc: fingerprint(text) for doc, text in rows}
    root = {d: d for d in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    root[a] = root[b] = min(root[a], root[b])
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op4_simhash(spark, folder).collect()}
    assert found == {d: (f"{prints[d]:016x}", root[d]) for d in prints}


def test_op7(spark, rows, folder):
    found = sharding.op7_sharding(spark, folder).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in found) == sorted((d, size(t), zlib.crc32((t or "").encode())) for d, t in rows)
    assert {r.law for r in found} == {"rows"} and {r.grown_shard for r in found} == {None}
    by = collections.defaultdict(list)
    for r in found:
        by[r.shard].append(r.slot)
    counts = [len(by[s]) for s in range(24)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())


def test_op9(spark, rows, folder):
    words = {d: re.findall("[^ \t-\r]+", t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - 12):
            first.setdefault(tuple(words[d][i : i + 13]), d)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.op9_substrings(spark, folder).collect()}
    for d, own in words.items():
        gone = {k for i in range(len(own) - 12) if first[tuple(own[i : i + 13])] < d for k in range(i, i + 13)}
        assert found[d] == (len(own), len(gone), sha(" ".join(w for k, w in enumerate(own) if k not in gone)))
    assert any(n for _, n, _ in found.values())


def test_op10(spark, rows, folder):
    spark.createDataFrame([(5, " ".join(f"p{i}" for i in range(3, 38))), (6, None), (7, "")], "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    found = {r.doc_id for r in decontaminate.op10_decontaminate(spark, folder).collect()}
    holds = {d for d, t in rows if t and "p3 p4 p5" in t and "p20" in t}  # one word of 35 changed leaves a similarity of 0.72
    assert found == holds and len(holds) == 2
