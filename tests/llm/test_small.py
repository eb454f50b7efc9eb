"""Each operator against brute force on small tables with nulls, empties, ties, repeats, clashing columns."""

import collections
import functools
import hashlib
import math
import re
import textwrap
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

pytest.importorskip("covertrail.llm")
from covertrail.llm import chat, decontaminate, licenses, mixing, quality, secrets, sharding, simhash, substrings, tokens  # noqa: E402

LONG = " ".join(f"w{i % 701}x{i % 13}" for i in range(20_000))
PROSE = " ".join(f"word{i}" for i in range(80))
TEXTS = [None, "", " \n\t", "one", PROSE, PROSE, PROSE + " end", LONG, "a b a b a b a b\na b\na b", "é ü password = abc12345 AKIA" + "A1" * 10 + " " + "0af3" * 8]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 3 else None, t, "en" if i % 2 else None, "src0", 7) for i, t in enumerate(TEXTS)]
    rows.append(rows[5])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, slot int")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_secrets(docs, none):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for r in secrets.scan(docs.withColumn("t", F.col("text"))).collect():
        t = r.t or ""
        want = [("assign", *m.span()) for m in assign.finditer(t) if len(m[2]) >= 6]
        want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert sorted((s.kind, s.start, s.end) for s in r.spans if s.strong) == sorted(want)
    assert secrets.scan(none).count() == 0


def test_secrets_weak_parts_need_each_other(spark):
    value = "Zx9" * 8
    rows = [(1, f"login: bob {value}"), (2, f"only {value} here"), (3, f"login: bob\n\n{value}"), (4, f"login: bob {'x ' * 400}{value}"), (5, "password: token: abcdefgh")]
    found = {r.id: {s.kind for s in r.spans} for r in secrets.scan(spark.createDataFrame(rows, "id int, text string")).collect()}
    assert found == {1: {"ident", "value"}, 2: set(), 3: set(), 4: set(), 5: set()}


def test_chat(spark):
    text = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", text), (1, 1, "assistant", text), (2, 0, None, None), (2, 0, "assistant", "a"), (2, 1, "assistant", "b"), (None, 0, "assistant", "\\\\h#")]
    rows += [(3, 0, "assistant", "x"), (3, 0, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    found = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    by = collections.defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r or "", x or ""))
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        r = found[c]
        assert (r.n_turns, r.loss_chars, r.rewrites) == (len(turns), len(loss), 0)
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_finds_rewriting_templates():
    def counting(turns):
        return f"[{len(turns)}]" + chat.render(turns)

    turns = [("user", "a"), ("assistant", "b")]
    assert chat.locate(counting, turns)[2] == 2
    assert chat.locate(chat.render, turns)[2] == 0


def test_tokens(spark, docs, none, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    paths = pytest.importorskip("public_tokenizers")
    definition = tokens.tokenizer_definition(paths.path("byte_bpe_50k.json"))
    plain = tokenizers.Tokenizer.from_str(definition)
    encoder = tokens.Encoder(definition)
    odd = ["  a  b ", " a\n\nb", "a\n b", "a b\n", "it's, don't; x.y, é! \n 5, <b>", " ", "\n", "a \n b", "tab\there", "a, b. c? d%, é! 5, x;; \nA, b\nC.", "a\n", "\na"]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(odd)] == [plain.encode(t, add_special_tokens=False).ids for t in odd]
    path = f"file://{tmp_path}/tokens"
    tokens.write_tokens(docs, path, definition)
    found = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted([r.doc_id for r in docs.collect()], key=lambda d: (d is not None, d))
    at = 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in found:
        ids = plain.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert tokens.tokenise(none, definition, 0).count() == 0


def test_packing():
    values = np.array([0, 255, 256, 65535, 65536, 1 << 24, 2**32 - 1, 3], np.uint32)
    for n in range(len(values) + 1):
        assert tokens.unpack(tokens.pack(values[:n]), n).tolist() == values[:n].tolist()


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, docs, none):
    assert [simhash.fingerprint(t or "") for t in TEXTS] == [brute_print(t) for t in TEXTS]
    rng = np.random.default_rng(3)
    prints = [int(x) for x in rng.integers(0, 2**63, 40)]
    for p in list(prints):
        for _ in range(6):
            for bit in rng.choice(64, rng.integers(0, 7), replace=False):
                p ^= 1 << int(bit)
            prints.append(p)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    found = {r.doc_id: r.component_id for r in simhash.groups(spark.createDataFrame(rows, "doc_id long, fp long")).collect()}
    root = list(range(len(prints)))
    for _ in prints:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    assert found == dict(enumerate(root))
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns and kept.where(f"text = '{PROSE}'").count() == 1
    assert simhash.dedup(none).count() == 0


def test_one_prefix_in_passes(monkeypatch):
    rng = np.random.default_rng(1)
    prints = (rng.integers(0, 2**40, 200).astype(np.uint64) << np.uint64(3)) % np.uint64(2**12)
    prints = np.unique(prints)
    whole = simhash._linked(prints, np.full(len(prints), 2, np.int8), 60)
    monkeypatch.setattr(simhash, "AT_ONCE", 10_000)
    parts = simhash._linked(prints, np.full(len(prints), 2, np.int8), 60)
    assert [x.tolist() for x in whole] == [x.tolist() for x in parts]


def test_quality(docs, none):
    for r in quality.ledger(docs).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = collections.Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
        lines = [x for x in (r.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(words), sum(map(len, words)), len(covered), len(lines) - len(set(lines)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", r.text or ""))
        assert bool(r.failed_bits & 3) == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
    scored = quality.ledger(docs)
    ablation = {r.rule: r for r in quality.ablate(scored).collect()}
    assert ablation["few_words"].n_failed == scored.where("n_words < 50").count()
    assert quality.apply_policy(docs).columns == docs.columns and quality.ledger(none).count() == 0
    stored = quality.stored_ledger(docs, "doc_id", "n_words")
    assert stored.columns == ["doc_id", *quality.MEASURED, "failed_bits"] and stored.count() == docs.count()
    bits = [r.failed_bits for r in stored.collect()]
    made = quality.ablations(stored, most=3).collect()
    assert len({(r.policy, r.dropped) for r in made}) == len(made) == 4 + 15 + 42
    for r in made:
        left = [n for n in quality.POLICIES[r.policy] if n not in r.dropped.split("+")]
        mask, whole = sum(map(quality.policy_bit, left)), quality.policy_mask(r.policy)
        gone = [b for b in bits if b & mask]
        assert r.n_kept == len(bits) - len(gone) and r.n_more == sum(not b & mask and bool(b & whole) for b in bits)
        assert r.all_bits == (functools.reduce(int.__and__, gone) if gone else None) and r.any_bits == (functools.reduce(int.__or__, gone) if gone else None)
    assert [r.name for r in quality.rules()] == list(quality.NAMES) and quality.ablations(quality.stored_ledger(none)).count() == 0


def test_sharding(spark, docs, none, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 16)
    for n in (0, 1, 5, 300, 3000):
        placed = sharding.assign(spark.range(n).select((F.col("id") % 3).alias("id"), F.lit(1).alias("shard")), 7, seed=n).collect()
        by = collections.defaultdict(list)
        for r in placed:
            by[r.shard].append(r.slot)
        assert len(placed) == n and all(sorted(v) == list(range(len(v))) for v in by.values())
        assert max(map(len, by.values()), default=0) - min((len(by[s]) for s in range(7))) <= 1
    assert sharding.assign(docs, 3).count() == docs.count() and sharding.assign(none, 3).count() == 0


def test_hypergeometric_law(spark):
    u = sharding._uniform(F.lit(5), F.col("id"))
    drawn = spark.range(20_000).select(sharding.hypergeometric(F.lit(30), F.lit(9), F.lit(11), u).alias("k")).groupBy("k").count().collect()
    from math import comb

    square = sum((r["count"] - e) ** 2 / e for r in drawn for e in [20_000 * comb(9, r.k) * comb(21, 11 - r.k) / comb(30, 11)])
    assert square < 40  # 9 degrees of freedom


def test_mixing(docs, none):
    rows = mixing.mix(docs, {"source": 1.0, "lang": {"en": 1.0, "": 1.0}}, share=0.5).collect()
    by = collections.defaultdict(float)
    for r in rows:
        by[r.lang] += r.mix.probability * r.mix.n_tokens
    total = sum(r.mix.n_tokens for r in rows)
    assert len(rows) == docs.count()
    bound = max(r.mix.probability for r in rows) == 1  # then the mix is made smaller, never larger
    assert sum(by.values()) == pytest.approx(total / 2, rel=0.01) or (bound and sum(by.values()) < total / 2)
    assert mixing.sample(docs).columns == docs.columns and mixing.mix(none).count() == 0


def test_substrings(docs, none):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    inf = 1 << 62
    first = {}
    for d, t in sorted(((d if d is not None else inf, t) for d, t in rows)):
        words = t.encode().split()
        for i in range(len(words) - 12):
            first.setdefault(tuple(words[i : i + 13]), d)
    found = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.remove_spans(substrings.duplicate_spans(docs)).collect())
    want = collections.Counter()
    for d, t in rows:
        words = t.encode().split()
        gone = {j for i in range(len(words) - 12) if first[tuple(words[i : i + 13])] < (d if d is not None else inf) for j in range(i, i + 13)}
        want[d, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()] += 1
    assert found == want
    assert substrings.duplicate_spans(none).count() == 0


def test_licenses(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/c.py", "x = 1"), ("a/b/d.py", "Licensed under the Apache License, Version 2.0.\n" + PROSE), ("e.py", None), (None, ""), ("z/q.py", "a licence to kill")]
    found = {r.path: (r.license, r.origin, r.from_dir) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert found == {
        "a/LICENSE": ("MIT", "own", None),
        "a/b/c.py": ("MIT", "inherited", "a"),
        "a/b/d.py": ("Apache-2.0", "own", None),
        "e.py": (None, "none", None),
        None: (None, "none", None),
        "z/q.py": (None, "none", None),
    }
    assert licenses.scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_whole_licence_files(spark):
    """Licence files far longer than a notice stand for their directories; a long text that quotes a license does not."""
    mit = "MIT License\n\nCopyright (c) 2020 Some One\n\n" + "\n\n".join("\n".join(textwrap.wrap(t, 70)) for t in licenses.TEMPLATES["MIT"][3:])
    mit += "\n\n" + "\n".join(textwrap.wrap("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY. " * 2, 70))
    apache = "                 Apache License\n           Version 2.0, January 2004\n        http://www.apache.org/licenses/\n\n" + "\n\n".join(f"   {i}. Clause. " + PROSE for i in range(9)) + "\n\n" + licenses.TEMPLATES["Apache-2.0"][2]
    gpl = "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n" + "\n\n".join(f"  {i}. Terms. The licensee may copy. " + PROSE for i in range(60))
    header = "\n".join("# " + x for x in textwrap.wrap(licenses.TEMPLATES["GPL-3.0"][3], 60)) + "\n\nx = 1\n" + PROSE
    inside = PROSE + " and more. Released under the MIT License. " + PROSE
    rows = [("a/LICENSE", apache), ("a/x/y.py", PROSE), ("b/mit.txt", mit), ("b/z.py", ""), ("c/COPYING", gpl), ("c/d/LICENSE.md", mit), ("c/d/e/f.py", "x"), ("c/g.py", "x"), ("h/i.py", header), ("h/j.py", "x"), ("k/l.txt", inside), ("k/m.txt", "x")]
    df = spark.createDataFrame([(*r, "own") for r in rows], "path string, text string, origin string")
    found = {r.path: (r.license, r.origin, r.from_dir) for r in licenses.scan(df).collect()}
    assert found == {
        "a/LICENSE": ("Apache-2.0", "own", None), "a/x/y.py": ("Apache-2.0", "inherited", "a"),
        "b/mit.txt": ("MIT", "own", None), "b/z.py": ("MIT", "inherited", "b"),
        "c/COPYING": ("GPL-3.0", "own", None), "c/g.py": ("GPL-3.0", "inherited", "c"),
        "c/d/LICENSE.md": ("MIT", "own", None), "c/d/e/f.py": ("MIT", "inherited", "c/d"),
        "h/i.py": ("GPL-3.0", "own", None), "h/j.py": (None, "none", None),
        "k/l.txt": ("MIT", "own", None), "k/m.txt": (None, "none", None),
    }


def test_licences_by_brute_force(spark):
    """Cosines of single-line notices as Python computes them."""
    notices = ["Licensed under the Apache License, Version 2.0.", "licensed under the apache license", "A license. Apache", "GNU General Public License v3.0", "Licensed under CC BY-NC 4.0", "under the MIT License", "copyright of nobody"]
    terms = lambda t: [x for x in re.split(r"[^\w.]+|\.(?=\s|$)", t.lower()) if x]
    listed = [(k, terms(t)) for k, v in licenses.TEMPLATES.items() for t in v]
    df = collections.Counter(t for _, x in listed for t in set(x))
    idf = lambda t: math.log((1 + len(listed)) / (1 + df[t])) + 1

    def unit(words):
        w = {t: n * idf(t) for t, n in collections.Counter(words).items()}
        return {t: x / math.sqrt(sum(y * y for y in w.values())) for t, x in w.items()}

    def best(text):
        parts = [text, *(re.split(r"(?<=[.!?:;])\s+", text) if re.search(r"[.!?:;]\s", text) else [])]
        at = [(round(sum(x * b.get(t, 0) for t, x in unit(terms(p)).items()), 6), k) for p in parts if re.search(licenses.NOTICE, p) for k, b in ((k, unit(x)) for k, x in listed)]
        return max((x for x in at if x[0] >= licenses.LIKE), default=(None, None))

    rows = spark.createDataFrame([(f"{i}/f", t) for i, t in enumerate(notices)], "path string, text string")
    for r in licenses.scan(rows).collect():
        want = best(notices[int(r.path[0])])
        assert r.license == want[1] and (want[0] is None or abs(r.similarity - want[0]) < 2e-6), (r, want)


def test_decontamination(spark, docs, none):
    item = " ".join(f"Item{i}" for i in range(40))
    words = item.split()
    texts = ["x " * 50 + item + " y" * 50, item.lower().replace(" ", ",\n"), " ".join(words[:37]), " ".join(words[:20]), " ".join(words[:19] + ["new"] + words[20:]), "a b", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, ""), (9, None), (10, "a b")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): round(r.similarity, 3) for r in decontaminate.find_leaks(rows.unionByName(rows), items).collect()}
    assert found == {(0, 7): 1.0, (1, 7): 1.0, (2, 7): 0.917, (5, 10): 1.0}
    assert {r.doc_id for r in decontaminate.drop_leaks(rows, items).collect()} == {3, 4, 6}
    assert decontaminate.find_leaks(none, items).count() == 0
    assert decontaminate.find_leaks(rows, items.limit(0)).count() == 0
    assert decontaminate.drop_leaks(docs, items).columns == docs.columns
