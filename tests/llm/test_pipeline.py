"""The pipeline against brute force on the smallest tables."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

corpus_pipeline = pytest.importorskip("corpus_pipeline")
DATA = "/root/testdata/sf0.001"


def good(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words) >= 50 and 100 * len(covered) <= 50 * len(words) and 2 * symbols <= len(words) and 2 * (len(lines) - len(set(lines))) <= len(lines)


def first_of_groups(docs):
    """Groups by five-word shingles with a similarity of 0.8 or more, all pairs compared."""

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}

    sets = {d: shingles(t) for d, t, *_ in docs}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [r for r in docs if find(r[0]) == r[0]]


def grams(text):
    import regex

    words = regex.findall(r"[\p{L}\p{N}]+", text.lower())
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def leaks(text, items):
    mine = grams(text)
    here = set(mine)
    for item in items:
        if not here & set(item):
            continue
        want, n = collections.Counter(item), len(item)
        for i in range(max(1, len(mine) - n + 1)):
            have = collections.Counter(mine[i : i + n])
            both = sum((have & want).values())
            if both >= 0.8 * (sum(have.values()) + n - both):
                return True
    return False


def sampled(docs, share):
    powers = (0.5, 0.7, 0.9)

    def cell(text, lang, source):
        form = "table" if " | " in text else "notice" if re.search("(?i)licen[sc]e|copyright", text) else "long" if len(text) >= 2000 else "short"
        return source or "", lang or "", form

    cells, tokens = [cell(*r[1:4]) for r in docs], [len(r[1].encode().split()) for r in docs]
    total = collections.Counter()
    for c, n in zip(cells, tokens):
        total[c] += n
    keys = list(total)
    held = np.array([total[k] for k in keys], float)
    groups = [np.array([sorted({k[d] for k in keys}).index(k[d]) for k in keys]) for d in range(3)]
    shares = [(lambda s: s / s.sum())(np.bincount(g, held) ** p) for g, p in zip(groups, powers)]
    share = min([share, *(float((np.bincount(g, held) / s).min() / held.sum()) for g, s in zip(groups, shares))])
    rate = np.full(len(keys), share)
    for _ in range(25):
        off = 0.0
        for g, s in zip(groups, shares):
            full = np.bincount(g, np.where(rate >= 1, held, 0))
            free = np.bincount(g, np.where(rate >= 1, 0, rate * held))
            goal = s * share * held.sum()
            off = max(off, np.abs((full + free) / goal - 1).max())
            rest = np.divide(goal - full, free, out=np.ones(len(free)), where=free > 0)
            rate = np.minimum(1, rate * np.where(full + free > goal, goal / (full + free), rest)[g])
        if off <= 1e-4:
            break
    chance = dict(zip(keys, rate))

    def draw(doc, text):
        h = xxhash.xxh64_intdigest((0).to_bytes(4, "little"), 42)
        h = xxhash.xxh64_intdigest(doc.to_bytes(8, "little"), h)
        return (xxhash.xxh64_intdigest(text.encode(), h) >> 11) * 2.0**-53

    return [r for r, c in zip(docs, cells) if draw(r[0], r[1]) < chance[c]]


def test_run(spark):
    tokenizers = pytest.importorskip("tokenizers")
    paths = pytest.importorskip("public_tokenizers")
    con = duckdb.connect()
    docs = con.execute(f"SELECT doc_id, coalesce(text, ''), lang, source FROM '{DATA}/documents.parquet' ORDER BY doc_id").fetchall()
    items = [grams(t) for (t,) in con.execute(f"SELECT text FROM '{DATA}/benchmark.parquet'").fetchall()]
    docs = [r for r in docs if good(r[1])]
    docs = first_of_groups(docs)
    docs = [r for r in docs if not leaks(r[1], items)]
    docs = sampled(docs, 0.8)
    plain = tokenizers.Tokenizer.from_file(paths.path("byte_bpe_50k.json"))
    want, at = [], 0
    for r in docs:
        ids = plain.encode(r[1], add_special_tokens=False).ids + [0]
        want.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, DATA).collect())) == want
