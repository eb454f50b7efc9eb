"""Repairs are the cheapest by exhaustive recursion; the query equals a version in plain Python."""

import functools
import hashlib
import random
import re
import sys
import zlib

import pytest

pytest.importorskip("covertrail.llm")
from covertrail.llm import repair  # noqa: E402

sys.setrecursionlimit(20000)
LEGAL = re.compile("(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def cheapest(turns):
    """turns: (initial, fault). Cost and letters by recursion over places, the last role and how many turns were just put in."""

    @functools.cache
    def rest(place, last, put):
        found = [(0, "")] if place == len(turns) and last in ("", "a") else []
        wanted, edits = "a" if last == "u" else "u", []
        if put < 2:  # more in a row never pay
            edits.append(("I", 5, place, wanted, put + 1))
        if place < len(turns):
            initial, fault = turns[place]
            edits.append(("D", 2, place + 1, last, 0))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                edits.append(("R", 1 + more, place + 1, wanted, 0))
                if initial == wanted or initial == "s" and last == "":
                    edits.append(("K", more, place + 1, initial, 0))
        for letter, cost, *to in edits:
            if left := rest(*to):
                found.append((cost + left[0], letter + left[1]))
        return min(found, default=None)

    return rest(0, "", 0)


def codes_of(turns):
    at = {"blank": 2, "duplicate": 2, "truncated": 1, None: 0}
    return bytes(3 * "suax".index(i if i in "sua" else "x") + at[f] for i, f in turns)


def test_least_edits():
    rng = random.Random(1)
    for trial in range(3000):
        n = rng.randint(0, 7 if trial % 10 else 60)
        turns = tuple((rng.choice("suuaax"), rng.choice((None, None, None, "truncated", "blank"))) for _ in range(n))
        assert repair.least_edits(codes_of(turns)) == cheapest(turns), turns


def test_a_long_conversation_ends():
    rng = random.Random(2)
    turns = tuple((rng.choice("suuaax"), rng.choice((None, None, None, "truncated", "blank"))) for _ in range(20000))
    cost, audit = repair.least_edits(codes_of(turns))
    assert 0 < cost < 2 * len(turns) and len(audit.replace("I", "")) == len(turns)


def plain(rows):
    """conv: the query's row, from (conv, turn, role, text) rows."""
    out, by = {}, {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        by[conv] += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, faults = set(), []
        for _, role, text in turns:
            end = text.rstrip(SPACE)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else None if end[-1] in ".!?" else "truncated")
            seen.add((role, text))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(tuple(zip(initials, faults)))
        kept, rest = [], iter(turns)
        for edit in audit:
            wanted = "assistant" if kept and kept[-1][0][:1] == "u" else "user"
            if edit == "I":
                kept.append((wanted, ""))
                continue
            _, role, text = next(rest)
            if edit != "D":
                kept.append((role if edit == "K" else wanted, text))
        assert LEGAL.fullmatch("".join(r[:1] for r, _ in kept))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv] = (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def check(spark, rows, tmp_path):
    chats = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    chats.selectExpr("*", "1 as place", "'x' as conv", "2 as audit").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: tuple(r) for r in repair.op11_repair(spark, str(tmp_path)).collect()}
    assert found == plain(rows)


def test_query(spark, tmp_path):
    rng = random.Random(5)
    texts = ["Yes.", "No!", "Why? ", "so", "", " \t", None, "¿Qué?", "A line.\nAnother", "Long. " * 3000, "e\x1c", "x.\x85", "日本。"]
    rows = []
    for conv in [*range(150), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(("user", "assistant")) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            role = rng.choice(("system", "tool", "", None, "User", "sage")) if rng.random() < 0.15 else role
            rows.append((conv, None if rng.random() < 0.05 else turn + rng.randint(0, 1), role, rng.choice(texts)))
    rows += [(1000, t % 40, ("user", "assistant")[t % 2], f"{t}.") for t in range(700)]
    check(spark, rows, tmp_path)


def test_empty(spark, tmp_path):
    check(spark, [], tmp_path)
