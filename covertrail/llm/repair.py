"""Repair of conversations at least cost: roles must read (system) user assistant user assistant ...

Each turn is kept, given another role or deleted, and empty turns may be put in. The edits
of a conversation are found by depth-first branch-and-bound over one byte a turn; texts
never meet in one place. Passes that need a conversation's turns in order stream over
partitions sorted by conversation, so memory follows the number of its turns (its edits
are part of the result), not their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table

#: What edits cost: D delete, I insert, R give another role; a truncated turn that stays costs TRUNCATED more.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: The turns before this place: none yet, a system turn, a user turn last, an assistant turn last.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: A turn's byte: 3 * its role's initial + its fault.
_INITIALS, _SOUND, _CUT, _GONE = "sua", 0, 1, 2
_WIDE = " \t\n\x0b\x0c\r"


def _moves(code: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a turn, in the order of the edits' letters."""
    initial, fault = divmod(code, 3)
    found = [("D", DELETE, state)]
    if fault != _GONE:
        more, wanted = TRUNCATED * (fault == _CUT), _ASSISTANT if state == _USER else _USER
        if initial + 1 == wanted or initial == 0 and state == _START:
            found.append(("K", more, initial + 1))
        if initial + 1 != wanted:
            found.append(("R", REROLE + more, wanted))
    return found


#: For each state and byte, and the state behind an insertion.
_MOVES = [[_moves(code, state) for code in range(12)] for state in range(4)]
_INSERTED = [_USER, _USER, _ASSISTANT, _USER]


def lower_bounds(codes: bytes) -> list[int]:
    """For every place and state (4 * place + state) what the turns from there on cost at least.

    Only the rule that the last turn is an assistant's is left out, so a bound is too low
    by two insertions at most.
    """
    n = len(codes)
    bound = [0] * (4 * n + 4)
    for i in range(n - 1, -1, -1):
        at, after = 4 * i, 4 * i + 4
        for state in range(4):
            bound[at + state] = min(cost + bound[after + to] for _, cost, to in _MOVES[state][codes[i]])
        plain = bound[at : at + 4]
        for state in range(4):
            bound[at + state] = min(plain[state], INSERT + plain[_INSERTED[state]])
    return bound


def _dive(codes: bytes, bound: list[int]) -> int:
    """The cost of one repair: always the edit that promises most."""
    place, state, total = 0, _START, 0
    while place < len(codes):
        moves = [(cost + bound[4 * place + 4 + to], cost, to, 1) for _, cost, to in _MOVES[state][codes[place]]]
        moves.append((INSERT + bound[4 * place + _INSERTED[state]], INSERT, _INSERTED[state], 0))
        _, cost, state, step = min(moves, key=lambda m: (m[0], -m[3]))
        place, total = place + step, total + cost
    return total + INSERT * {_START: 0, _SYSTEM: 2, _USER: 1, _ASSISTANT: 0}[state]


def least_edits(codes: bytes) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of a conversation, the ASCII-least of them.

    Branches are taken in the order of their letters from an explicit stack. So of two
    prefixes that meet in a node (place, state), the later one is kept only if it costs
    less; and a branch is cut if its cost with the bound of what is left exceeds the
    incumbent, or equals one found this way. The search ends when no branch is left.
    """
    n, bound = len(codes), lower_bounds(codes)
    most, audit = _dive(codes, bound), None
    entered = [most + 1] * (4 * n + 4)
    path: list[str] = []
    stack = [(0, _START, 0, 0, "")]
    while stack:
        place, state, cost, depth, letter = stack.pop()
        node = 4 * place + state
        promise = cost + bound[node]
        if promise > most or (promise == most and audit is not None) or cost >= entered[node]:
            continue
        entered[node] = cost
        if depth:
            path[depth - 1 :] = letter
        if place == n and state in (_START, _ASSISTANT):
            most, audit = cost, "".join(path)
            continue
        moves = [(place + 1, to, cost + more, depth + 1, edit) for edit, more, to in _MOVES[state][codes[place]]] if place < n else []
        moves.insert(len(moves) and 1, (place, _INSERTED[state], cost + INSERT, depth + 1, "I"))
        stack.extend(reversed(moves))
    return most, audit or ""


def _letters(role: str, text: str) -> tuple:
    """A role's initial and a text without the white space at its end, as columns."""
    return F.substring(role, 1, 1), F.rtrim(F.col(text), F.lit(_WIDE))


def judged(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """conv, place, turn, role, text of each turn in order, its first fault, and what reports count.

    place counts from 1 by turn (nulls first), ties by role and text. Null roles and texts
    are one space. fault: "blank", "duplicate" (role and text stood before), "truncated"
    (no . ! or ? at the end) or null. illegal: the initials of the role before and of this
    one are not su, ua or au. first_of_turn: the turn is not null and not that of the turn before.
    """
    one = F.lit(" ")
    rows = chats.select(F.col(conv).alias("conv"), "turn", F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text")).repartition("conv")
    turn = F.col("turn").asc_nulls_first()
    initial, trimmed = _letters("role", "text")
    rows = rows.withColumn("again", F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy(turn)) > 1)
    order = Window.partitionBy("conv").orderBy(turn, "role", "text")
    fault = F.when(trimmed == "", "blank").when(F.col("again"), "duplicate").when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated")
    pair = F.concat(F.lag(initial).over(order), initial)
    return rows.select(
        "conv",
        F.row_number().over(order).cast("long").alias("place"),
        "turn",
        "role",
        "text",
        fault.alias("fault"),
        F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
        (F.col("turn").isNotNull() & ~F.lag("turn").over(order).eqNullSafe(F.col("turn"))).alias("first_of_turn"),
    )


def reports(rows: DataFrame) -> DataFrame:
    """conv, gaps (turn numbers between the least and the greatest that no turn has), blank, duplicate, truncated, illegal of judged() rows."""
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - count(F.col("first_of_turn")), F.lit(0)).cast("long")
    faults = [count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    return rows.groupBy("conv").agg(gaps.alias("gaps"), *faults, count(F.col("illegal")).alias("illegal"))


def _by_conversation(rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    """run over the rows of each conversation in order of place; it gets an iterator of batches, and makes batches."""
    return rows.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(run, schema)


_NEW = object()


def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in columns.values()], names=list(columns))


def audits(rows: DataFrame) -> DataFrame:
    """conv, cost, audit: least_edits() of each conversation of judged() rows, from one byte a turn."""
    initial = F.array_position(F.array(*map(F.lit, _INITIALS)), _letters("role", "text")[0])  # 1 to 3, 0 for others
    fault = F.when(F.col("fault") == "truncated", _CUT).when(F.col("fault").isNull(), _SOUND).otherwise(_GONE)
    code = (F.when(initial == 0, 9).otherwise(3 * (initial - 1)) + fault).cast("int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, codes = _NEW, bytearray()
        for batch in batches:
            done, kind = [], batch.column(0).type
            for conv, code in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if conv != current:
                    if current is not _NEW:
                        done.append((current, *least_edits(bytes(codes))))
                    current, codes = conv, bytearray()
                codes.append(code)
            yield _batch({"conv": ([d[0] for d in done], kind), "cost": ([d[1] for d in done], pa.int64()), "audit": ([d[2] for d in done], pa.string())})
        if current is not _NEW:
            cost, audit = least_edits(bytes(codes))
            yield _batch({"conv": ([current], kind), "cost": ([cost], pa.int64()), "audit": ([audit], pa.string())})

    kind = rows.schema["conv"].dataType.simpleString()
    return _by_conversation(rows.select("conv", "place", code.alias("code")), run, f"conv {kind}, cost long, audit string")


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv, place, role, text of the turns after the edits of audits(), in order inside each partition.

    A conversation's edits are sorted before its turns, so both pass in one stream.
    """
    none = F.lit(None).cast("string")
    both = edits.select("conv", F.lit(0).cast("long").alias("place"), none.alias("role"), F.col("audit").alias("text"))
    both = both.unionByName(rows.select("conv", "place", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, place, role = None, "", 0, 0, ""
        out: list[tuple] = []

        def put(given: str | None, text: str) -> None:
            """A turn with a role of its own, or the one that must follow."""
            nonlocal place, role
            place, role = place + 1, given or ("assistant" if role[:1] == "u" else "user")
            out.append((conv, place, role, text))

        def put_in() -> None:
            nonlocal at
            while audit[at : at + 1] == "I":
                put(None, "")
                at += 1

        def made(kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 4
            out.clear()
            return _batch({"conv": (columns[0], kind), "place": (columns[1], pa.int64()), "role": (columns[2], pa.string()), "text": (columns[3], pa.string())})

        for batch in batches:
            kind = batch.column(0).type
            for begin in range(0, batch.num_rows, 512):
                some = batch.slice(begin, 512)
                for k, n, given, text in zip(*(c.to_pylist() for c in some.columns)):
                    if not n:
                        put_in()
                        conv, audit, at, place, role = k, text, 0, 0, ""
                        continue
                    put_in()
                    if audit[at] != "D":
                        put(given if audit[at] == "K" else None, text)
                    at += 1
                yield made(kind)
        put_in()
        if out:
            yield made(kind)

    kind = rows.schema["conv"].dataType.simpleString()
    return _by_conversation(both, run, f"conv {kind}, place long, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """conv, sha256 of "role:text" of repaired() turns joined by line ends, hashed as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = _NEW, None
        for batch in batches:
            done, kind = [], batch.column(0).type
            for conv, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place == 1:
                    if current is not _NEW:
                        done.append((current, digest.hexdigest()))
                    current, digest = conv, hashlib.sha256()
                digest.update(f"{'' if place == 1 else chr(10)}{role}:{text}".encode())
            yield _batch({"conv": ([d[0] for d in done], kind), "sha256": ([d[1] for d in done], pa.string())})
        if current is not _NEW:
            yield _batch({"conv": ([current], kind), "sha256": ([digest.hexdigest()], pa.string())})

    kind = turns.schema["conv"].dataType.simpleString()
    return turns.mapInArrow(run, f"conv {kind}, sha256 string")


def repair(chats: DataFrame, conv: str = "conv_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """judged() turns, audits() and repaired() turns of chats (conv, turn, role, text).

    Rows with a null conv are one conversation, rows with a null turn come first, repeated
    rows are duplicates; roles other than those that begin with s, u or a (the empty one
    too) are never kept. Other columns are ignored, whatever their names. A conversation
    without a turn worth keeping has an empty repair. No rows in, no rows out.
    """
    rows = materialise(judged(chats, conv), "turns")
    edits = materialise(audits(rows), "edits")
    return rows, edits, repaired(rows, edits)


def damaged(chats: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with a fifth of the turns dropped, emptied, stripped of full stops, repeated or given to the user."""
    one = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), one), F.coalesce(F.col("turn").cast("string"), one))
    rows = chats.select("conv_id", "turn", F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fate"))
    fate = F.col("fate")
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(fate == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(1), F.when(fate == 3, 2).otherwise(1))
    return rows.where(fate > 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations")
    rows, edits, turns = repair(damaged(chats))
    parts = reports(rows).unionByName(edits, True).unionByName(digests(turns), True)
    parts = parts.unionByName(chats.select(F.col("conv_id").alias("conv")), True)
    counts = [F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    audit, sha256 = F.coalesce(F.max("audit"), F.lit("")), F.coalesce(F.max("sha256"), F.sha2(F.lit(b""), 256))
    made = parts.groupBy("conv").agg(*counts, audit.alias("audit"), sha256.alias("repaired_sha256"))
    return made.withColumnRenamed("conv", "conv_id")
