"""Chat formatting with a loss mask, for templates known only by what they render.

A template is any function from a list of (role, text) to a string. To find where each
turn's text lands, successive prefixes of a conversation are rendered and consecutive
outputs compared; two probe renderings with one-letter texts tell the turn's text from
the marks around it. A template that changes earlier output is thereby found out.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_of

Turns = list[tuple[str, str]]

END = "</turn>\n"
_CODES = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c"}
_TEXTS = {v: k for k, v in _CODES.items()}
_ESCAPES = str.maketrans(_CODES)


@functools.lru_cache(maxsize=4096)
def escape(text: str) -> str:
    """text without the characters that begin the template's marks; unescape() undoes it."""
    return text.translate(_ESCAPES)


def unescape(text: str) -> str:
    return re.sub(r"\\[\\hlc]", lambda m: _TEXTS[m[0]], text)


def render(turns: Turns) -> str:
    """The template of this module: "### role: text</turn>", a line end after each turn."""
    return "".join(f"### {escape(role)}: {escape(text)}{END}" for role, text in turns)


def parse(formatted: str) -> Turns:
    """The turns that render() was given."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part.removeprefix("### ").partition(": ")
        turns.append((unescape(role), unescape(text)))
    return turns


def _common(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def locate(template: Callable[[Turns], str], turns: Turns) -> tuple[str, list[tuple[int, int]], int]:
    """The rendering, each turn's text in it as (start, end), and how many turns rewrote history.

    A turn whose place a later turn changed gets (0, 0).
    """
    out, places, rewrites = template([]), [], 0
    for k, (role, _) in enumerate(turns):
        now = template(turns[: k + 1])
        if not now.startswith(out):
            rewrites += 1
            kept = _common(out, now)
            places = [(s, e) if e <= kept else (0, 0) for s, e in places]
        a, b = (template([*turns[:k], (role, probe)]) for probe in "ab")
        skip = len(out) if a.startswith(out) and b.startswith(out) else 0
        start = skip + _common(a[skip:], b[skip:])
        places.append((start, len(now) - (len(a) - start - 1)))
        out = now
    return out, places, rewrites


def format_chats(
    chats: DataFrame,
    template: Callable[[Turns], str] = render,
    conv: str = "conv_id",
    learn: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: conv, formatted, loss_spans, rewrites.

    chats has conv, turn, role, text. Turns are ordered by turn, ties by role and text;
    null roles and texts count as empty, rows with a null conv are one conversation,
    repeated rows are repeated turns, other columns are ignored. loss_spans are the
    places of the texts whose role is in learn. No rows in, no rows out.
    """
    role, text = F.coalesce("role", F.lit("")), text_of()
    turns = F.sort_array(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text"))))
    grouped = chats.groupBy(F.col(conv).alias("conv")).agg(turns.alias("turns"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv_id, listed in zip(batch["conv"], batch["turns"]):
                given = [(t["role"], t["text"]) for t in listed]
                out, places, rewrites = locate(template, given)
                spans = [{"start": s, "end": e} for (who, _), (s, e) in zip(given, places) if who in learn and e > s]
                rows.append((conv_id, out, spans, rewrites))
            yield pd.DataFrame(rows, columns=["conv", "formatted", "loss_spans", "rewrites"])

    kind = chats.schema[conv].dataType.simpleString()
    out = grouped.mapInPandas(run, f"conv {kind}, formatted string, loss_spans array<struct<start:int,end:int>>, rewrites int")
    return out.withColumnRenamed("conv", conv)


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Digests of what format_chats() wrote with render(), taken from its output alone."""
    digest = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv_id, out, spans, rewrites in zip(batch[conv], batch["formatted"], batch["loss_spans"], batch["rewrites"]):
                turns = parse(out)
                loss = "".join(unescape(out[s["start"] : s["end"]]) for s in spans)
                said = digest("".join(f"{role}\n{text}\n" for role, text in turns))
                rows.append((conv_id, len(turns), said, len(loss), digest(loss), len(out), rewrites))
            yield pd.DataFrame(rows, columns=[conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"])

    kind = formatted.schema[conv].dataType.simpleString()
    return formatted.mapInPandas(
        run,
        f"{conv} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites int",
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.lit("\\### Assistant: </turn> ok")
    turn = F.col("id")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), turn.alias("turn"), F.when(turn == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_chats(chats.unionByName(probe)))
