"""Byte-pair encoding by an automaton compiled from the merges, and decoding by its labels.

The automaton reads tokens and accepts just the sequences that merging makes. It begins
as one state with an arc for every byte. Each merge (a, b) puts in a gadget: the state
behind a is copied without its arc b, a leads to the copy, and a new arc ab stands
beside every arc a, leading where b led. Copies are kept as differences: what the state
behind a label lost, and when. A state's arcs are then looked up through the label's
right parts (copies of copies) and the arc's left parts (arcs beside arcs), no further
back than the time of each.

Every beginning of a word is accepted in one way only. So the last arc of a word is the
one label at its end that leaves the state which the bytes before it lead to; the ways of
beginnings are remembered, as words share them. A long word is read forwards by trying
the arcs whose bytes come next, and a place once found to lead nowhere is never tried again.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_of
from .tokens import byte_letters, tokenizer_definition

#: Fixed value: Unicode's white space.
_WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space and what follows. No word reaches over the beginning of white space.
_CHUNKS = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
_INNER = re.compile(f"[{_WHITE}]")
#: White space before a space, or a space at the end: there a space does not begin white space or belong to what follows.
_WIDE = re.compile(f" (?:(?<=[{_WHITE}] )|$)")
#: Words that can be told apart without the library: a line end; a space and letters up to U+024F; marks.
_LATIN = re.compile(r"(\n?)( ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+)([.,;:!?)]*)")
#: Chunks that a worker remembers, and the longest of them.
KNOWN, KNOWN_CHARS = 250_000, 48
#: Bytes at the end of a word by which the labels that it may end with are remembered.
TAIL = 4
_NEVER = 1 << 62


class Automaton:
    """The automaton of a byte-level tokenizer: its labels are token ids."""

    def __init__(self, definition: str):
        told = json.loads(definition)
        model, cutter = told["model"], told["pre_tokenizer"] or {}
        plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter["add_prefix_space"]
        odd = told["normalizer"] or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges")
        odd = odd or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
        if not plain or odd or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in told["added_tokens"]):
            raise ValueError("not a plain byte-level tokenizer")
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        vocabulary = {token: i for token, i in model["vocab"].items() if token not in self.special}
        self.tokens = {i: bytes(byte_of[c] for c in token) for token, i in vocabulary.items()}
        self.tokens |= {i: content.encode() for content, i in self.special.items()}

        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.lost: dict[int, dict[int, int]] = {}  # label: the arcs that the state behind it lost, and when
        self._arcs: dict[int, bool] = {}
        live = [i for token, i in vocabulary.items() if len(token) == 1]
        for time, pair in enumerate(model["merges"]):
            one, two = pair.split(" ") if isinstance(pair, str) else pair
            a, b, ab = vocabulary[one], vocabulary[two], vocabulary[one + two]
            if ab in self.born:
                raise ValueError(f"two merges make token {ab}")
            if self._splice(a, b, ab, time):
                live.append(ab)
        self._arcs.clear()
        self.labels = {self.tokens[i]: i for i in live}
        self.coded = {i: struct.pack("<I", i) for i in self.tokens}
        self.reach: dict[bytes, int] = {}  # the longest label that begins with two bytes
        self.longer: dict[bytes, bytes] = {}  # ids of labels longer than TAIL
        sizes: dict[bytes, set[int]] = {}
        for label, i in self.labels.items():
            self.reach[label[:2]] = max(self.reach.get(label[:2], 1), len(label))
            if len(label) > TAIL:
                self.longer[label] = self.coded[i]
                sizes.setdefault(label[-TAIL:], set()).add(len(label))
        self.back = {tail: tuple(sorted(some, reverse=True)) for tail, some in sizes.items()}
        self._ways: dict[bytes, bytes] = {}
        self._ends: dict[bytes, bool] = {}
        self._tails: dict[bytes, tuple[tuple[int, bytes | None], ...]] = {}

    def _splice(self, a: int, b: int, ab: int, time: int) -> bool:
        """Put in the gadget of a merge; False if no arc b leaves the state behind a, so that ab is never read."""
        there = self._leaves(a, b, time)
        if there:
            self.lost.setdefault(a, {})[b] = time
        self.left[ab], self.right[ab], self.born[ab] = a, b, time
        return there

    def _leaves(self, behind: int, arc: int, before: int = _NEVER) -> bool:
        """Whether the state behind a label has an arc, as it was before a time."""
        copied = before
        while True:
            lost = self.lost.get(behind)
            if lost:
                part, added = arc, _NEVER
                while True:
                    when = lost.get(part, _NEVER)
                    if when < copied and when <= added:
                        return False
                    if part not in self.born:
                        break
                    part, added = self.left[part], self.born[part]
            if behind not in self.born:
                return True
            behind, copied = self.right[behind], min(copied, self.born[behind])

    def read(self, word: bytes) -> list[int]:
        """The labels on the one way through a word: arcs are tried from the longest, a place found dead is left for good."""
        labels, reach, arcs, end = self.labels, self.reach, self._arcs, len(word)
        if word in labels or not word:
            return [labels[word]] if word else []
        path, dead, place, behind = [], set(), 0, -1
        size = min(reach.get(word[:2], 1), end)
        while True:
            while size:
                arc = labels.get(word[place : place + size])
                if arc is not None and place + size not in dead:
                    if behind < 0:
                        break
                    key = behind << 32 | arc
                    leaves = arcs.get(key)
                    if leaves is None:
                        if len(arcs) > 4 * KNOWN:
                            arcs.clear()
                        leaves = arcs[key] = self._leaves(behind, arc)
                    if leaves:
                        break
                size -= 1
            else:
                dead.add(place)
                size = len(self.tokens[path.pop()])
                place -= size
                size -= 1
                behind = path[-1] if path else -1
                continue
            path.append(arc)
            place += size
            if place == end:
                return path
            behind, size = arc, min(reach.get(word[place : place + 2], 1), end - place)

    def ids(self, word: bytes) -> bytes:
        """The ids on the one way through a short word; the ways through its beginnings are remembered."""
        way = self._ways.get(word)
        if way is None:
            for held in (self._ways, self._ends, self._tails):
                if len(held) >= KNOWN:
                    held.clear()
            way = self._way(word) if word else b""
        return way

    def _way(self, word: bytes) -> bytes:
        """The way through a beginning not met before: arcs are tried from the longest label at its end."""
        ways, ends, tail = self._ways, self._ends, word[-TAIL:]
        last = self._tails.get(tail)
        if last is None:
            last = self._tails[tail] = self._last(tail)
        for size, id in last:
            if id is None:
                id = self.longer.get(word[-size:])
                if id is None:
                    continue
            start = word[:-size]
            if not start:
                ways[word] = id
                return id
            before = ways.get(start) or self._way(start)
            key = before[-4:] + id
            leaves = ends.get(key)
            if leaves is None:
                leaves = ends[key] = self._leaves(*struct.unpack("<II", key))
            if leaves:
                way = ways[word] = before + id
                return way
        raise ValueError("a byte without a token")

    def _last(self, tail: bytes) -> tuple[tuple[int, bytes | None], ...]:
        """Sizes and ids of the labels that a word with this end may end with, longest first; of those longer than the end, sizes only."""
        more = [(size, None) for size in self.back.get(tail, ())]
        fit = [(size, self.labels.get(tail[-size:])) for size in range(len(tail), 0, -1)]
        return (*more, *((size, self.coded[arc]) for size, arc in fit if arc is not None))


class Encoder(dict):
    """Ids of texts, as little-endian unsigned 32-bit integers.

    Holds the ids of a space and what follows it, by what follows; what was held before
    the last KNOWN pieces is forgotten in two steps.
    """

    def __init__(self, automaton: Automaton):
        from tokenizers.pre_tokenizers import ByteLevel

        self.automaton = automaton
        self.coded = automaton.coded
        self.earlier: dict[str, bytes] = {}
        names = sorted(automaton.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.splitter = ByteLevel(add_prefix_space=False)

    def __missing__(self, piece: str) -> bytes:
        out = self.earlier.get(piece)
        if out is None:
            told = _LATIN.fullmatch(" " + piece)
            if not told and _INNER.search(piece):
                return b"".join(map(self._chunk, _CHUNKS.findall(" " + piece)))
            out = self._latin(told) if told else self._new(" " + piece)
        if len(piece) <= KNOWN_CHARS:
            if len(self) >= KNOWN:
                self.earlier = self.copy()
                self.clear()
            self[piece] = out
        return out

    def _chunk(self, chunk: str) -> bytes:
        return self[chunk[1:]] if chunk[0] == " " and not _INNER.search(chunk, 1) else self._new(chunk)

    def _new(self, chunk: str) -> bytes:
        """The ids of a chunk not met before."""
        told = _LATIN.fullmatch(chunk)
        if told:
            return self._latin(told)
        return b"".join([self._word(chunk[begin:end]) for _, (begin, end) in self.splitter.pre_tokenize_str(chunk)])

    def _latin(self, told: re.Match) -> bytes:
        line, word, marks = told.groups()
        out = self._word(word)
        if marks:
            out += self._word(marks)
        return self._word(line) + out if line else out

    def _word(self, word: str) -> bytes:
        if len(word) <= KNOWN_CHARS:
            return self.automaton.ids(word.encode())
        return b"".join(map(self.coded.__getitem__, self.automaton.read(word.encode())))

    def ids(self, text: str) -> bytes:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        told = self.automaton.special
        return b"".join(self.coded[told[part]] if part in told else self._plain(part) for part in self.special.split(text))

    def _plain(self, text: str) -> bytes:
        if _WIDE.search(text):
            return b"".join(map(self._chunk, _CHUNKS.findall(text)))
        first, *rest = text.split(" ")
        return b"".join([*map(self._new, _CHUNKS.findall(first)), *map(self.__getitem__, rest)])


def table_of(tokens: dict[int, bytes]) -> np.ndarray:
    """The tokens as an array by id; ids without a token, and the last one, have no bytes."""
    table = np.full(max(tokens, default=-1) + 2, b"", object)
    for i, token in tokens.items():
        table[i] = token
    return table


def text_of_ids(ids: bytes, tokens: dict[int, bytes] | np.ndarray) -> str:
    """The labels' bytes, one after another; what is no UTF-8 becomes U+FFFD, unknown ids nothing. tokens may be their table_of()."""
    at = np.frombuffer(ids, "<u4")
    if isinstance(tokens, dict):
        parts = map(tokens.get, at.tolist(), repeat(b""))
    else:
        parts = tokens[np.minimum(at, len(tokens) - 1)].tolist()
    return b"".join(parts).decode("utf-8", "replace")


_encoders: dict[int, Encoder] = {}


def encode(docs: DataFrame, definition: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, ids (binary, little-endian unsigned 32-bit) of each document: the ids of the tokenizers library.

    definition is a tokenizer's JSON, of the size of its vocabulary. Names of special
    tokens in a text are those tokens. A null text is empty and has no ids; null and
    repeated document ids and repeated rows stay as they are; other columns are ignored,
    whatever their names. No rows in, no rows out. Texts are encoded whole, each in its
    row, without a shuffle.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(Automaton(definition)), hash(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _encoders:  # one for each worker process
            _encoders.clear()
            _encoders[name] = Encoder(shared.value)
        encoder = _encoders[name]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = pa.array([encoder.ids(t) for t in some.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), ids], names=["k", "ids"])

    kind = docs.schema[id].dataType.simpleString()
    made = docs.select(F.col(id).alias("k"), text_of(text).alias("t")).mapInArrow(run, f"k {kind}, ids binary")
    return made.toDF(id, "ids")


def decode(encoded: DataFrame, definition: str, id: str = "doc_id") -> DataFrame:
    """id, ids, decoded (string) of rows of encode(); null ids decode to the empty string. Other columns are ignored."""
    shared = encoded.sparkSession.sparkContext.broadcast(Automaton(definition).tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = pa.array([text_of_ids(ids or b"", table) for ids in some.column(1).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), texts], names=["k", "ids", "decoded"])

    kind = encoded.schema[id].dataType.simpleString()
    made = encoded.select(F.col(id).alias("k"), "ids").mapInArrow(run, f"k {kind}, ids binary, decoded string")
    return made.toDF(id, "ids", "decoded")


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    definition = tokenizer_definition(public_tokenizers.path("byte_bpe_50k.json"))
    both = decode(encode(table(spark, sf_dir, "documents"), definition), definition)
    return both.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
