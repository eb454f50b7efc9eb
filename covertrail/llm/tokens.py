"""Token ids in binary blocks: frequency-ranked, byte-aligned, control bytes apart.

Documents are range-partitioned by id and tokenised once. Ids are then replaced by
their rank in the corpus (most frequent first), and each rank takes 1 to 4 bytes. The
lengths stand apart, two bits each, four to a control byte, so numpy decodes a block by
looking its control bytes up in a table.

A token file is a Parquet file whose rows are self-contained blocks (part, block, n_ids,
payload), in document order; Spark's writer commits it, on any store, even if executors
are lost. Payload, little endian: magic, documents (uint32), ids (uint64); per document
id (int64), whether the id is not null (uint8), count (uint32); control bytes; data.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialise, scratch_path, table, text_of, utf8_of

MAGIC = b"CTVB0001"
_HEAD = struct.Struct("<8sIQ")
#: Ids (about) and documents (at most) of one block.
BLOCK_IDS = 1 << 18
BLOCK_DOCS = 1 << 12
#: Words whose ids a worker remembers.
CACHE_WORDS = 1_000_000

#: Bytes of the pieces that are remembered; of texts cut at once; slots of the table, as a power of two.
WORD_BYTES = 64
AT_ONCE = 1 << 19
SLOT_BITS = 21

_MARKS = [b".", b",", b";", b":", b"!", b"?"]
#: A space or line end, letters up to U+024F, and perhaps one mark.
_PLAIN = re.compile(rb"[ \n](?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF]|[\xC4-\xC8][\x80-\xBF]|\xC9[\x80-\x8F])+[.,;:!?]?")


def byte_letters() -> dict[int, str]:
    """The characters by which byte-level vocabularies write bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_ALPHABET = byte_letters() | {0: " "}
_LENGTHS = np.array([[(byte >> 2 * i & 3) + 1 for i in range(4)] for byte in range(256)], np.uint8)
_AT = np.arange(4, dtype=np.uint8)


def pack(values: np.ndarray) -> bytes:
    """Control bytes, then data bytes, of unsigned 32-bit values."""
    values = values.astype("<u4")
    lengths = 1 + (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = lengths - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[_AT < lengths[:, None]]
    return control.tobytes() + data.tobytes()


def unpack(coded: bytes, n: int) -> np.ndarray:
    """The n values that pack() was given."""
    control = np.frombuffer(coded, np.uint8, -(-n // 4))
    lengths = _LENGTHS[control].ravel()[:n]
    out = np.zeros((n, 4), np.uint8)
    out[_AT < lengths[:, None]] = np.frombuffer(coded, np.uint8, offset=len(control))
    return out.view("<u4").ravel()


class _Known:
    """Ids of the words met so far: an open-addressed table in numpy, asked for many words at once.

    A word's key is a 63-bit hash; its check holds its length and seven of its bytes.
    """

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.keys, self.checks, self.values = (np.zeros(1 << SLOT_BITS, t) for t in (np.uint64, np.uint64, np.int64))
        self.words, self.size = 0, 0
        self.ids = np.zeros(1 << 16, np.uint32)

    def store(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Keep ids and give each word's value: where its ids begin, and 32 bits for how many."""
        if self.size + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.size], np.zeros(2 * (self.size + len(ids)), np.uint32)])
        self.ids[self.size : self.size + len(ids)] = ids
        begin = self.size + np.cumsum(counts) - counts
        self.size += len(ids)
        return begin << 32 | counts

    def add(self, keys: np.ndarray, checks: np.ndarray, values: np.ndarray) -> None:
        """Keep distinct keys; one that is there already is replaced."""
        self.words += len(keys)
        at, mask = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64), (1 << SLOT_BITS) - 1
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[at[todo]] == 0]
            self.keys[at[free]] = keys[free]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = at[todo] + 1 & mask
        self.checks[at], self.values[at] = checks, values

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The words' values, -1 for unknown ones."""
        at, mask = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64), (1 << SLOT_BITS) - 1
        held = self.keys[at]
        wrong = np.flatnonzero((held != keys) & (held != 0))
        while len(wrong):
            at[wrong] = at[wrong] + 1 & mask
            held[wrong] = self.keys[at[wrong]]
            wrong = wrong[(held[wrong] != keys[wrong]) & (held[wrong] != 0)]
        return np.where((held == keys) & (self.checks[at] == checks), self.values[at], -1)


class Encoder:
    """Ids of texts by a byte-level tokenizer, with the words it met remembered.

    Such a tokenizer never joins what stands before a space or line end to what follows,
    unless that too is a space or line end. Texts are cut there, and each distinct piece
    is encoded once: by the whole tokenizer, or, if it is plain letters, by its merges
    alone, since it is one piece to it. The ids are the same.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        told = json.loads(definition)
        cutter = told["pre_tokenizer"] or {}
        if cutter.get("type") != "ByteLevel" or cutter["add_prefix_space"] or not cutter["use_regex"] or told["normalizer"] or told["post_processor"]:
            raise ValueError("not a plain byte-level tokenizer")
        self.tokenizer = Tokenizer.from_str(definition)
        self.merges = Tokenizer.from_str(json.dumps(told | {"pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": " "}, "added_tokens": []}))
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)  # ids whose token begins with a space or line end
        self.begins[[i for token, i in vocabulary.items() if token[0] in "ĠĊ"]] = True
        self.known = _Known()
        self.random = np.random.default_rng(1).integers(0, 1 << 64, 256 * WORD_BYTES, np.uint64)

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and each text's number of ids.

        data: the texts' UTF-8, joined; ends: where each text ends in it.
        """
        begins = np.r_[0, ends[:-1]].astype(np.int64)
        breaks = (data == 32) | (data == 10)
        cut = breaks.copy()
        cut[1:] &= ~breaks[:-1]
        cut[begins[ends > begins]] = True
        starts = np.flatnonzero(cut)
        stops = np.r_[starts[1:], len(data)] if len(starts) else starts
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(stops, starts[at] + AT_ONCE, "right")))
            if self.known.words > CACHE_WORDS or self.known.size > 8 * CACHE_WORDS:
                self.known.clear()
            base = starts[at]
            made = self._values if to - at > 1 else self._learn  # a piece alone may be huge
            value = made(data[base : stops[to - 1]], starts[at:to] - base, stops[at:to] - base)
            n = value & 0xFFFFFFFF
            total = int(n.sum())
            where = np.repeat((value >> 32) - (np.cumsum(n) - n), n) + np.arange(total)
            ids.append(self.known.ids[where])
            counts.append(n)
            at = to
        before = np.cumsum(np.concatenate(counts))
        return np.concatenate(ids), before[np.searchsorted(starts, ends)] - before[np.searchsorted(starts, begins)]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        ids, counts = self.encode(*utf8_of(pa.array(texts, pa.string())))
        return np.split(ids, np.cumsum(counts)[:-1])

    def _values(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Each piece's value in the table of known words; new ones are learnt."""
        lengths = stops - starts
        place = np.arange(len(data)) - np.repeat(starts, lengths)
        keys = np.add.reduceat(self.random[data + 256 * (place & WORD_BYTES - 1)], starts) | np.uint64(1)
        checks = lengths.astype(np.uint64)
        for k in (1, 2, 3, 4):
            checks = checks << np.uint64(8) | data[np.minimum(starts + k, stops - 1)]
        for k in (1, 2, 3):
            checks = checks << np.uint64(8) | data[np.maximum(stops - k, starts)]
        short = lengths <= WORD_BYTES
        value = np.where(short, self.known.find(keys, checks), -1)
        new = np.flatnonzero((value < 0) & short)
        if len(new):
            distinct, first = np.unique(keys[new], return_index=True)
            first = new[first]
            learnt = self._learn(data, starts[first], stops[first])
            self.known.add(distinct, checks[first], learnt)
            of = np.searchsorted(distinct, keys[new])
            value[new] = np.where(checks[new] == checks[first[of]], learnt[of], -1)
        rest = np.flatnonzero(value < 0)  # long pieces, and two words with one key
        if len(rest):
            value[rest] = self._learn(data, starts[rest], stops[rest])
        return value

    def _learn(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Encode pieces, keep their ids and give their values."""
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts.tolist(), stops.tolist())]
        plain = np.array([_PLAIN.fullmatch(w) is not None for w in words])
        value = np.zeros(len(words), np.int64)
        easy = np.flatnonzero(plain).tolist()
        if easy:
            ids, counts = self._merged([words[i] for i in easy])
            value[easy] = self.known.store(ids, counts)
        hard = np.flatnonzero(~plain).tolist()
        if hard:
            got = [e.ids for e in self.tokenizer.encode_batch_fast([words[i].decode() for i in hard], add_special_tokens=False)]
            value[hard] = self.known.store(np.array([x for ids in got for x in ids], np.uint32), np.array([len(ids) for ids in got], np.int64))
        return value

    def _merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that match _PLAIN, joined, and their numbers.

        A line end before letters and a mark after them are pieces of their own to the
        tokenizer. Each piece is known again by its first id.
        """
        parts = []
        for at in range(0, len(words), 2000):
            joined = b"\0".join(words[at : at + 2000]).replace(b"\n", b"\n\0")
            for mark in _MARKS:
                joined = joined.replace(mark, b"\0" + mark)
            parts.append(joined.decode("latin-1").translate(_ALPHABET))
        ids = np.array([x for e in self.merges.encode_batch_fast(parts, add_special_tokens=False) for x in e.ids], np.uint32)
        cuts = np.flatnonzero(self.begins[ids])
        return ids, np.diff(np.r_[cuts, len(ids)])


_encoders: dict[int, Encoder] = {}


def _encoder(definition: str) -> Encoder:
    """One for each worker process."""
    key = hash(definition)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(definition)
    return _encoders[key]


_RAW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("docs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("ids", pa.binary())])
_CODED = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("payload", pa.binary())])


def tokenise(docs: DataFrame, definition: str, end_id: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of raw ids, in ascending id order; part numbers follow the order too."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, block = _encoder(shared.value), TaskContext.get().partitionId(), 0
        kind = "<u2" if len(encoder.begins) <= 1 << 16 else "<u4"
        ids: list[np.ndarray] = []
        of: list[int | None] = []
        size = 0

        def out() -> pa.RecordBatch:
            raw = np.concatenate(ids).astype(kind).tobytes()
            row = [[part], [block], [of], [[len(x) for x in ids]], [size], [raw]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _RAW)], schema=_RAW)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                data, ends = utf8_of(some.column("t"))
                joined, counts = encoder.encode(data, ends)
                to = np.cumsum(counts)
                for doc, a, b in zip(some.column("id").to_pylist(), (to - counts).tolist(), to.tolist()):
                    if ids and (size + b - a + 1 > BLOCK_IDS or len(ids) == BLOCK_DOCS):
                        yield out()
                        ids, of, size, block = [], [], 0, block + 1
                    ids.append(np.append(joined[a:b], np.uint32(end_id)))
                    of.append(doc)
                    size += b - a + 1
        if ids:
            yield out()

    t = text_of(text)
    rows = docs.select(F.col(id).cast("long").alias("id"), t.alias("t"), F.xxhash64(t).alias("h"))
    ordered = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h").select("id", "t")
    return ordered.mapInArrow(run, "part int, block int, docs array<bigint>, counts array<int>, n_ids long, ids binary")


def _width(n_ids: int, raw: bytes) -> str:
    return "<u2" if len(raw) == 2 * n_ids else "<u4"


def rank_ids(raw: DataFrame) -> np.ndarray:
    """The ids that occur, most frequent first, ties by id: at most the vocabulary's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for n, ids in zip(batch.column("n_ids").to_pylist(), batch.column("ids")):
                more = np.bincount(np.frombuffer(ids.as_py(), _width(n, ids.as_py())))
                if len(more) > len(counts):
                    more, counts = counts, more
                counts = counts.astype(np.int64)
                counts[: len(more)] += more
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "n"])

    ranked = raw.select("n_ids", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = ranked.collect()  # a row for each id of the vocabulary at most
    return np.array([r.id for r in sorted(rows, key=lambda r: (-r.n, r.id))], "<u4")


def encode(raw: DataFrame, ranked: np.ndarray) -> DataFrame:
    """part, block, n_ids, payload of raw blocks."""
    shared = raw.sparkSession.sparkContext.broadcast(ranked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.zeros(int(shared.value.max(initial=0)) + 1, "<u4")
        rank[shared.value] = np.arange(len(shared.value))
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], _width(row["n_ids"], row["ids"]))
                out = [[row["part"]], [row["block"]], [row["n_ids"]], [head(row["docs"], row["counts"]) + pack(rank[ids])]]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, _CODED)], schema=_CODED)

    return raw.mapInArrow(run, "part int, block int, n_ids long, payload binary")


def head(docs: list[int | None], counts: list[int]) -> bytes:
    """The payload up to the control bytes."""
    ids = np.array([0 if d is None else d for d in docs], "<i8")
    held = np.array([d is not None for d in docs], np.uint8)
    return _HEAD.pack(MAGIC, len(docs), sum(counts)) + ids.tobytes() + held.tobytes() + np.array(counts, "<u4").tobytes()


def decode(payload: bytes, ranked: np.ndarray) -> list[tuple[int | None, np.ndarray]]:
    """The documents of a block: id, token ids."""
    magic, n_docs, n_ids = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = _HEAD.size
    docs = np.frombuffer(payload, "<i8", n_docs, at)
    held = np.frombuffer(payload, np.uint8, n_docs, at + 8 * n_docs)
    counts = np.frombuffer(payload, "<u4", n_docs, at + 9 * n_docs).astype(np.int64)
    ids = ranked[unpack(payload[at + 13 * n_docs :], n_ids)]
    cuts = np.cumsum(counts)
    return [(int(d) if ok else None, ids[b - n : b]) for d, ok, n, b in zip(docs, held, counts, cuts)]


def write_tokens(docs: DataFrame, path: str, definition: str, end_id: int = 0, id: str = "doc_id", text: str = "text") -> None:
    """Write token files to path/blocks and the ranked ids to path/ranks.

    Null texts are empty: the end id alone. Documents go in ascending id order (null
    first; equal ids by the texts' hash, repeated rows each written); other columns are
    ignored. An empty docs writes no blocks.
    """
    raw = materialise(tokenise(docs, definition, end_id, id, text), "ids")
    ranked = rank_ids(raw)
    encode(raw, ranked).write.option("compression", "zstd").parquet(f"{path}/blocks")
    spark = docs.sparkSession
    discard(spark, raw)
    rows = [(ranked.tobytes(),)]
    spark.createDataFrame(rows, "ids binary").write.parquet(f"{path}/ranks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it; it is put together from sums over
    parts, over the blocks of a part, and inside the block.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    ranks = spark.read.parquet(f"{path}/ranks").first()["ids"]
    shared = spark.sparkContext.broadcast(np.frombuffer(ranks, "<u4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                docs, starts, counts, sums, at = [], [], [], [], 0
                for doc, ids in decode(row["payload"], shared.value):
                    docs.append(doc)
                    starts.append(at)
                    counts.append(len(ids))
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    at += len(ids)
                n = len(docs)
                columns = [pa.array([row["part"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()), *(pa.array(x, pa.int64()) for x in (docs, starts, counts, sums))]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32"])

    found = blocks.select("part", "block", "payload").mapInArrow(run, "part int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.select("part", F.coalesce(F.sum("n").over(earlier(Window.orderBy("part"))), F.lit(0)).alias("before_part"))
    in_part = blocks.select("part", "block", F.coalesce(F.sum("n_ids").over(earlier(Window.partitionBy("part").orderBy("block"))), F.lit(0)).alias("before_block"))
    begun = in_part.join(parts, "part").select("part", "block", (F.col("before_part") + F.col("before_block")).alias("before"))
    return found.join(begun, ["part", "block"]).select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def tokenizer_definition(path: str) -> str:
    """A tokenizers JSON file, read once on the driver; tasks get its text."""
    return Path(path).read_text(encoding="utf-8")


def token_rows(docs: DataFrame, name: str) -> DataFrame:
    """Write token files of docs to the scratch folder, where they stay until the application ends, and read them back."""
    import public_tokenizers

    spark = docs.sparkSession
    path = scratch_path(spark, name)
    write_tokens(docs, path, tokenizer_definition(public_tokenizers.path("byte_bpe_50k.json")))
    return read_tokens(spark, path)


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(table(spark, sf_dir, "documents"), "tokens")
