"""Substring dedup by relative Lempel-Ziv parsing over sampled reference blocks.

Every document is a reference for those with larger ids. Its index is sampled by content:
of the five-word blocks in each window of 13 words the one with the least hash is an
anchor, so two equal windows always hold the same anchor, at the same place. A reference
block is an anchor with the 8 words before and after it, all windows that hold the anchor.

1. Blocks equal to a block of an earlier document match it whole, without any window.
2. The others whose anchor occurs in an earlier document are cut into windows, which are
   matched one by one: these are the ends of repeated passages and chance anchors.
3. Matches of one document with one place of another are joined to the longest match. The
   document is then parsed greedily: at each word the match that reaches farthest is the
   next factor. At a boundary a factor is extended back over the last one, as far as its
   own match goes, so windows that straddle two factors count too; extended factors of
   13 words or more are duplicate spans.

Texts are hashed in Arrow batches, once for blocks and once for windows; keys are grouped
and joined by Spark. Frequent passages combine before the shuffle, and joins on them can
be split. Blocks are equal if two 64-bit hashes of theirs are, windows by 96 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialise, table, text_of, utf8_of

WINDOW = 13
BLOCK = 5
#: Words before and after an anchor that windows with it can reach.
AROUND = WINDOW - BLOCK
#: Bytes of a word that are hashed by table, longer words by xxhash; bytes of text worked at once.
WORD_BYTES = 64
AT_ONCE = 1 << 19
_FACTORS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_RANDOM = np.random.default_rng(9).integers(0, 1 << 64, 256 * WORD_BYTES, np.uint64)

_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("earlier", pa.int64())]))


def words_of_text(text: str) -> list[bytes]:
    """The words between spaces and tab to carriage return, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of texts joined as UTF-8, and each text's number of words."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = np.r_[0, ends[:-1]].astype(np.int64)
    some = ends > begins
    first[begins[some]] = inside[begins[some]]
    last[ends[some] - 1] = inside[ends[some] - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(stops, starts[at] + AT_ONCE, "right")))
        base, sizes = starts[at], np.minimum(stops[at:to] - starts[at:to], WORD_BYTES)
        where = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(where, sizes)
        letters = data[np.repeat(starts[at:to], sizes) + place]
        out[at:to] = np.add.reduceat(_RANDOM[letters + 256 * place], where)
        at = to
    for i in np.flatnonzero(stops - starts > WORD_BYTES):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : stops[i]].tobytes())
    return out, np.searchsorted(starts, ends) - np.searchsorted(starts, begins)


def _runs(hashes: np.ndarray, size: int, factor: np.uint64) -> np.ndarray:
    """A hash of every run of so many words, put together from runs of powers of two."""
    out, done, run, length = None, 0, hashes, 1
    power = lambda n: np.uint64(pow(int(factor), n, 1 << 64))
    while length <= size:
        if size & length:
            n = len(hashes) - done - length + 1
            out = run[:n] if out is None else out[:n] * power(length) + run[done : done + n]
            done += length
        if 2 * length <= size:
            run = run[: len(run) - length] * power(length) + run[length:]
        length *= 2
    out = out ^ (out >> np.uint64(31))
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def _sliding(values: np.ndarray, size: int, pick: Callable) -> np.ndarray:
    """pick (minimum or maximum) over every run of so many values."""
    out, length = values, 1
    while 2 * length <= size:
        out = pick(out[:-length], out[length:])
        length *= 2
    return pick(out[: len(out) - size + length], out[size - length :]) if length < size else out


class Batch:
    """Word hashes of some texts in a row, with AROUND fillers before, between and after them."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        hashes, counts = word_hashes(data, ends)
        self.counts = counts
        #: where each text begins in hashes
        self.first = AROUND + np.cumsum(counts + AROUND) - (counts + AROUND)
        size = AROUND + int((counts + AROUND).sum())
        of = np.repeat(np.arange(len(counts)), counts)
        at = self.first[of] + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.hashes = np.full(size, 0x5BD1E9955BD1E995, np.uint64)
        self.hashes[at] = hashes
        self.left = np.zeros(size, np.int64)  # words from here to the text's end
        self.left[at] = self.first[of] + counts[of] - at

    def anchors(self) -> tuple[np.ndarray, ...]:
        """Of each anchor: its text, place there, words up to its reference block's end, the hash of its five words, of its block.

        Equal hashes are all anchors, so a window has the same ones wherever it stands.
        """
        if len(self.hashes) <= WINDOW + AROUND:
            nothing = np.zeros(0, np.int64)
            return nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
        blocks, least = self._least()
        # a block is an anchor if it is the least of a window that holds it
        bound = _sliding(np.r_[np.zeros(AROUND, np.uint64), least, np.zeros(AROUND, np.uint64)], AROUND + 1, np.maximum)
        at = np.flatnonzero(blocks == bound[: len(blocks)])
        text = np.searchsorted(self.first, at, "right") - 1
        around = _runs(self.hashes, WINDOW + AROUND, _FACTORS[1])
        return text, at - self.first[text], np.minimum(self.left[at], WINDOW), blocks[at], around[at - AROUND]

    def _least(self) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every block, and the least hash of a block in every window; 0 where there is no window."""
        blocks = _runs(self.hashes, BLOCK, _FACTORS[0])
        least = _sliding(blocks, AROUND + 1, np.minimum)
        return blocks, np.where(self.left[: len(least)] >= WINDOW, least, np.uint64(0))

    def windows(self, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each window whose anchor stands at one of these places: its text, its place, and two hashes."""
        blocks, least = self._least()
        place = self.first[text] + at
        starts = (place[:, None] - np.arange(AROUND + 1)).ravel()
        of = np.repeat(place, AROUND + 1)
        starts = np.unique(starts[(starts >= 0) & (least[np.clip(starts, 0, len(least) - 1)] == blocks[of])])
        wide, more = _runs(self.hashes, WINDOW, _FACTORS[0])[starts], _runs(self.hashes, WINDOW, _FACTORS[1])[starts]
        text = np.searchsorted(self.first, starts, "right") - 1
        return text, starts - self.first[text], wide, (more >> np.uint64(32)).astype(np.uint32)


def parse(starts: np.ndarray, ends: np.ndarray, earlier: np.ndarray, shift: np.ndarray) -> list[tuple[int, int, int]]:
    """Greedy parse of matches into extended factors: (first word, end, document).

    Matches with one document at one shift that meet or overlap are one.
    """
    order = np.lexsort((starts, shift, earlier))
    starts, ends, earlier, shift = (x[order] for x in (starts, ends, earlier, shift))
    # ends grow with starts, as all matches are at most a reference block long
    new = np.r_[True, (np.diff(earlier) != 0) | (np.diff(shift) != 0) | (starts[1:] > ends[:-1])]
    begins = np.flatnonzero(new)
    starts, ends, earlier = starts[begins], np.maximum.reduceat(ends, begins), earlier[begins]
    order = np.argsort(starts, kind="stable")
    out, reached, best = [], -1, None
    for s, e, d in zip(starts[order].tolist(), ends[order].tolist(), earlier[order].tolist()):
        if s > reached:  # no match covers the next word: the farthest one so far ends here
            if best:
                out.append(best)
                reached, best = best[1], None
            if s > reached:
                reached = s
        if e > (best[1] if best else reached if out and out[-1][1] == reached else -1):
            best = (s, e, d)
    return out + [best] if best else out


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Batch]]:
    """The batch in pieces of a few hundred texts, and few bytes unless a text is long."""
    data, ends = utf8_of(batch.column("t"))
    at = 0
    while at < batch.num_rows:
        base = int(ends[at - 1]) if at else 0
        to = min(max(at + 1, int(np.searchsorted(ends, base + 4 * AT_ONCE, "right"))), at + 512)
        yield batch.slice(at, to - at), Batch(data[base : int(ends[to - 1])], ends[at:to] - base)
        at = to


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, around, id, key, at, right for each anchor."""
    for batch in batches:
        for some, words in _rows(batch):
            text, at, right, block, around = words.anchors()
            id, key = (some.column(c).to_numpy(zero_copy_only=False)[text] for c in ("id", "key"))
            columns = [block.view(np.int64), around.view(np.int64), id, key, at.astype(np.int32), right.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["block", "around", "id", "key", "at", "right"])


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """h, g, id, key, at for each window whose anchor is marked."""
    for batch in batches:
        for some, words in _rows(batch):
            marks = some.column("marks")
            text = np.repeat(np.arange(len(marks)), marks.value_lengths().to_numpy(zero_copy_only=False))
            text, at, h, g = words.windows(text, marks.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            id, key = (some.column(c).to_numpy(zero_copy_only=False)[text] for c in ("id", "key"))
            columns = [h.view(np.int64), g.view(np.int32), id, key, at.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["h", "g", "id", "key", "at"])


def _parse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, key, spans of each document's matches."""
    for batch in batches:
        spans = []
        for row in batch.column("matches"):
            start, end, earlier, shift = (row.values.field(c).to_numpy() for c in ("start", "end", "earlier", "shift"))
            spans.append([{"start": s, "end": e, "earlier": d} for s, e, d in parse(start, end, earlier, shift)])
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(spans, _SPAN)], names=["id", "key", "spans"])


def duplicate_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with spans: array of (start, end, earlier), word places that repeat an earlier document.

    Spans may overlap where factors meet. Windows are judged on the input. Rows with one
    id are one document: they are never earlier than each other. A null id counts as
    later than all others; null and short texts have no spans; columns named spans are
    replaced.
    """
    spark = docs.sparkSession
    t = text_of(text)
    number = F.coalesce(F.col(id).cast("long"), F.lit(2**63 - 1))
    of = [c for c in docs.columns if c != "spans"]
    keyed = docs.select(t.alias("t"), number.alias("id"), F.xxhash64(t).alias("key"))
    lists = F.array().cast("array<struct<start:int,end:int,earlier:bigint>>")

    rows = materialise(keyed.mapInArrow(_anchor_rows, "block long, around long, id long, key long, at int, right int"), "anchors")
    shared = rows.groupBy("block").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("block")
    shared = materialise(shared, "shared")
    discard(spark)
    rows_shared = materialise(rows.join(shared, "block", "left_semi"), "blocks")
    discard(spark, rows, shared)

    first = F.min(F.struct("id", "at")).alias("first")
    least = materialise(rows_shared.groupBy("block", "around").agg(first), "least")
    met = materialise(rows_shared.join(least, ["block", "around"]), "met")
    discard(spark, rows_shared)
    left = F.least(F.col("at"), F.lit(AROUND))
    whole = met.where("first.id < id").select(
        "id", "key", F.struct((F.col("at") - left).alias("start"), (F.col("at") + F.col("right")).alias("end"), F.col("first.id").alias("earlier"), (F.col("first.at") - F.col("at")).alias("shift")).alias("match")
    )

    contested = least.groupBy("block").agg(F.min("first.id").alias("low"), F.max("first.id").alias("high")).where("low < high")
    marks = met.where("first.id = id").join(contested, "block", "left_semi").groupBy("id", "key").agg(F.collect_set("at").alias("marks"))
    marks = materialise(marks, "marks")
    found = keyed.join(marks, ["id", "key"]).select("t", "id", "key", "marks").mapInArrow(_window_rows, "h long, g int, id long, key long, at int")
    found = materialise(found, "windows")
    discard(spark, least, marks)
    earliest = found.groupBy("h", "g").agg(first, F.max("id").alias("high")).where("first.id < high").select("h", "g", "first")
    earliest = materialise(earliest, "earliest")
    single = found.join(earliest, ["h", "g"]).where("first.id < id").select(
        "id", "key", F.struct("at", (F.col("at") + WINDOW).alias("end"), F.col("first.id").alias("earlier"), (F.col("first.at") - F.col("at")).alias("shift")).alias("match")
    )
    kind = "struct<start:int,end:int,earlier:bigint,shift:int>"
    matches = whole.select("id", "key", F.col("match").cast(kind)).unionByName(single.select("id", "key", F.col("match").cast(kind)))
    matches = materialise(matches.groupBy("id", "key").agg(F.collect_set("match").alias("matches")), "matches")
    discard(spark, met, found, earliest)

    spans = matches.mapInArrow(_parse_rows, "id long, key long, spans array<struct<start:int,end:int,earlier:bigint>>").withColumnsRenamed({"id": "_id", "key": "_key", "spans": "_spans"})
    tagged = docs.select(F.struct(*of).alias("own"), number.alias("id"), F.xxhash64(t).alias("key"))
    joined = tagged.join(spans, (F.col("id") == F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    return joined.select("own.*", F.coalesce("_spans", lists).alias("spans"))


def kept_words(words: list[bytes], starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The words outside all spans."""
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(steps)[:-1] == 0)]


def remove_spans(spanned: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_words, n_removed and kept, the words outside spans joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for said, spans in zip(batch.column("t"), batch.column("spans")):
                words = words_of_text(said.as_py())
                left = kept_words(words, spans.values.field("start").to_numpy(), spans.values.field("end").to_numpy()) if len(spans) else words
                for column, x in zip(out, (len(words), len(words) - len(left), b" ".join(left).decode("utf-8", "surrogatepass"))):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], names=["id", "n_words", "n_removed", "kept"]
            )

    kind = spanned.schema[id].dataType.simpleString()
    rows = spanned.select(F.col(id).alias("id"), text_of(text).alias("t"), "spans")
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_removed long, kept string").withColumnRenamed("id", id)


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_spans(duplicate_spans(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
