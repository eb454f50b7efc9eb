"""Benchmark decontamination: SimHash windows, Hamming blocks, exact verification.

A document leaks an item if some window of as many words as the item has a weighted
(multiset) Jaccard similarity of 0.8 or more with it, on shingles of five words.

1. Such a window shares a shingle with its item, and moving its start to the first
   shared shingle loses none. So only windows that start at a shingle of the item are
   made, and only where enough of the item's shingles follow within the window (at
   similarity 0.8, eight ninths of them): the rest cannot be similar, by counting.
2. Each window and item gets a 64-bit SimHash. Fingerprints are cut into 8 blocks of 8
   bits; two that differ in at most 19 bits have a block with at most 2 differences.
   Items emit every such block value, windows their own, and they meet by equality.
3. Pairs within 19 bits are verified by their exact similarity.

At similarity 0.8 two fingerprints differ in 9.7 bits on average (standard deviation
2.9), so a radius of 19 misses 4 in 10,000 pairs at the very threshold, fewer above.

Texts are read twice: once to test their shingles in the row against a bitmap, and then
those that hold enough of an item. All steps are SQL.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.classic import column as classic

from .common import discard, materialise, table, text_of

SHINGLE = 5
#: Percent of similarity that makes a leak.
SIMILARITY = 80
RADIUS = 19
BLOCKS, BLOCK_BITS = 8, 8
#: Bits of the largest bitmap (8 MB in each task); a benchmark of more shingles is joined without one.
BITMAP_BITS = 1 << 26
#: Rows (some 40 bytes each) that are broadcast; larger tables are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def _words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _let(value: Column, then) -> Column:
    """then(value), with value computed once."""
    return F.transform(F.array(value), then)[0]


def _once(value: Column) -> Column:
    """The fields of a struct as columns, computed once: Spark repeats other expressions where they are used."""
    return F.inline(F.array(value))


def _shingles(words: Column, size: Column) -> Column:
    """All runs of so many words, as strings."""
    starts = F.sequence(F.lit(1), F.size(words) - size + 1)
    made = F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " "))
    return F.when(F.size(words) >= size, made).otherwise(F.array().cast("array<string>"))


def _simhash(shingles: Column, planes: int) -> Column:
    """64 bits: 1 where more than half of the shingles' hashes have it.

    All 64 counts grow together: long j holds bit j of each count, and adding a hash is
    a carry from one long to the next. planes longs hold counts below 2 ** planes.
    """
    zero, half = F.lit(0).cast("long"), F.floor(F.size(shingles) / 2).cast("long")

    def add(counts: Column, hash: Column) -> Column:
        carry, added = hash, []
        for j in range(planes):
            added.append(counts[f"p{j}"].bitwiseXOR(carry).alias(f"p{j}"))
            carry = carry.bitwiseAND(counts[f"p{j}"])
        return F.struct(*added)

    def above_half(counts: Column) -> Column:
        above, same = zero, F.lit(-1).cast("long")
        for j in reversed(range(planes)):
            held, wanted = counts[f"p{j}"], -F.shiftright(half, j).bitwiseAND(F.lit(1).cast("long"))
            above = above.bitwiseOR(same.bitwiseAND(held).bitwiseAND(F.bitwise_not(wanted)))
            same = same.bitwiseAND(F.bitwise_not(held.bitwiseXOR(wanted)))
        return above

    hashes = F.transform(shingles, lambda s: F.xxhash64(s))
    return F.aggregate(hashes, F.struct(*(zero.alias(f"p{j}") for j in range(planes))), add, above_half)


def _shift(value: Column, bits: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, bits)


def _block(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, BLOCK_BITS * i).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long")).cast("int")


def prepare_items(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """item, nr (a hash of its shingles), n words, size of its shingles, shingles, often.

    often lists the shingles that occur twice or more, with their number. Items without words are left out; one of fewer than five words has one shingle, all of them.
    """
    cut = items.select(F.col(id).alias("item"), _words(text_of(text)).alias("words")).where(F.size("words") > 0)
    cut = cut.withColumn("n", F.size("words")).withColumn("size", F.least(F.lit(SHINGLE), F.col("n")))
    cut = cut.withColumn("shingles", _shingles(F.col("words"), F.col("size"))).drop("words")
    sorted = F.array_sort("shingles")
    twice = lambda all: F.array_distinct(F.filter(all, lambda s, i: (i > 0) & (s == F.get(all, i - 1))))
    often = F.transform(_let(sorted, twice), lambda s: F.struct(s.alias("s"), F.size(F.filter("shingles", lambda x: x == s)).alias("times")))
    return cut.withColumns({"nr": F.xxhash64("shingles"), "often": often})


def _hash_at(words: Column, i: Column, size: int) -> Column:
    """Hash of the run of so many words from word i, counted from 0."""
    return F.xxhash64(F.lit(size), *(F.get(words, i + k) for k in range(size)))


def _known(items: DataFrame) -> DataFrame:
    """hash, nr, n, size, of (the item's shingles) and rare, for every distinct shingle of an item.

    rare marks the shingles that fewest items have, just so many that a similar window
    holds one: at most a fifth of an item's shingles can be missing from it.
    """
    words = F.split("s", " ")
    hashed = F.coalesce(*(F.when(F.col("size") == k, F.xxhash64(F.lit(k), *(F.get(words, j) for j in range(k)))) for k in range(1, SHINGLE + 1)))
    rows = items.select("nr", "n", "size", F.size("shingles").alias("of"), F.explode("shingles").alias("s"))
    rows = rows.select("nr", "n", "size", "of", hashed.alias("hash")).groupBy("nr", "n", "size", "of", "hash").agg(F.count("*").alias("times"))
    common = rows.groupBy("hash").agg(F.count("*").alias("among"))
    first = Window.partitionBy("nr").orderBy("among", "hash").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("times").over(first), F.lit(0))
    return rows.join(common, "hash").select("hash", "nr", "n", "size", "of", (before <= F.expr("of div 5")).alias("rare"))


def _bitmap(hashes: DataFrame, bits: int) -> Column:
    """A constant array of longs in which two bits of every hash are set; bits is a power of two.

    It has bits / 64 entries at most, whatever the benchmark's size.
    """
    places = hashes.select(F.explode(F.array(*_places(F.col("hash"), bits))).alias("at"))
    words = places.groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("set"))
    found, filled = words.toArrow(), np.zeros(bits // 64, np.int64)
    filled[found["word"].to_numpy()] = found["set"].to_numpy()
    return _constant(hashes.sparkSession, filled)


def _constant(spark: SparkSession, values: np.ndarray) -> Column:
    """values as a literal array, handed over in one piece: lit() would hand over each value by a call of its own."""
    context = spark.sparkContext
    array = context._gateway.new_array(context._jvm.long, len(values))
    context._jvm.java.nio.ByteBuffer.wrap(values.astype(">i8").tobytes()).asLongBuffer().get(array)
    return classic.Column(context._jvm.org.apache.spark.sql.functions.lit(array))


def _places(h: Column, bits: int) -> tuple[Column, Column]:
    return F.pmod(h, F.lit(bits)), F.pmod(F.shiftright(h, 32), F.lit(bits))


def _in_bitmap(h: Column, bitmap: Column, bits: int) -> Column:
    tests = [_shift(F.get(bitmap, F.floor(at / 64).cast("int")), at.cast("int") % 64).bitwiseAND(F.lit(1).cast("long")) == 1 for at in _places(h, bits)]
    return tests[0] & tests[1]


def _small(df: DataFrame, rows: int) -> DataFrame:
    """df, to be broadcast if it has few rows."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _hits(docs: DataFrame, known: DataFrame, total: int) -> DataFrame:
    """id, text (its hash), words (their number), at, hash: the places where known shingles may stand.

    Every text is cut once, for all sizes of shingles. A bitmap of the known ones leaves
    out nearly all others.
    """
    sizes = [r["size"] for r in known.select("size").distinct().collect()]  # 1 to 5
    bits = min(BITMAP_BITS, 1 << max(12, (32 * total).bit_length()))
    bitmap = _bitmap(known.select("hash").distinct(), bits) if 8 * total <= bits else None

    def places(words: Column) -> Column:
        found = []
        for size in sizes:
            test = lambda i: _let(_hash_at(words, i, size), lambda h: _in_bitmap(h, bitmap, bits)) if bitmap is not None else F.lit(True)  # noqa: B023, E731
            at = F.when(F.size(words) >= size, F.filter(F.sequence(F.lit(0), F.size(words) - size), test)).otherwise(F.array().cast("array<int>"))
            found.append(F.transform(at, lambda i: F.struct(F.size(words).alias("words"), i.alias("at"), _hash_at(words, i, size).alias("hash"))))  # noqa: B023
        return F.concat(*found)

    # words stand in a let: a predicate pushed down would split the text for every shingle
    rows = docs.select("id", F.xxhash64("t").alias("text"), F.inline_outer(_let(_words(F.col("t")), places)))
    return rows.where("hash is not null")


def _starts(hits: DataFrame, known: DataFrame, total: int) -> DataFrame:
    """id, text, nr, n, of and starts: windows that hold enough shingles of an item to be similar.

    A document meets an item by the item's rare shingles; all its hits are then matched
    with those items only, so shingles of many items do not multiply.
    """
    key = ["id", "text"]
    met = hits.join(_small(known.where("rare").select("hash", "nr"), total), "hash").select(*key, "nr").distinct()
    met = materialise(met, "met")
    other = met.withColumnsRenamed({"id": "_id", "text": "_text"})
    held = hits.join(other, hits["id"].eqNullSafe(other["_id"]) & (hits["text"] == other["_text"])).drop("_id", "_text")
    held = held.join(_small(known.drop("rare"), total), ["hash", "nr"])
    held = held.groupBy(*key, "nr", "n", "size", "of", "words").agg(F.array_sort(F.collect_set("at")).alias("at"))
    shingles = F.least(F.col("of"), F.col("words") - F.col("size") + 1)  # of a window
    need = F.ceil(SIMILARITY * (shingles + F.col("of")) / (100 + SIMILARITY)).cast("int")
    held = held.withColumns({"shingles": shingles, "need": need, "last": F.greatest(F.lit(0), F.col("words") - F.col("n"))})
    start = lambda i: F.least(F.get("at", i), F.col("last"))
    enough = lambda i: F.get("at", i + F.col("need") - 1) < start(i) + F.col("shingles")
    firsts = F.when(F.size("at") >= F.col("need"), F.filter(F.sequence(F.lit(0), F.size("at") - F.col("need")), enough))
    starts = F.array_distinct(F.transform(firsts, start))
    return held.select(*key, "nr", "n", "size", starts.alias("starts")).where(F.size("starts") > 0)


def _similarity(a: Column, b: Column, often: Column) -> Column:
    """Weighted Jaccard of two arrays as multisets; often lists what b holds more than once."""
    more = lambda x: F.greatest(F.lit(0), F.least(F.size(F.filter(a, lambda s: s == x["s"])), x["times"]) - 1)
    both = F.aggregate(often, F.size(F.array_intersect(a, b)), lambda acc, x: acc + more(x))
    return _let(both, lambda both: both / (F.size(a) + F.size(b) - both))


def _windows(docs: DataFrame, starts: DataFrame, planes: int) -> DataFrame:
    """id, nr, n, start, shingles, fp of each window of starts.

    Of each text only the stretches that the windows lie in are kept.
    """
    listed = starts.groupBy("id", "text").agg(F.collect_list(F.struct("nr", "n", "size", "starts")).alias("items"))
    listed = materialise(listed, "starts")
    wanted = _small(listed.withColumnsRenamed({"id": "_id", "text": "_text"}), 100 * listed.count())
    hashed = docs.withColumn("text", F.xxhash64("t"))
    rows = hashed.join(wanted, hashed["id"].eqNullSafe(wanted["_id"]) & (hashed["text"] == wanted["_text"]))
    low = lambda item: F.array_min(item["starts"])
    stretch = lambda w, item: F.slice(w, low(item) + 1, F.array_max(item["starts"]) - low(item) + item["n"])
    fields = lambda item: (item[c].alias(c) for c in ("nr", "n", "size", "starts"))
    rows = rows.select("id", F.inline(_let(_words(F.col("t")), lambda w: F.transform("items", lambda item: F.struct(*fields(item), low(item).alias("low"), stretch(w, item).alias("words"))))))
    rows = materialise(rows, "stretches")
    rows = rows.select("id", "nr", "n", "size", "low", "words", F.explode("starts").alias("start"))
    words = F.slice("words", F.col("start") - F.col("low") + 1, F.col("n"))
    marked = lambda shingles: F.struct(shingles.alias("shingles"), _simhash(shingles, planes).alias("fp"))
    return rows.select("id", "nr", "n", "start", _once(_let(_let(words, lambda w: _shingles(w, F.col("size"))), marked)))


def _near(windows: DataFrame, items: DataFrame, n_items: int) -> DataFrame:
    """id, start, n, shingles of windows with nr, shingles (of) and often of items: the pairs within RADIUS bits.

    A window meets the item whose shingle it starts with, in every block that is close
    enough; the pair is kept in the first.
    """
    masks = F.filter(F.sequence(F.lit(0), F.lit((1 << BLOCK_BITS) - 1)), lambda m: F.bit_count(m) <= RADIUS // BLOCKS)
    block = lambda: F.inline(F.array(*(F.struct(F.lit(i).alias("block"), _block(F.col("fp"), i).alias("value")) for i in range(BLOCKS))))
    probes = items.select("nr", "fp", block())
    probes = probes.select("nr", F.col("fp").alias("item_fp"), "block", F.explode(masks).alias("mask"), "value")
    probes = probes.select("nr", "item_fp", "block", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
    probes = _small(probes, n_items * BLOCKS * sum(m.bit_count() <= RADIUS // BLOCKS for m in range(1 << BLOCK_BITS)))
    met = windows.select("id", "start", "n", "fp", "shingles", "nr", block()).join(probes, ["nr", "block", "value"])
    apart = lambda i: F.bit_count(_block(F.col("fp"), i).bitwiseXOR(_block(F.col("item_fp"), i)))
    first = F.coalesce(*(F.when(apart(i) <= RADIUS // BLOCKS, i) for i in range(BLOCKS)))
    met = met.where((F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS) & (F.col("block") == first))
    of = items.select("nr", F.col("shingles").alias("of"), "often")
    return met.join(_small(of, 100 * n_items), "nr").select("id", "nr", "start", "n", "shingles", "of", "often")


def find_leaks(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """One row per document and item that it leaks: id, item_id, similarity, start_word, n_words.

    similarity is the best window's (of equal ones the first that starts at a shingle of
    the item); start_word counts from 0 in runs of letters and digits. Null and empty texts leak nothing; a document shorter
    than an item is one window; repeated rows with one id are reported once; items of
    equal words are each reported, one with a null id as null; other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id).alias("id"), text_of(text).alias("t"))
    kind = items.schema[item_id].dataType
    named = materialise(prepare_items(items, item_id), "items")
    n_items, most = named.agg(F.count_distinct("nr"), F.max(F.size("shingles"))).first()
    if not n_items:
        nothing = docs.select(F.col(id), F.lit(None).cast(kind).alias(item_id), F.lit(0.0).alias("similarity"), F.lit(0).alias("start_word"), F.lit(0).alias("n_words"))
        return nothing.where(F.lit(False))
    planes = most.bit_length()
    items = materialise(named.drop("item").dropDuplicates(["nr"]).withColumn("fp", _simhash(F.col("shingles"), planes)), "items")
    known = materialise(_known(items), "known")
    total = known.count()
    hits = materialise(_hits(texts, known, total), "hits")
    pairs = _near(_windows(texts, _starts(hits, known, total), planes), items, n_items)
    similarity = _similarity(F.col("shingles"), F.col("of"), F.col("often"))
    rated = pairs.select("id", "nr", _once(F.struct(similarity.alias("similarity"), (-F.col("start")).alias("before"), "n")))
    found = rated.groupBy("id", "nr").agg(F.max(F.struct("similarity", "before", "n")).alias("best")).where(100 * F.col("best.similarity") >= SIMILARITY)
    found = materialise(found, "leaks")
    discard(spark, hits)
    found = found.join(named.select("nr", "item").distinct(), "nr")
    return found.select(
        F.col("id").alias(id),
        F.col("item").alias(item_id),
        F.col("best.similarity").alias("similarity"),
        (-F.col("best.before")).alias("start_word"),
        F.col("best.n").alias("n_words"),
    )


def drop_leaks(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that leak no item. A null id is compared like any other."""
    leaks = find_leaks(docs, items, id, text).select(F.col(id).alias("_leaks")).distinct()
    return docs.join(leaks, docs[id].eqNullSafe(leaks["_leaks"]), "left_anti")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
