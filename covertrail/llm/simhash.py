"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most 4 bits apart share a variant: a 64-bit value at most 2 bits
from each. Every distinct fingerprint emits all its variants within 2 bits (2081);
those that collide on a variant are linked. The shuffle carries variants of the first
k bits only (with 2 or fewer flips); the task that owns a prefix expands the flips left
over on the other bits, so the whole ball is made but 2081 rows are not sent. k follows
the number of fingerprints, so that a prefix holds a bounded number of them.

Within a variant all fingerprints are linked to one, never pair by pair: that keeps
which fingerprints are connected, in linear space, for groups of any size.

That is op4. dedup(), the pipeline's stage, takes the same ball over fingerprints of
five-word shingles and checks what it links by exact Jaccard similarity. Similar texts may
differ in more than 4 bits: bands of minimum hashes and rare shingles find those as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import stored
from .common import materialise, remove, text_of
from .common import table as read_table

RADIUS = 4
#: Fingerprints for each prefix, on average, that k aims at.
PER_PREFIX = 256
#: Variants that a task holds at once; a prefix with more is worked in passes.
AT_ONCE = 1 << 22
#: dedup(): words of a shingle, percent of similarity that makes copies, bands of so many minima each.
WORDS, SIMILARITY = 5, 80
BANDS, ROWS = 24, 4
#: Documents (some 30 bytes each) that are broadcast to find their texts; more are joined by shuffle.
BROADCAST_TEXTS = 500_000
#: Rounds in which one pair of each text is tried.
ROUNDS = 3
#: Shingles that a row of a text knows to stand before its own.
AHEAD = 64


def fingerprint(text: str, shingle: int = 4) -> int:
    """The text's SimHash, unsigned.

    A-Z are lowered; words are what spaces and tab to carriage return leave; shingles
    count as often as they occur. Fewer words than a shingle: their whole sequence is
    the one shingle; no words: 0.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    parts = (words[i : i + last] for i in range(min(shingle, len(words)))) if len(words) >= shingle else ([w] for w in words)
    digest = xxhash.xxh64_intdigest
    counts, done = np.zeros(64, np.int64), 0
    grams = map(b" ".join, zip(*parts))
    while done < last:  # in blocks: long texts need no large bit matrix
        n = min(last - done, 1 << 14)
        hashes = np.fromiter((digest(next(grams), 42) for _ in range(n)), np.uint64, n)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        done += n
    return int(np.packbits(2 * counts > last, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = 4) -> Column:
    """fingerprint() of a column, as a signed long; null counts as the empty text."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).astype(np.int64))

    return run(F.coalesce(text, F.lit("")))


def _masks(bits: int, flips: int) -> np.ndarray:
    """All values of so many low bits with flips or fewer set."""
    one = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    found = [np.zeros(1, np.uint64)]
    if flips >= 1:
        found.append(one)
    if flips >= 2:
        i, j = np.triu_indices(bits, 1)
        found.append(one[i] | one[j])
    return np.concatenate(found)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For 0 .. n-1, the least number connected to each by the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, root):
            return root
        root = new


def _linked(prints: np.ndarray, left: np.ndarray, rest: int) -> tuple[np.ndarray, np.ndarray]:
    """For one prefix: fingerprints and the least fingerprint each is connected to by its variants.

    left: the flips that each may still spend on the low rest bits.
    """
    order = np.argsort(prints.view(np.int64), kind="stable")
    prints, left = prints[order], left[order]
    low = prints & np.uint64((1 << rest) - 1)
    total = sum(int((left == f).sum()) * len(_masks(rest, f)) for f in range(3))
    passes = math.ceil(total / AT_ONCE)
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    for turn in range(passes):
        keys, owners = [], []
        for flips in range(3):
            of = np.flatnonzero(left == flips)
            masks = _masks(rest, flips)
            step = max(1, AT_ONCE // len(masks))
            for at in range(0, len(of), step):
                some = of[at : at + step]
                key = (low[some][:, None] ^ masks[None, :]).ravel()
                owner = np.repeat(some, len(masks))
                if passes > 1:
                    mine = (key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(passes) == turn
                    key, owner = key[mine], owner[mine]
                keys.append(key)
                owners.append(owner)
        key, owner = np.concatenate(keys), np.concatenate(owners)
        by = np.argsort(key, kind="stable")
        key, owner = key[by], owner[by]
        same = np.r_[False, key[1:] == key[:-1]]
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))
        pair = np.unique(owner[same] * np.int64(len(prints)) + owner[first[same]])
        ends.append((pair // len(prints), pair % len(prints)))
    a, b = (np.concatenate(x) for x in zip(*ends))
    near = np.bitwise_count(prints[a] ^ prints[b]) <= RADIUS
    root = _roots(len(prints), a[near], b[near])
    joined = np.flatnonzero(root != np.arange(len(prints)))
    return prints[joined], prints[root[joined]]


def links(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of fingerprints that connect all of prints within RADIUS bits.

    prints has fp, distinct longs.
    """
    spark = prints.sparkSession
    n = prints.count()
    k = min(40, max(2, math.ceil(math.log2(max(1, n) / PER_PREFIX)) if n > PER_PREFIX else 2))
    rest = 64 - k
    flips = F.array(*(F.struct(F.lit(int(m)).alias("m"), F.lit(2 - int(m).bit_count()).alias("left")) for m in _masks(k, 2)))
    sent = prints.select("fp", F.inline(flips)).select("fp", F.shiftrightunsigned("fp", rest).bitwiseXOR(F.col("m")).alias("prefix"), F.col("left").cast("byte"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def out(rows: list[np.ndarray]) -> pa.RecordBatch:
            a, b = _linked(rows[0].view(np.uint64), rows[1], rest)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

        held: list[list[np.ndarray]] = []
        current = None
        for batch in batches:
            prefix = batch.column("prefix").to_numpy(zero_copy_only=False)
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "left")]
            cuts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]]) if len(prefix) else []
            for at, to in zip(cuts, [*cuts[1:], len(prefix)]):
                if prefix[at] != current and held:
                    yield out([np.concatenate(x) for x in zip(*held)])
                    held = []
                current = prefix[at]
                held.append([c[at:to] for c in columns])
        if held:
            yield out([np.concatenate(x) for x in zip(*held)])

    return sent.repartition(tasks, "prefix").sortWithinPartitions("prefix").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root, the least node connected to it, for every node of edges (a, b).

    Each round a node takes the least root among its neighbours' and then its root's
    root, so the rounds grow with the logarithm of a chain's length. Rounds are written
    to the scratch folder.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both, "edges")
    table = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        roots = table.select("node", "root")
        near = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        new = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("new"))
        jump = roots.select(F.col("node").alias("new"), F.col("root").alias("jump"))
        new = new.join(jump, "new", "left").select("node", F.least("new", "jump").alias("root"), (F.least("new", "jump") < F.col("root")).alias("moved"))
        last, table = table, stored(new, "roots")
        remove(last)
        if not table.where("moved").limit(1).count():
            return table.select("node", "root")


def groups(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """docs, which has id and fp, with component_id: the least id among all connected documents.

    Equal fingerprints are one node. Rows with a null id get the least id of their
    group, null only if the whole group has none; repeated rows each get theirs. A column
    named component_id is replaced.
    """
    docs = docs.drop("component_id")
    prints = materialise(docs.groupBy("fp").agg(F.min(id).alias("least")), "prints")
    joined = components(links(prints.select("fp")))
    known = prints.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    rows = docs.select(F.struct("*").alias("own"), F.col("fp").alias("fp"))
    return rows.join(known.select("fp", "root").join(least, "root").drop("root"), "fp").select("own.*", "component_id")


def shingle_hashes(text: str) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of WORDS words, lower-cased.

    Fewer words are one shingle; no words: none.
    """
    words = text.lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = (words[i:] for i in range(WORDS)) if len(words) >= WORDS else ([w] for w in words)
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*parts))), np.uint64))


def _sketches(text: Column) -> Column:
    """whole (a hash of all shingles), n (their number), keys (a hash of each band of minima) and fp (the SimHash) of a column."""
    rng = np.random.default_rng(0)
    salt = rng.integers(0, 2**64, BANDS * ROWS, np.uint64)[:, None]
    times = rng.integers(0, 2**64, BANDS * ROWS, np.uint64)[:, None] | np.uint64(1)

    def keys(hashes: np.ndarray) -> list[int]:
        if not len(hashes):
            return []
        least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
        for at in range(0, len(hashes), 2048):  # long texts need no large matrix
            least = np.minimum(least, ((hashes[None, at : at + 2048] ^ salt) * times).min(axis=1))
        raw = least.reshape(BANDS, ROWS)
        return [xxhash.xxh64_intdigest(raw[i].tobytes(), i) - (1 << 63) for i in range(BANDS)]

    @F.pandas_udf("whole binary, n int, keys array<long>, fp long")
    def run(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_hashes(t) for t in texts]
        prints = np.array([fingerprint(t, WORDS) for t in texts], np.uint64).astype(np.int64)
        return pd.DataFrame({"whole": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "n": [len(s) for s in sets], "keys": [keys(s) for s in sets], "fp": prints})

    return run(text)


def _alike(a: Column, b: Column) -> Column:
    """Whether two texts' sets of shingles have a Jaccard similarity of SIMILARITY or more."""

    @F.pandas_udf("boolean")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        found, last, x = [], None, np.zeros(0, np.uint64)
        for one, other in zip(left, right):
            if one != last:  # a text compared with many comes in runs
                last, x = one, shingle_hashes(one)
            y = shingle_hashes(other)
            both = len(np.intersect1d(x, y, assume_unique=True))
            found.append(100 * both >= SIMILARITY * (len(x) + len(y) - both))
        return pd.Series(found, dtype=bool)

    return run(a, b)


def _grams(text: Column) -> Column:
    """shingle_hashes() of a column, as signed longs."""

    @F.pandas_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_hashes(t).view(np.int64) for t in texts])

    return run(text)


def _fits(n: Column, m: Column) -> Column:
    """Whether sets of n and m shingles can be alike at all."""
    return 100 * F.least(n, m) >= SIMILARITY * F.greatest(n, m)


def _texts(wholes: DataFrame, prints: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """whole and one text t for each of wholes."""
    needed = materialise(wholes.join(prints, "whole").select("whole", F.col("best._hash").alias("_hash")), "needed")
    if needed.count() <= BROADCAST_TEXTS:  # else all texts would be shuffled to find these
        needed = F.broadcast(needed)
    texts = docs.select(F.xxhash64(text_of(text)).alias("_hash"), text_of(text).alias("t")).join(needed, "_hash").dropDuplicates(["whole"])
    return materialise(texts.select("whole", "t"), "texts")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are alike."""
    both = pairs.join(texts.withColumnsRenamed({"whole": "a", "t": "x"}), "a").join(texts.withColumnsRenamed({"whole": "b", "t": "y"}), "b")
    return materialise(both.where(_alike(F.col("x"), F.col("y"))).select("a", "b"), "alike")


def _rare_shingles(tangled: DataFrame, texts: DataFrame) -> DataFrame:
    """tangled (whole, n, root) with gram, place and ahead for each rare shingle.

    A text's shingles are put in order of frequency, rarest first. Of alike sets of n
    and m the first shared shingle stands early enough in both, at places i and j, that
    what follows can still hold SIMILARITY: that is exact, no alike pair is lost. What
    many texts have in common stands last and joins nothing. All texts keep one order, so
    of a pair's shared shingles one is first in both: it alone makes the pair, unless it
    stands behind the AHEAD shingles that a row knows to stand before it.
    """
    grams = materialise(texts.join(tangled, "whole").select("whole", "n", "root", F.explode(_grams(F.col("t"))).alias("gram")), "grams")
    counts = grams.groupBy("gram").agg(F.count("*").alias("often"))
    placed = grams.join(counts, "gram").withColumn("place", F.row_number().over(Window.partitionBy("whole").orderBy("often", "gram")))
    early = materialise(placed.where((100 * (F.col("place") - 1) <= (100 - SIMILARITY) * F.col("n")) & (F.col("often") > 1)).drop("often"), "early")
    ahead = F.transform(F.slice(F.sort_array(F.collect_list(F.when(F.col("place") < F.col("least") + AHEAD, F.struct("place", "gram")))), 1, AHEAD), lambda x: x["gram"])
    leasts = early.groupBy("whole").agg(F.min("place").alias("least"))
    firsts = early.join(leasts, "whole").groupBy("whole", "least").agg(ahead.alias("firsts"))
    before = F.slice("firsts", F.lit(1), F.least(F.col("place") - F.col("least"), F.lit(AHEAD)))
    return materialise(early.join(firsts, "whole").select("whole", "n", "root", "gram", "place", before.alias("ahead")), "early")


def _may_be_alike() -> Column:
    """Whether texts (n, root, place) and (m, other, at) of one shingle, the first they share, have other roots and room for SIMILARITY."""
    left = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("at")) + 1
    room = (100 + SIMILARITY) * left >= SIMILARITY * (F.col("n") + F.col("m"))
    return (F.col("root") != F.col("other")) & _fits(F.col("n"), F.col("m")) & room


def _linked_by_firsts(early: DataFrame, texts: DataFrame, alike: DataFrame, tried: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """early with roots by more links, alike with these links, tried with the pairs (a, b) that gave them.

    In a round each text is compared with one: the first of a rare shingle's texts, of the
    shingle where both stand earliest. A group of near copies that share a shingle so
    becomes one in linear steps, and what follows pairs only texts of other groups.
    """
    for _ in range(ROUNDS):
        best = F.min(F.struct("place", "whole", "n", "root")).alias("f")
        firsts = early.groupBy("gram").agg(best, F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
        firsts = firsts.select("gram", F.col("f.whole").alias("first"), F.col("f.n").alias("m"), F.col("f.root").alias("other"), F.col("f.place").alias("at"))
        met = early.join(firsts, "gram").where(_may_be_alike()).select("whole", F.least("whole", "first").alias("a"), F.greatest("whole", "first").alias("b"), (F.col("place") + F.col("at")).alias("late"))
        met = met.join(tried, ["a", "b"], "left_anti").groupBy("whole").agg(F.min(F.struct("late", "a", "b")).alias("best"))
        chosen = materialise(met.select("best.a", "best.b").distinct(), "chosen")
        alike, tried = alike.unionByName(_verified(chosen, texts)), tried.unionByName(chosen)
        roots = components(alike).withColumnsRenamed({"node": "whole", "root": "now"})
        early = materialise(early.join(roots, "whole", "left").withColumn("root", F.coalesce("now", "root")).drop("now"), "early")
    return early, alike, tried


def _rare_pairs(early: DataFrame) -> DataFrame:
    """Pairs (a, b, late) of early's texts that may be alike, have other roots and share a rare shingle.

    late: the sum of the first shared shingle's places.
    """
    other = early.select("gram", F.col("whole").alias("b"), F.col("n").alias("m"), F.col("root").alias("other"), F.col("place").alias("at"), F.col("ahead").alias("others"))
    met = early.join(other, "gram").where((F.col("whole") < F.col("b")) & _may_be_alike() & ~F.arrays_overlap("ahead", "others"))
    return met.groupBy(F.col("whole").alias("a"), "b").agg(F.min(F.col("place") + F.col("at")).alias("late"))


def _linked_by_rounds(pairs: DataFrame, texts: DataFrame, alike: DataFrame) -> DataFrame:
    """alike with links (a, b) among pairs (a, b, late) that connect all that the alike ones of them would.

    A round tries one pair of each text, the likeliest: that of the earliest shared
    shingle. Pairs whose texts are then connected need no trial. After ROUNDS rounds all
    pairs still open are tried.
    """
    open_ = pairs
    for number in range(ROUNDS + 1):
        best = open_.groupBy("a").agg(F.min(F.struct("late", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
        chosen = materialise(best, "chosen") if number < ROUNDS else open_.select("a", "b")
        alike = alike.unionByName(_verified(chosen, texts))
        if number == ROUNDS:
            return alike
        roots = components(alike)
        open_ = open_.join(chosen, ["a", "b"], "left_anti")
        for side in "ab":
            open_ = open_.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
        apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
        open_ = materialise(open_.where(apart).select("a", "b", "late"), "open")


def copies(prints: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """node and root of components() over all pairs of prints (whole, n, keys, fp, best) that are alike.

    The ball's groups() of fingerprints come first: each print is compared with the first
    of its group. Prints with an equal band are compared too: at SIMILARITY itself 3 pairs in a million
    have none. In a band all are first compared with one, so groups of true copies stay
    linear. Prints of bands that this has left in different components are then paired
    where they share a rare shingle, first with one text of it, never all with all.
    """
    ball = groups(prints.select("whole", "n", "fp"), "whole").where(F.col("whole") != F.col("component_id"))
    ball = ball.select(F.col("component_id").alias("a"), F.col("whole").alias("b"))
    keys = prints.select("whole", "n", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("whole").alias("first"), F.max("whole").alias("last"), F.min_by("n", "whole").alias("m")).where("first != last").drop("last")
    members = materialise(keys.join(materialise(shared, "shared"), "key"), "members")
    tried = members.where((F.col("whole") != F.col("first")) & _fits(F.col("n"), F.col("m"))).select(F.col("first").alias("a"), F.col("whole").alias("b"))
    tried = materialise(tried.unionByName(ball).distinct(), "pairs")
    ends = tried.select("a").union(tried.select("b")).distinct().withColumnRenamed("a", "whole")
    alike = _verified(tried, _texts(ends, prints, docs, text))

    roots = components(alike).withColumnRenamed("node", "whole")
    rooted = materialise(members.join(roots, "whole", "left").select("key", "whole", "n", F.coalesce("root", "whole").alias("root")), "rooted")
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("key")
    tangled = materialise(rooted.join(mixed, "key").select("whole", "n", "root").distinct(), "tangled")
    texts = _texts(tangled.select("whole"), prints, docs, text)
    early, alike, tried = _linked_by_firsts(_rare_shingles(tangled, texts), texts, alike, tried)
    pairs = materialise(_rare_pairs(early).join(tried, ["a", "b"], "left_anti"), "pairs")
    return components(_linked_by_rounds(pairs, texts, alike))


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one document of each near-duplicate group: that of the least id, not null if any.

    Documents are linked from a Jaccard similarity of SIMILARITY percent of their sets of
    five-word shingles, and so are all connected by links. op4's contract (four words, 4
    differing bits) does not reach that and binds only op4. Of rows with that id the one
    whose text has the least hash stays, once. Null texts are empty; the names of other
    columns do not matter. No rows in, no rows out.
    """
    hashed = F.xxhash64(text_of(text))
    marked = materialise(docs.select(F.col(id).alias("id"), hashed.alias("_hash"), _sketches(text_of(text)).alias("s")).select("id", "_hash", "s.*"), "sketches")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_hash")).alias("best")
    prints = materialise(marked.groupBy("whole").agg(first, F.first("n").alias("n"), F.first("keys").alias("keys"), F.min("fp").alias("fp")), "prints")
    joined = copies(prints, docs, text)
    known = prints.join(joined.withColumnRenamed("node", "whole"), "whole", "left").withColumn("root", F.coalesce("root", "whole"))
    best = known.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.id").alias("_id"), F.col("best._hash").alias("_hash"))
    tagged = docs.select(F.struct("*").alias("own"), F.col(id).alias("id"), hashed.alias("hash"))
    kept = tagged.join(best, F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "left_semi")
    return kept.dropDuplicates(["id", "hash"]).select("own.*")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", fingerprints(F.col("text")).alias("fp"))
    found = groups(materialise(docs, "fingerprints"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
