"""Spelling variants of a corpus: words one edit apart, by states that walk a trie of all words.

The trie is a table of edges; a walk is a table of states (word, position, node, edits)
joined with it level by level. Words are read forwards in one trie and backwards in
another, and states make their edit in the second half of the reading only: two words one
edit apart agree on half of their letters at one end. So walks begin deep in the trie,
where nodes have few edges, and no short prefix meets all words.

Nodes at which nothing branches and no word ends are left out, so an edge carries a string
and the number of levels follows the branchings, not the letters, of the words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, remove, table, text_of

#: Words a worker counts before it passes them on.
COUNTED = 200_000

#: A word's letters in Latin-1, capitals A to Z as small letters, and spaces for all else.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def word_counts(docs: DataFrame, least: int = 6, noise: int | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the runs of A-Z, a-z and U+00C0 to U+00FF of at least so many letters, A-Z lower-cased.

    noise: where it divides the crc32 of "<id>:<word>" h, the word has lost its letter
    h % length. Null texts have no words, a null id is written as nothing; other columns
    are ignored, whatever their names. No rows in, no rows out. Workers pass on sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words, counts = [w.decode("latin-1") for w in total], list(total.values())
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for key, told in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    start = zlib.crc32(f"{'' if key is None else key}:".encode())
                    for word, n in Counter(told.encode("latin-1", "replace").translate(_LETTERS).split()).items():
                        if len(word) < least:
                            continue
                        if noise:
                            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                            if not h % noise:
                                at_letter = h % len(word)
                                word = word[:at_letter] + word[at_letter + 1 :]
                                if len(word) < least:
                                    continue
                        total[word] += n
                if len(total) > COUNTED:
                    yield out()
        if total:
            yield out()

    made = docs.select(F.col(id).alias("k"), text_of(text).alias("t")).mapInArrow(run, "word string, n long")
    return made.groupBy("word").agg(F.sum("n").alias("n"))


_MOD, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E681


def _prefixes(words: DataFrame) -> DataFrame:
    """word, back, depth, node (a hash of the first depth letters as they are read), next (the letter after them).

    A walk of this word begins no earlier than at the middle, (length - 1) div 2, and so
    does one of a word that is shorter by a letter. Earlier prefixes are left out: the
    ones that many words share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.bool_(), pa.int32(), pa.int64(), pa.string())
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                columns: list[list] = [[], [], [], [], []]
                for word in batch.slice(at, 1024).column(0).to_pylist():
                    for back in (False, True):
                        way, node = word[::-1] if back else word, 2 + back
                        for depth in range(len(way) + 1):
                            if 2 * depth >= len(way) - 3:
                                for column, value in zip(columns, (word, back, depth, node, way[depth : depth + 1])):
                                    column.append(value)
                            if depth < len(way):
                                node = (node * _BASE + ord(way[depth])) % _MOD
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "back", "depth", "node", "next"])

    return words.select("word").mapInArrow(run, "word string, back boolean, depth int, node long, next string")


def _way() -> Column:
    """The word as it is read."""
    return F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (node, label, child, ends) and the walks' beginnings (word, back, position, node) of distinct words.

    ends: the word that ends at the child, or null. A walk begins at the first node of its
    word that is not before the middle. Nodes are hashes; should two be alike, walks find
    too much, which neighbours() sees.
    """
    prefixes = materialise(_prefixes(words), "trie-prefixes")
    kept = prefixes.groupBy("node").agg(F.min("next").alias("a"), F.max("next").alias("b"))
    kept = kept.where("a <> b or a = ''").select("node")  # letters part, or a word ends
    order = Window.partitionBy("word", "back").orderBy("depth")
    path = prefixes.join(kept, "node", "left_semi").select("word", "back", "depth", "node", F.lead("depth").over(order).alias("to"), F.lead("node").over(order).alias("child"))
    path = materialise(path, "trie-paths")
    remove(prefixes)
    label = F.substring(_way(), F.col("depth") + 1, F.col("to") - F.col("depth"))
    ends = F.max(F.when(F.col("to") == F.length("word"), F.col("word")))
    edges = path.where("child is not null").select("node", label.alias("label"), "child", "word", "to").groupBy("node", "label", "child").agg(ends.alias("ends"))
    begins = path.where(F.col("depth") >= F.expr("(length(word) - 1) div 2")).groupBy("word", "back").agg(F.min(F.struct("depth", "node")).alias("s"))
    return edges, begins.select("word", "back", F.col("s.depth").alias("position"), F.col("s.node").alias("node"))


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one level on: (word, back, position, node, edits, ends), ends being the word that ends at the node, or null.

    An edge is taken by letters alike; or, without an edit so far, with its first letter in
    place of the word's, or put in before it. A word whose letter is put in elsewhere is
    found from the other side, so no letter is left out here.
    """
    way, label = F.col("way"), F.col("label")
    after = lambda skip: F.substring(way, F.col("position") + 1 + skip, F.length(label) - 1)
    letter, tail = F.substring(way, F.col("position") + 1, 1), F.substring(label, 2, F.lit(1 << 30))
    first = F.substring(label, 1, 1)
    parts = (letter != first) & (F.col("edits") == 0)
    alike = (letter == first) & (after(1) == tail)
    replaced = parts & (letter != "") & (after(1) == tail)
    inserted = parts & (after(0) == tail)
    size, at = F.length(label), F.col("position")
    ways = F.array(
        F.when(alike, F.struct((at + size).alias("position"), F.col("edits").alias("edits"))),
        F.when(replaced, F.struct((at + size).alias("position"), F.lit(1).alias("edits"))),
        F.when(inserted, F.struct((at + size - 1).alias("position"), F.lit(1).alias("edits"))),
    )
    met = states.drop("ends").withColumn("way", _way()).join(edges, "node").where(alike | replaced | inserted)
    return met.select("word", "back", F.inline(F.filter(ways, lambda w: w.isNotNull())), F.col("child").alias("node"), "ends")


def neighbours(words: DataFrame) -> DataFrame:
    """word, near: every pair of the distinct words of words (word, more) that are one letter inserted, deleted or replaced apart, both ways round.

    Null words are nobody's neighbours; other columns are ignored. No rows in, no rows out.
    """
    edges, begins = trie(words.select("word").where("word is not null").distinct())
    edges = materialise(edges, "trie-edges")
    states = materialise(begins.select("*", F.lit(0).alias("edits"), F.lit(None).cast("string").alias("ends")), "trie-states")
    found = []
    arrived = (F.col("edits") == 1) & F.col("ends").isNotNull() & (F.col("position") == F.length("word"))
    while not states.isEmpty():
        level = materialise(_step(states, edges), "trie-states")
        found.append(level.where(arrived).select("word", F.col("ends").alias("near")))
        states = level.where((F.col("edits") == 0) | (F.col("position") < F.length("word")))
    pairs = found[0] if found else begins.select("word", F.col("word").alias("near"))
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    ways = F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))
    return pairs.where(F.levenshtein("word", "near") == 1).select(F.inline(ways)).distinct()


def forms(words: DataFrame, near: DataFrame, times: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct words (word, n) and their neighbours().

    form: the near word of the greatest n, the first in code-point order among those, if n
    is at least so many times (2 or more) the word's; else null. root: the last of the
    word's form, the form's form and so on; the word itself without one. Roots are looked
    up in rounds, each through twice as many forms as the one before.
    """
    of_near = words.select(F.col("word").alias("near"), (-F.col("n")).alias("rarity"))
    best = near.join(of_near, "near").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct("rarity", "near")).alias("best"))
    often = -F.col("best.rarity") >= times * F.col("n")
    form, form_n = F.when(often, F.col("best.near")), F.when(often, -F.col("best.rarity"))
    rows = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"), form_n.alias("form_n"))
    rows = materialise(rows, "forms")
    to = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = to.select(F.col("word").alias("root"), F.col("root").alias("further"))
        looked = materialise(to.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        to = looked.select("word", "root")
        if looked.where("further is not null").isEmpty():
            break
    return rows.join(to, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = materialise(word_counts(table(spark, sf_dir, "documents"), 6, 199).where("n >= 5"), "words")
    return forms(words, neighbours(words))
