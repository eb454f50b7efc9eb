"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and
one integer whose bits say which rules failed; policies (named sets of rules) and
ablations are then integer arithmetic on that column, without the texts.

All of it is SQL expressions in one narrow stage, and the ledger is stored without the
texts: any number of policies and ablations then read it. Nothing is shuffled until an
ablation counts rows, and then one row for each pattern of bits.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, text_of, words_of


@dataclass(frozen=True)
class Rule:
    """A named test on the measurements; failed is true where a document breaks it."""

    name: str
    failed: Column


def rules() -> list[Rule]:
    """Bit i of the ledger belongs to the i-th rule; append only, so old masks stay valid."""
    c = F.col
    return [
        Rule("few_words", c("n_words") < 50),
        Rule("repeated_words", 100 * c("n_repeat_words") > 50 * c("n_words")),
        Rule("symbols", 2 * c("n_symbols") > c("n_words")),
        Rule("repeated_lines", 2 * c("n_dup_lines") > c("n_lines")),
        Rule("long_words", c("word_chars") > 20 * c("n_words")),
        Rule("shouting", 2 * c("n_upper") > c("word_chars")),
    ]


#: Versioned policies: the rules that reject a document.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_words", "symbols", "repeated_lines", "long_words", "shouting"),
}


#: The rules' names by bit.
NAMES = ("few_words", "repeated_words", "symbols", "repeated_lines", "long_words", "shouting")


def policy_bit(rule: str) -> int:
    return 1 << NAMES.index(rule)


def policy_mask(policy: str) -> int:
    """The bits of the policy's rules."""
    return sum(map(policy_bit, POLICIES[policy]))


#: Columns that measure() adds.
MEASURED = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_upper", "n_repeat_words")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with one column per measurement.

    A null or empty text measures 0 everywhere. Existing columns with the names of
    measurements are replaced; other columns, repeated rows included, are kept as
    they are.
    """
    t = text_of(text)
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.withColumns({"_words": words_of(t), "_lines": lines})
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_upper": F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("long"),
        }
    )
    return _repeat_words(df).drop("_words", "_lines")


def _repeat_words(df: DataFrame) -> DataFrame:
    """n_repeat_words: words that lie in a three-word window found twice or more.

    A text whose windows all hash differently repeats none. In the others the windows
    themselves are sorted with their positions, so equal ones are neighbours: n log n
    in the words of one text, however often a window repeats.
    """
    n = F.size("_words")
    windows = F.slice(
        F.arrays_zip(
            F.col("_words").alias("a"),
            F.slice("_words", 2, n).alias("b"),
            F.slice("_words", 3, n).alias("c"),
            F.sequence(F.lit(0), n).alias("at"),
        ),
        F.lit(1),
        F.greatest(n - 2, F.lit(0)),
    )
    hashes = F.transform(windows, lambda x: F.xxhash64(x["a"], x["b"], x["c"]))
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    df = df.withColumn("_sorted", F.when(some, F.sort_array(windows)))
    pairs = F.filter(
        F.arrays_zip(F.col("_sorted").alias("x"), F.slice("_sorted", 2, n).alias("y")),
        lambda p: (p["x"]["a"] == p["y"]["a"]) & (p["x"]["b"] == p["y"]["b"]) & (p["x"]["c"] == p["y"]["c"]),
    )
    df = df.withColumn("_pairs", pairs)
    starts = F.array_distinct(F.flatten(F.transform("_pairs", lambda p: F.array(p["x"]["at"], p["y"]["at"]))))
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda at: F.array(at, at + 1, at + 2))))
    repeats = F.when(F.size("_pairs") > 0, F.size(covered)).otherwise(0).cast("long")
    return df.withColumn("n_repeat_words", repeats).drop("_sorted", "_pairs")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with all measurements and failed_bits, bit i set where rule i fails."""
    bits = F.lit(0)
    for i, rule in enumerate(rules()):
        bits = bits.bitwiseOR(F.when(rule.failed, 1 << i).otherwise(0))
    return measure(docs, text).withColumn("failed_bits", bits)


def stored_ledger(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The ledger's measurements and bits with the columns to keep, written to the scratch folder.

    Rows are those of docs, one each; a kept column with the name of a measurement gives
    way to the measurement.
    """
    made = [*MEASURED, "failed_bits"]
    return materialise(ledger(docs, text).select(*(c for c in keep if c not in made), *made), "ledger")


def passes(policy: str) -> Column:
    """True where a row of the ledger passes the policy."""
    return F.col("failed_bits").bitwiseAND(policy_mask(policy)) == 0


def apply_policy(docs: DataFrame, policy: str = "v1", text: str = "text") -> DataFrame:
    """The documents that pass the policy, with the columns of docs, whatever their names.

    Null and empty texts have no words and break rules; repeated rows fare alike.
    """
    whole = docs.select(F.struct("*").alias("own"), F.col(text).alias("text"))  # own names cannot clash inside
    # the explode keeps the filter above the ledger: pushed down into it, it would
    # split the text again for every element that a rule looks at
    bits = F.explode(F.array("failed_bits")).alias("bits")
    kept = F.col("bits").bitwiseAND(policy_mask(policy)) == 0
    return ledger(whole).select("own", bits).where(kept).select("own.*")


def ablate(scored: DataFrame, policy: str = "v1") -> DataFrame:
    """What each rule of a policy does, from one pass over the ledger.

    n_failed: documents that break the rule; n_only: documents that break no other
    rule of the policy, which come back if the rule is dropped; n_after: documents
    kept without the rule. Counts combine before the single small shuffle.
    """
    mask = policy_mask(policy)
    bits = F.col("failed_bits").bitwiseAND(mask)
    aggs = [F.count_if(bits == 0).alias("_kept")]
    for name in POLICIES[policy]:
        bit = policy_bit(name)
        aggs += [F.count_if(bits.bitwiseAND(bit) != 0).alias(f"_{name}"), F.count_if(bits == bit).alias(f"_{name}_only")]
    rows = F.array(
        *(
            F.struct(
                F.lit(n).alias("rule"),
                F.col(f"_{n}").alias("n_failed"),
                F.col(f"_{n}_only").alias("n_only"),
                (F.col("_kept") + F.col(f"_{n}_only")).alias("n_after"),
            )
            for n in POLICIES[policy]
        )
    )
    return scored.agg(*aggs).select(F.inline(rows))


def patterns(scored: DataFrame) -> DataFrame:
    """failed_bits and n_docs: how many documents of the ledger fail just these rules (64 patterns at most)."""
    return scored.groupBy("failed_bits").agg(F.count("*").alias("n_docs"))


def ablations(scored: DataFrame, most: int = 2) -> DataFrame:
    """What every policy keeps if up to most of its rules are dropped together.

    policy; dropped, the rules' names joined by +, empty for the policy as it is; n_kept;
    n_more, how many documents come back; all_bits and any_bits, the rules that all and
    that any of its rejected documents fail (null: none rejected). One pass counts
    patterns of bits; masks decide the rest. An empty ledger gives no rows.
    """
    cases = []
    for policy, tests in POLICIES.items():
        for drop in (d for k in range(most + 1) for d in combinations(tests, k)):
            left = policy_mask(policy) & ~sum(map(policy_bit, drop))
            cases.append(F.struct(F.lit(policy).alias("policy"), F.lit("+".join(drop)).alias("dropped"), F.lit(policy_mask(policy)).alias("mask"), F.lit(left).alias("left")))
    rows = patterns(scored).select("failed_bits", "n_docs", F.inline(F.array(*cases)))
    kept, whole = (F.col("failed_bits").bitwiseAND(F.col(c)) == 0 for c in ("left", "mask"))
    return rows.groupBy("policy", "dropped").agg(
        F.sum(F.when(kept, F.col("n_docs")).otherwise(0)).alias("n_kept"),
        F.sum(F.when(kept & ~whole, F.col("n_docs")).otherwise(0)).alias("n_more"),
        F.bit_and(F.when(~kept, F.col("failed_bits"))).alias("all_bits"),
        F.bit_or(F.when(~kept, F.col("failed_bits"))).alias("any_bits"),
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ablations(stored_ledger(table(spark, sf_dir, "documents")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = stored_ledger(table(spark, sf_dir, "documents"), "doc_id")
    base = F.col("failed_bits").bitwiseAND(policy_mask("base")) != 0
    return scored.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        passes("v1").alias("kept"),
        "failed_bits",
    )


_JUDGED = r"""
WITH cut AS (
  SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS said
  FROM documents
), windows AS (
  SELECT nr, pos, words[pos] AS a, words[pos + 1] AS b, words[pos + 2] AS c
  FROM (SELECT nr, words, unnest(range(1, len(words) - 1)) AS pos FROM cut)
), repeated AS (
  SELECT nr, pos FROM (SELECT nr, pos, count(*) OVER (PARTITION BY nr, a, b, c) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT nr, count(DISTINCT pos + k) AS n FROM repeated, range(0, 3) AS r(k) GROUP BY nr
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         len(said)::BIGINT AS n_lines,
         (len(said) - len(list_distinct(said)))::BIGINT AS n_dup_lines,
         length(regexp_replace(t, '[^\p{Lu}]+', '', 'g'))::BIGINT AS n_upper,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM cut LEFT JOIN covered USING (nr)
), judged AS (
  SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
             + 4 * (2 * n_symbols > n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
             + 16 * (word_chars > 20 * n_words)::INT + 32 * (2 * n_upper > word_chars)::INT)::INT AS failed_bits
  FROM measured
)
"""

OP6_SQL = _JUDGED + """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & 3) <> 0 AS base_failed, (failed_bits & 15) = 0 AS kept, failed_bits
FROM judged
"""

_CASES = ", ".join(
    f"('{policy}', '{'+'.join(drop)}', {policy_mask(policy)}, {policy_mask(policy) & ~sum(policy_bit(n) for n in drop)})"
    for policy, tests in POLICIES.items()
    for k in range(3)
    for drop in combinations(tests, k)
)
ABLATIONS_SQL = (
    _JUDGED
    + f"""
SELECT policy, dropped,
       sum(((failed_bits & rest) = 0)::INT)::BIGINT AS n_kept,
       sum(((failed_bits & rest) = 0 AND (failed_bits & mask) <> 0)::INT)::BIGINT AS n_more,
       bit_and(CASE WHEN (failed_bits & rest) <> 0 THEN failed_bits END) AS all_bits,
       bit_or(CASE WHEN (failed_bits & rest) <> 0 THEN failed_bits END) AS any_bits
FROM judged, (VALUES {_CASES}) t(policy, dropped, mask, rest)
GROUP BY policy, dropped
"""
)
