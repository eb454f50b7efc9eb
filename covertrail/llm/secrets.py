"""Secret scans with multipart credential linking.

Strong patterns are reported wherever they stand. Weak parts (a user name, a
random-looking string, an address) are each common in clean text; they are reported
only where parts that complete a credential lie close together in one paragraph.

Patterns run as SQL regular expressions inside the row, and only spans leave it. The
spans of documents that hold parts of different roles are joined as intervals, by
paragraph and position bin, so no group of spans is paired whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table, text_of

# The strong patterns, with the least length of what they catch. A
# lookahead for the first letters only spares the engine most of its attempts.
ASSIGN = r"""(?=[PpSsTtAa])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# The weak patterns.
IDENT = r"""(?=[UuLlAaCcKk])(?i:user(?:_?name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
VALUE = r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{20,}"
PASS = r"""(?=[PpAa])(?i:pass|pwd|pin|auth)["']?\x20*[:=]\x20*["']?[^\s"']{4,}"""
ENDPOINT = r"""(?=[HhFfJjPpMmRr0-9])(?:(?i:https?|ftp|jdbc:[a-z]+|postgres|mysql|redis)://[^\s"'<>]{3,}|\b\d{1,3}(?:\.\d{1,3}){3}(?::\d+)?\b)"""
BREAK = r"\n[\x20\x09\r]*\n"

#: Kinds in the order that breaks ties, and the part of a credential each can be.
KINDS = ("assign", "access", "hex", "ident", "value", "pass", "endpoint")
ROLES = {"assign": "secret", "access": "ident", "hex": "secret", "ident": "ident", "value": "secret", "pass": "secret", "endpoint": "endpoint"}
STRONG = ("assign", "access", "hex")


#: Parts this many code points apart, start to start, can belong together.
REACH = 300

_PIECE = "array<struct<gap:int,hit:int,ok:boolean>>"


def _pieces(text: Column, pattern: str, ok) -> Column:
    """For each match: length of the text since the last one, of the match, and ok(match, group 1)."""
    zipped = F.arrays_zip(
        F.split(text, pattern).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1 if "([" in pattern else 0)).alias("value"),
    )
    cut = F.transform(
        zipped,
        lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), ok(x["hit"], x["value"]).alias("ok")),
    )
    return F.when(text.rlike(pattern), F.filter(cut, lambda x: x["hit"].isNotNull()).cast(_PIECE))


def _parts(text: Column) -> dict[str, Column]:
    always = lambda hit, value: F.lit(True)
    random = lambda hit, value: hit.rlike("[a-z]") & hit.rlike("[A-Z]") & hit.rlike("[0-9]")
    return {
        "assign": _pieces(text, ASSIGN, lambda hit, value: F.length(value) >= 6),
        "access": _pieces(text, ACCESS, always),
        "hex": _pieces(text, HEX, always),
        "ident": _pieces(text, IDENT, always),
        "value": _pieces(text, VALUE, random),
        "pass": _pieces(text, PASS, always),
        "endpoint": _pieces(text, ENDPOINT, always),
    }


def _placed(rows: DataFrame, pieces: Column) -> DataFrame:
    """row, rank, start, end of every piece that is ok."""
    cut = rows.select("row", F.inline(pieces)).select("row", "rank", F.posexplode("pieces").alias("i", "p"))
    before = Window.partitionBy("row", "rank").orderBy("i")
    end = F.sum(F.col("p.gap") + F.col("p.hit")).over(before).cast("int")
    return cut.select("row", "rank", (end - F.col("p.hit")).alias("start"), end.alias("end"), F.col("p.ok").alias("ok")).where("ok").drop("ok")


def _near(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of left with a row of right in the same paragraph within REACH."""
    bins = F.explode(F.array(*(F.expr(f"start div {REACH}") + d for d in (-1, 0, 1))))
    right = right.select("row", "scope", bins.alias("bin"), F.col("start").alias("other"))
    left = left.withColumn("bin", F.expr(f"start div {REACH}"))
    joined = left.join(right, (left.row == right.row) & (left.scope == right.scope) & (left.bin == right.bin) & (F.abs(left.start - right.other) <= REACH), "left_semi")
    return joined.drop("bin")


def _kinds_of(*roles: str) -> Column:
    return F.col("rank").isin(*(i for i, k in enumerate(KINDS) if ROLES[k] in roles))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with spans, an array of (kind, start, end, strong) sorted by start.

    Positions are code points, end exclusive. Strong kinds: assign (value of 6 or more
    characters), access, hex. Weak kinds are added where they complete a credential:
    value and pass beside an access id, user name or endpoint; ident and endpoint beside
    a secret. Spans of different kinds may overlap. A null or empty text has an
    empty array; repeated rows each get their own; the text itself is not kept and a column named spans is replaced.
    """
    t = text_of(text)
    keep = [c for c in docs.columns if c not in (text, "spans")]
    tagged = docs.select(F.struct(*keep).alias("of"), F.monotonically_increasing_id().alias("row"), t.alias("t"))
    tagged = tagged.select("of", "row", "t", F.struct(*(c.alias(k) for k, c in _parts(F.col("t")).items())).alias("found"))
    has = lambda role: F.coalesce(*(F.col(f"found.{k}") for k in KINDS if ROLES[k] == role)).isNotNull()
    linkable = has("secret") & (has("ident") | has("endpoint"))
    breaks = F.when(linkable, _pieces(F.col("t"), BREAK, lambda hit, value: F.lit(True)))
    tagged = materialise(tagged.select("of", "row", "found", breaks.alias("breaks"), linkable.alias("linkable")), "secrets")

    listed = F.array(*(F.struct(F.lit(i).alias("rank"), F.col(f"found.{k}").alias("pieces")) for i, k in enumerate(KINDS)))
    parts = _placed(tagged.where(F.coalesce(*(F.col(f"found.{k}") for k in KINDS)).isNotNull()), listed)
    weak = _link(tagged, parts)
    strong = parts.where(F.col("rank").isin(*(KINDS.index(k) for k in STRONG)))

    names = F.array(*(F.lit(k) for k in KINDS))
    spans = (
        strong.withColumn("strong", F.lit(True))
        .unionByName(weak.withColumn("strong", F.lit(False)))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end", "strong"))).alias("s"))
    )
    named = F.transform("s", lambda x: F.struct(F.element_at(names, x["rank"] + 1).alias("kind"), x["start"], x["end"], x["strong"]))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,strong:boolean>>")
    return tagged.select("of", "row").join(spans, "row", "left").select("of.*", F.coalesce(named, empty).alias("spans"))


def _link(tagged: DataFrame, parts: DataFrame) -> DataFrame:
    """The weak parts whose complements lie near, in the same paragraph."""
    rows = tagged.where("linkable")
    cuts = _placed(rows.where(F.col("breaks").isNotNull()), F.array(F.struct(F.lit(-1).alias("rank"), F.col("breaks").alias("pieces"))))
    events = parts.join(rows.select("row"), "row", "left_semi").unionByName(cuts)
    scope = F.count_if(F.col("rank") < 0).over(Window.partitionBy("row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, 0))
    placed = events.withColumn("scope", scope).where("rank >= 0")
    weak = placed.where(~F.col("rank").isin(*(KINDS.index(k) for k in STRONG)))
    others, secrets = placed.where(_kinds_of("ident", "endpoint")), placed.where(_kinds_of("secret"))
    by_role = (
        _near(weak.where(_kinds_of("secret")), others),
        _near(weak.where(_kinds_of("ident", "endpoint")), secrets),
    )
    return by_role[0].unionByName(by_role[1]).drop("scope")


def _listing(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["strong"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.withColumn("base", base).select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in STRONG),
        F.sha2(_listing(F.col("base")), 256).alias("base_sha256"),
        _listing(F.col("spans")).alias("spans"),
    )
