"""Secrets: three base expressions, plus sliding-window Shannon entropy over candidate strings.

SQL functions only. Every run of key-like characters of ``MIN_LENGTH`` or more is a candidate; each of
its windows of ``WINDOW`` characters gets the Shannon entropy of its characters. A window's counts are kept
while it slides: the leaving character's goes down, the entering one's up, and with them the entropy. A
candidate of a character class is a secret where its highest window reaches the class's threshold, unless
the allow-list names it or it consists for the greater part of placeholder words.

Defined results: a NULL text counts as empty and has no span; an empty table gives an empty table;
repeated rows each get their own result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import digest, found, located, ordered

# Fixed values.
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    "entropy": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+",
}
BASE = ("assign", "access", "hex")
WINDOW = 20
# Bits a character: the threshold of each class; a window has at most log2(20). Words, also joined, come close to
# random characters, so their classes ask for more.
HEX_BITS, ALNUM_BITS, BASE64_BITS, LETTERS_BITS, JOINED_BITS = 3.0, 3.4, 3.7, 3.9, 4.0
HEX_CLASS, LETTERS_CLASS, ALNUM_CLASS = r"^(?:[0-9a-f]+|[0-9A-F]+)$", r"^[A-Za-z]+$", r"^[A-Za-z0-9]+$"
JOINED_CLASS = r"^[-_/=+]*(?:[A-Za-z]+|[0-9]+)(?:[-_/=+]+(?:[A-Za-z]+|[0-9]+))*[-_/=+]*$"
# Allow-list: candidates that are known not to be secrets.
ALLOW = (
    r"^[0-9]+$",                                       # a number
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # a UUID
)
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|x{4,}|0123456789|abcdefgh"


def _xlogx(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(0.0)


def highest_entropy(candidate: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy, in bits a character, of any window of the candidate's characters.

    H = log2(w) - sum(n log2 n) / w over the counts n in the window. The state holds that sum; a step
    changes it only by the counts of the entering and of the leaving character.
    """
    chars = F.filter(F.split(candidate, ""), lambda c: c != "")
    # One-element transforms bind an array to a name: it is made once, not at every step.
    return F.element_at(F.transform(F.array(chars), lambda c: _lowest_sum(c, window)), 1)


def _lowest_sum(chars: Column, window: int) -> Column:
    kinds = F.array_distinct(chars)
    state = F.struct(chars.alias("chars"), kinds.alias("kinds"))
    named = F.transform(F.array(state), lambda s: F.struct(
        F.transform(s.chars, lambda c: F.array_position(s.kinds, c).cast("int")).alias("at"), F.size(s.kinds).alias("kinds")))
    return F.element_at(F.transform(named, lambda s: _slide(s.at, s.kinds, window)), 1)


def _slide(at: Column, kinds: Column, window: int) -> Column:
    """``at``: of every character the number (from 1) of its kind."""
    size = F.size(at)
    first = F.slice(at, 1, window)
    counts = F.transform(F.sequence(F.lit(1), F.greatest(kinds, F.lit(1))), lambda k: F.size(F.filter(first, lambda x: x == k)))
    total = F.aggregate(counts, F.lit(0.0), lambda s, n: s + _xlogx(n))
    start = F.struct(counts.alias("counts"), total.alias("sum"), total.alias("least"))

    def step(acc, i):  # the window that ends before place i (from 1) moves to end at i
        old, new = F.element_at(at, i - window), F.element_at(at, i)
        n_old = F.element_at(acc.counts, old)
        n_new = F.element_at(acc.counts, new) - (old == new).cast("int")
        s = acc["sum"] + _xlogx(n_old - 1) - _xlogx(n_old) + _xlogx(n_new + 1) - _xlogx(n_new)
        moved = F.transform(acc.counts, lambda n, k: n - (k + 1 == old).cast("int") + (k + 1 == new).cast("int"))
        return F.struct(moved.alias("counts"), s.alias("sum"), F.least(acc.least, s).alias("least"))

    steps = F.when(size > window, F.sequence(F.lit(window + 1), size)).otherwise(
        F.array().cast("array<int>"))
    w = F.least(size, F.lit(window)).cast("double")
    return F.aggregate(steps, start, step, lambda acc: F.log2(w) - acc.least / w)


def is_random(candidate: Column) -> Column:
    """Whether the candidate's class threshold is reached and neither the allow-list nor placeholders speak against it."""
    bits = F.when(candidate.rlike(HEX_CLASS), HEX_BITS).when(candidate.rlike(LETTERS_CLASS), LETTERS_BITS) \
        .when(candidate.rlike(ALNUM_CLASS), ALNUM_BITS).when(candidate.rlike(JOINED_CLASS), JOINED_BITS).otherwise(BASE64_BITS)
    rest = F.length(F.regexp_replace(candidate, PLACEHOLDER, ""))
    allowed = rest * 2 < F.length(candidate)
    for entry in ALLOW:
        allowed = allowed | candidate.rlike(entry)
    return F.when(allowed, False).otherwise(highest_entropy(candidate) >= bits)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and, per kind, its spans: array of (start, end, match)."""
    t = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    only_if = {"assign": F.contains(t, F.lit(":")) | F.contains(t, F.lit("=")),
               "access": F.contains(t, F.lit("AKIA"))}
    df = df.withColumn("m", F.struct(*[found(t, p, only_if.get(k)).alias(k) for k, p in PATTERNS.items()]))
    # A text has many candidates that the allow-list drops; only texts with another one are located.
    m = F.col("m")
    df = df.withColumn("secret", F.filter(F.array_distinct(m["entropy"]), is_random))
    valid = {
        "assign": lambda s: F.length(F.regexp_extract(s.match, PATTERNS["assign"], 2)) >= 6,
        "access": lambda s: F.length(s.match) >= 20,
        "hex": lambda s: F.lit(True),
        "entropy": lambda s: F.array_contains(F.col("secret"), s.match),
    }
    out = []
    for kind, pattern in PATTERNS.items():
        matches = m[kind] if kind != "entropy" else \
            F.when(F.size("secret") > 0, m[kind]).otherwise(F.array().cast("array<string>"))
        out.append(F.filter(located(t, pattern, matches), valid[kind]).alias(kind))
    return df.select(F.col("id").alias(id_col), *out)


def summary(docs: DataFrame) -> DataFrame:
    """Counts and digest columns of ``detect``: one row per row of ``docs``."""
    d = detect(docs)
    d = d.withColumn("base", ordered([(k, F.col(k)) for k in BASE])) \
         .withColumn("all", ordered([(k, F.col(k)) for k in PATTERNS]))
    return d.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.encode(digest(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        digest(F.col("all")).alias("spans"))
