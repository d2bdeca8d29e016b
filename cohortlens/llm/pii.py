"""Personal data: expressions propose spans, checksums confirm them, nearby words move the score.

SQL functions only. Every span has a score of 0 to 1: its kind's, more if a word that goes with the kind stands in the
``WINDOW`` characters ahead of it (back to the match before it), less if a word that speaks against it does. The four
base kinds (email, ip, card, phone) are always kept once their own check holds, with their scores for the caller to
judge by; the further kinds (iban, ssn) are kept from a score of ``THRESHOLD`` on. An account number has the length of
its country and is cut to it where it was written in groups and more groups follow.

Defined results: a NULL text counts as empty and has no span; an empty table gives an empty table;
repeated rows each get their own result; further columns of the input are ignored by ``detect`` and
kept as they are by ``redact``. Expressions are free of nested backtracking, so very long texts and
very long runs of digits or letters are scanned in linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh
from .spans import digest, found, located, ordered

# Fixed values. A run of local-part characters can only match from its first character (or from the
# end of the previous match, \G), and a digit run only from its first digit, which is what
# "leftmost, non-overlapping" gives; the look-behinds state it so that no start is tried twice.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.35}
CONTEXT = {
    "email": r"mail|contact|write to|@",
    "ip": r"\bip\b|address|host|server|login",
    "card": r"card|visa|master|amex|credit|debit|pay",
    "phone": r"phone|tel|call|mobile|fax|whatsapp",
    "iban": r"iban|account|bank|transfer",
    "ssn": r"\bssn\b|social|security|tax",
}
AGAINST = {
    "email": r"example|no-?reply",
    "ip": r"version|release|build|section",
    "card": r"order|serial|isbn|tracking|invoice",
    "phone": r"order|serial|part|offset",
    "iban": r"order|serial|part|sample|example|licen[cs]e",
    "ssn": r"order|serial|part|sample|example|invoice|\blot\b",
}
CONTEXT_GAIN, CONTEXT_LOSS, WINDOW, THRESHOLD = 0.2, 0.4, 40, 0.5
#: The length of an account number by country.
IBAN_LENGTH = {k: int(n) for n, names in (line.split(": ") for line in """15: NO
16: BE
18: DK FI FK FO GL NL SD
19: MK SI
20: AT BA EE KZ LT LU MN XK
21: CH HR LI LV
22: BG BH CR DE GB GE IE ME RS VA
23: AE GI IL IQ OM SO TL
24: AD CZ ES MD PK RO SA SE SK TN VG
25: LY PT ST
26: IS TR
27: BI DJ FR GR IT MC MR SM
28: AL AZ BY CY DO GT HN HU LB NI PL SV
29: BR EG PS QA UA
30: JO KW MU YE
31: MT SC
32: LC
33: RU""".splitlines()) for k in names.split()}
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def mod97(iban: Column) -> Column:
    """Remainder of the account number (first four characters moved to the end) by 97."""
    s = F.regexp_replace(iban, " ", "")
    chars = F.split(F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4)), "")
    digit = lambda c: (c >= "0") & (c <= "9")
    return F.aggregate(chars, F.lit(0), lambda acc, c: F.when(c == "", acc).when(
        digit(c), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(match, "[ -]", "")
        return (F.length(digits) <= 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)
    if kind == "iban":
        return mod97(match) == 1
    return F.lit(True)


def _account(span: Column) -> Column:
    """The span cut to its country's length; its match NULL where no group ends there or the country is unknown."""
    n = F.element_at(F.create_map(*[F.lit(x) for pair in IBAN_LENGTH.items() for x in pair]), F.substring(span.match, 1, 2))
    n = F.when(F.contains(span.match, F.lit(" ")), n + F.floor((n - 1) / 4).cast("int")).otherwise(n)
    whole = (F.char_length(span.match) == n) | (F.substr(span.match, n + 1, F.lit(1)) == " ")
    return F.struct(span.start.alias("start"), (span.start + n).alias("end"),
                    F.when(whole, F.substr(span.match, F.lit(1), n)).alias("match"), span.before.alias("before"))


def _score(kind: str, span: Column) -> Column:
    """The kind's score, moved by the words ahead of the span."""
    before = F.lower(span.before)
    score = F.lit(SCORE[kind]) + F.when(before.rlike(CONTEXT[kind]), CONTEXT_GAIN).otherwise(0.0) \
        - F.when(before.rlike(AGAINST[kind]), CONTEXT_LOSS).otherwise(0.0)
    return F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 2)


def _spans(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with a struct column ``out`` of one span array (start, end, match, score) per kind."""
    tmp = fresh(df, "pii_matches")
    t = F.coalesce(F.col(text_col), F.lit(""))
    only_if = {"email": F.contains(t, F.lit("@")), "phone": F.contains(t, F.lit("+"))}
    df = df.withColumn(tmp, F.struct(*[found(t, p, only_if.get(k)).alias(k) for k, p in PATTERNS.items()]))

    def one(kind: str) -> Column:
        spans = located(t, PATTERNS[kind], F.col(tmp)[kind], WINDOW)
        ok = F.filter(F.transform(spans, _account) if kind == "iban" else spans, lambda s: _valid(kind, s.match))
        scored = F.transform(ok, lambda s: F.struct(
            s.start.alias("start"), s.end.alias("end"), s.match.alias("match"), _score(kind, s).alias("score")))
        return scored if kind in BASE else F.filter(scored, lambda s: s.score >= THRESHOLD)

    return df.withColumn(out, F.struct(*[one(k).alias(k) for k in PATTERNS])).drop(tmp)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and, per kind, its spans: array of (start, end, match, score)."""
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    df = _spans(df, "text", "found")
    return df.select(F.col("id").alias(id_col), *[F.col("found")[k].alias(k) for k in PATTERNS])


def summary(docs: DataFrame) -> DataFrame:
    """Counts and digest columns of ``detect``: one row per row of ``docs``; ``scores`` in the order of ``spans``."""
    d = detect(docs)
    d = d.withColumn("base", ordered([(k, F.col(k)) for k in BASE])) \
         .withColumn("all", ordered([(k, F.col(k)) for k in PATTERNS], "score"))
    return d.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.encode(digest(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        digest(F.col("all")).alias("spans"),
        F.array_join(F.transform("all", lambda s: s.score.cast("string")), ",").alias("scores"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans share the first's.

    ``n_chars``, where present, is the new length. A NULL text stays NULL.
    """
    found_col, text = fresh(docs, "pii_found"), F.col(text_col)
    df = _spans(docs, text_col, found_col)
    every = ordered([(k, F.col(found_col)[k]) for k in PATTERNS])
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def put(acc, s):
        gap = F.substring(text, acc.pos + 1, s.start - acc.pos)
        fresh_span = F.struct(s.end.alias("pos"), F.concat(
            acc.out, gap, F.lit("["), F.upper(s.kind), F.lit("]")).alias("out"))
        longer = F.struct(F.greatest(acc.pos, s.end).alias("pos"), acc.out.alias("out"))
        return F.when(s.start >= acc.pos, fresh_span).otherwise(longer)

    clean = F.aggregate(every, start, put, lambda acc: F.concat(
        acc.out, F.substring(text, acc.pos + 1, F.char_length(text) - acc.pos)))
    hit = F.lit(False)
    for k in PATTERNS:
        hit = hit | (F.size(F.col(found_col)[k]) > 0)
    new_text = fresh(docs, "pii_text")
    df = df.withColumn(new_text, F.when(hit, clean).otherwise(text))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.col(new_text).alias(c))
        elif c == "n_chars":
            cols.append(F.when(F.col(new_text).isNull(), F.col(c)).otherwise(F.char_length(new_text))
                        .cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(cols)
