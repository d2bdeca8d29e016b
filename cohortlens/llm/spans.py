"""Character spans of regular-expression matches, with SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,match:string{}>>"


def found(text: Column, pattern: str, only_if: Column | None = None) -> Column:
    """The matched strings; ``only_if`` is a cheap necessary condition (e.g. the text has an '@')."""
    got = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return got if only_if is None else F.when(only_if, got).otherwise(F.array().cast("array<string>"))


def located(text: Column, pattern: str, matches: Column, before: int = 0) -> Column:
    """``matches`` (from ``found`` with the same pattern) with their places in code points.

    Splitting on the pattern gives the text between the matches; a running sum over both gives the
    places. Texts without a match are not split. With ``before``, a span has a field of that name: at most
    as many characters ahead of it, back to the match before it (so that a text is read once, however many spans).
    """
    gaps = F.split(text, pattern, -1)

    def near(gap: Column) -> list[Column]:
        return [F.right(gap, F.lit(before)).alias("before")] if before else []

    pairs = F.zip_with(gaps, F.concat(matches, F.array(F.lit(None).cast("string"))),
                       lambda g, m: F.struct(F.char_length(g).alias("gap"), m.alias("match"), *near(g)))
    none = F.array().cast(SPAN.format(",before:string" if before else ""))
    start = F.struct(F.lit(0).alias("pos"), none.alias("out"))

    def add(acc, x):
        a = acc.pos + x.gap
        b = a + F.coalesce(F.char_length(x.match), F.lit(0))
        span = F.struct(a.alias("start"), b.alias("end"), x.match.alias("match"), *([x.before.alias("before")] if before else []))
        return F.struct(b.alias("pos"), F.when(x.match.isNull(), acc.out)
                        .otherwise(F.concat(acc.out, F.array(span))).alias("out"))

    return F.when(F.size(matches) > 0, F.aggregate(pairs, start, add, lambda acc: acc.out)) \
        .otherwise(none)


def ordered(by_kind: list[tuple[str, Column]], *further: str) -> Column:
    """All spans of all kinds by start, then kind in the given order, then end; ``further`` fields go along."""
    def ranked(i: int, kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s.start.alias("start"), F.lit(i).alias("rank"), s.end.alias("end"), F.lit(kind).alias("kind"),
            *[s[f].alias(f) for f in further]))

    return F.array_sort(F.concat(*[ranked(i, kind, spans) for i, (kind, spans) in enumerate(by_kind)]))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of ``ordered`` spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
