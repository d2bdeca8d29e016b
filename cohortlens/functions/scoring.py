"""Score helpers of the health model (B15) and the null-safe ratio."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b`` as double, NULL when ``b`` is 0 or NULL."""
    return col_of(a).cast("double") / F.nullif(col_of(b).cast("double"), F.lit(0.0))


def banded(conditions: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """First (condition, value) pair whose condition holds wins; else ``default``."""
    out = F.lit(default) if not isinstance(default, Column) else default
    for cond, value in reversed(list(conditions)):
        out = F.when(cond, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def recency_points(last_date: Column | str, as_of: Column, bands: Iterable[tuple[int, int]]) -> Column:
    """Points for the first band (days, points) with ``last_date >= as_of - days``; else 0."""
    d = col_of(last_date)
    return banded([(d >= F.date_sub(as_of, days), points) for days, points in bands], 0)


def pattern_map(c: Column | str, patterns: Iterable[tuple[str, object]], other: object,
                null_value: object = None) -> Column:
    """Value for the first pattern contained in ``upper(c)``; ``other`` if none; ``null_value`` on NULL."""
    x = col_of(c)
    up = F.upper(x)
    pairs = [(x.isNull(), null_value)] + [(up.contains(p.upper()), v) for p, v in patterns]
    return banded(pairs, other)


def saturating_ratio(num: Column | str, den: Column | str, cap: float) -> Column:
    """``least(cap, num / den * cap)`` in double; NULL when ``den`` is 0 or NULL.

    Spark's ``least`` skips NULLs, so a NULL ratio would silently become ``cap``; guard it so the
    result stays NULL like the warehouse's ``least``.
    """
    ratio = safe_ratio(num, den) * F.lit(float(cap))
    return F.when(ratio.isNull(), F.lit(None).cast("double")).otherwise(F.least(F.lit(float(cap)), ratio))


def flags_sum(cols: Iterable[Column | str]) -> Column:
    """Number of columns whose value (NULL as 0) is positive, as int."""
    terms = [F.when(F.coalesce(col_of(c), F.lit(0)) > 0, F.lit(1)).otherwise(F.lit(0)) for c in cols]
    out = F.lit(0)
    for t in terms:
        out = out + t
    return out


def tier_label(score: Column | str, tiers: Iterable[tuple[int, str]], floor: str) -> Column:
    """Label of the first (minimum, label) with ``score >= minimum``; else ``floor``."""
    s = col_of(score)
    return banded([(s >= F.lit(lo), label) for lo, label in tiers], floor)
