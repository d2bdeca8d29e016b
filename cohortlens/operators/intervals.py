"""Interval and period operators: B07 month spine, B08 active by month, B09 first period,
B10 rows without a successor."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import OPEN_END_DATE
from ..functions._util import col_of


def month_of(c: Column | str) -> Column:
    """First day of the month, as a date (``trunc``; ``date_trunc`` would give a timestamp)."""
    return F.trunc(F.to_date(col_of(c)), "MM")


def month_spine(df: DataFrame, date_col: str, out: str = "month") -> DataFrame:
    """The distinct months present in ``date_col`` (no calendar filling).

    Its size is bounded by the calendar, not by the data: a date column spans at most 120,000
    distinct months (years 1-9999), a few MB at worst, so it is safe to broadcast.
    """
    return df.select(month_of(date_col).alias(out)).filter(F.col(out).isNotNull()).distinct()


def month_index(c: Column | str) -> Column:
    """Months since year 0 (year * 12 + month - 1) as int: a cheap integer form of a month."""
    d = F.to_date(col_of(c))
    return F.year(d) * 12 + F.month(d) - 1


def month_from_index(c: Column | str) -> Column:
    """Inverse of :func:`month_index`: the first day of that month."""
    i = col_of(c)
    return F.make_date(F.floor(i / 12).cast("int"), (i % 12 + 1).cast("int"), F.lit(1))


def active_by_month(intervals: DataFrame, spine: DataFrame, group: Sequence[str], entity: str,
                    start: str, end: str, out: str = "active_count", month: str = "month",
                    open_end: _dt.date = OPEN_END_DATE) -> DataFrame:
    """Distinct ``entity`` per (spine month, ``group``) whose interval covers the whole month
    up to its last day: ``start <= last_day(m)`` and ``coalesce(end, open_end) >= last_day(m)``.

    Filter the interval rows you want counted (e.g. by status) before calling.

    A sweep line: intervals become runs of months, and the runs of one entity are united (the part of a run that
    an earlier one of the same entity covers is cut off), so at any month an entity is counted once. Every
    remaining run adds 1 at its first month and takes it away after its last; the running sum of these steps,
    per group, is the number of active entities from one step to the next. No row is multiplied by months: an
    entity has at most one run per start month after the first, map-side combined aggregate, so a hot entity
    is bounded by the calendar. Only the steps, at most two for each month of a group, meet the spine (one
    sorted array of month indexes in a scalar subquery; no job runs while the plan is built).
    """
    eff_end = F.coalesce(F.col(end), F.lit(open_end))
    # Last month whose last day is still covered.
    hi = month_index(eff_end) - F.when(F.last_day(eff_end) == eff_end, F.lit(0)).otherwise(F.lit(1))
    runs = (intervals.filter(F.col(start).isNotNull() & F.col(entity).isNotNull())
            .select(*group, entity, month_index(start).alias("_lo"), hi.alias("_hi"))
            .filter(F.col("_hi") >= F.col("_lo"))
            .groupBy(*group, entity, "_lo").agg(F.max("_hi").alias("_hi")))
    earlier = Window.partitionBy(*group, entity).orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_from", F.greatest("_lo", F.coalesce(F.max("_hi").over(earlier) + 1, F.col("_lo"))))
    at = F.array(F.struct(F.col("_from").alias("_at"), F.lit(1).alias("_step")),
                 F.struct((F.col("_hi") + 1).alias("_at"), F.lit(-1).alias("_step")))
    steps = (runs.filter(F.col("_hi") >= F.col("_from")).select(*group, F.explode(at).alias("_s"))
             .groupBy(*group, F.col("_s._at").alias("_at")).agg(F.sum("_s._step").alias("_step")))
    line = Window.partitionBy(*group).orderBy("_at")
    levels = steps.select(*group, "_at", F.lead("_at").over(line).alias("_until"),
                          F.sum("_step").over(line.rowsBetween(Window.unboundedPreceding, 0)).alias(out))
    months = spine.agg(F.sort_array(F.collect_set(month_index(month)))).scalar()
    levels = levels.filter(F.col(out) > 0).select(*group, out, "_at", "_until", months.alias("_spine"))
    return levels.select(*group, out, F.explode(F.filter(
        "_spine", lambda m: (m >= F.col("_at")) & (m < F.col("_until")))).alias("_m")) \
        .select(month_from_index("_m").alias(month), *group, out)


def first_period(df: DataFrame, keys: Sequence[str], date_col: str, group: Sequence[str],
                 out: str = "new_count", month: str = "month") -> DataFrame:
    """Month of each key's first ``date_col``, then the number of keys per (month, group).

    ``group`` must be a subset of ``keys`` (e.g. keys = company, product; group = product): each key
    then appears once per group, so a plain count is its distinct count.
    """
    first = df.groupBy(*keys).agg(F.min(date_col).alias("_first"))
    return (first.select(*group, month_of("_first").alias(month))
            .groupBy(month, *group).agg(F.count(F.lit(1)).alias(out)))


def latest_start(df: DataFrame, keys: Sequence[str], start: str, condition: Column | None = None,
                 out: str = "_latest_start") -> DataFrame:
    """Per key, the latest ``start`` among rows meeting ``condition`` (NULL if none qualifies)."""
    s = F.col(start) if condition is None else F.when(condition, F.col(start))
    return df.groupBy(*keys).agg(F.max(s).alias(out))


def without_successor(candidates: DataFrame, successors: DataFrame, keys: Sequence[str], end: str,
                      start: str, condition: Column | None = None) -> DataFrame:
    """``candidates`` rows with a known ``end`` and no ``successors`` row of the same key that
    meets ``condition`` and starts strictly after that end (a correlated NOT EXISTS).

    "No qualifying start after my end" is the same as "the latest qualifying start of the key is
    NULL or not after my end", so the correlated subquery becomes one per-key aggregate (map-side
    combined, skew-safe) joined back on the key: no self-join, no pairs within a key. The joined
    side is unique per key; AQE splits a hot key on the candidate side if one exists.
    """
    ls = latest_start(successors, keys, start, condition)
    return (candidates.filter(F.col(end).isNotNull())
            .join(ls, list(keys), "left")
            .filter(F.col("_latest_start").isNull() | (F.col("_latest_start") <= F.col(end)))
            .drop("_latest_start"))


def without_successor_within(candidates: DataFrame, successors: DataFrame, keys: Sequence[str], end: str,
                             start: str, days: int, condition: Column | None = None) -> DataFrame:
    """B10 with a condition over both rows: ``candidates`` with a known ``end`` and no ``successors`` row of the
    same key that meets ``condition`` and starts after that end, but at most ``days`` days after it.

    One sorted merge of both sides: their rows are united, shuffled once by key and stretch of the calendar (at
    least ``days`` long), and read backwards in time; the running minimum of the starts passed so far is the
    next start after a candidate's end, which decides. A successor goes to the stretches (one or two)
    in which ends may ask for it. A hot key is spread over its stretches, and no pairs are made. A NULL key has
    no successor.
    """
    if days < 0:
        raise ValueError("days must not be negative")
    width = max(days, 31)
    stretch = lambda day: F.floor(day / F.lit(width)).cast("int")
    day = F.unix_date(F.to_date(F.col(end)))
    ends = candidates.filter(F.col(end).isNotNull()).select(
        *keys, stretch(day).alias("_stretch"), day.alias("_day"), F.lit(None).cast("int").alias("_start"),
        F.struct(*candidates.columns).alias("_row"))
    day = F.unix_date(F.to_date(F.col(start)))
    s = successors if condition is None else successors.filter(condition)
    for k in keys:
        s = s.filter(F.col(k).isNotNull())
    starts = s.filter(F.col(start).isNotNull()).select(
        *keys, F.explode(F.sequence(stretch(day - days), stretch(day - 1))).alias("_stretch"), day.alias("_day"),
        day.alias("_start"), F.lit(None).cast(ends.schema["_row"].dataType).alias("_row")) if days else None
    both = ends if starts is None else ends.unionByName(starts)
    # Of equal days an end comes first: a start on the day of the end is no successor.
    back = Window.partitionBy(*keys, "_stretch").orderBy(F.col("_day").desc(), F.col("_start").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    merged = both.withColumn("_next", F.min("_start").over(back)).filter(F.col("_row").isNotNull())
    return merged.filter(F.col("_next").isNull() | (F.col("_next") > F.col("_day") + days)).select("_row.*")
