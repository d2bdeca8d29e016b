"""B12 cohort conversion, B16 outcome label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import safe_ratio


def cohort_conversion(df: DataFrame, group: Sequence[str | Column], is_member: str, converted: str,
                      duration: str, names: Sequence[str] = (
                          "trials_started", "trials_converted", "conversion_rate",
                          "avg_days_to_convert", "median_days_to_convert")) -> DataFrame:
    """Per group, members, converted members, their ratio (NULL on 0 members), and the mean
    and exact interpolated median of ``duration`` over converted rows.

    Everything is taken from one aggregate by (group, duration), combined before its shuffle. The median is
    selected by cumulative frequencies: a group's durations are sorted and summed as rows, so no task
    holds a map of a group's values, however many there are.
    """
    started, conv, rate, avg_name, med_name = names
    src = df.select(*group, F.col(is_member).alias("_m"), F.col(converted).alias("_c"),
                    F.when(F.col(converted), F.col(duration)).alias("_v"))
    keys = src.columns[:len(group)]
    freq = src.groupBy(*keys, "_v").agg(
        F.count_if(F.col("_m")).alias("_members"), F.count_if(F.col("_m") & F.col("_c")).alias("_converted"),
        F.count("_v").alias("_n"))
    lower, upper, share, picked = selected_by_frequency(freq, keys, "_v", "_n", 0.5)
    return picked.groupBy(*keys).agg(
        F.sum("_members").alias(started),
        F.sum("_converted").alias(conv),
        safe_ratio(F.sum("_converted"), F.sum("_members")).alias(rate),
        safe_ratio(F.sum(F.col("_v") * F.col("_n")), F.sum("_n")).alias(avg_name),
        (F.min(lower) + (F.min(upper) - F.min(lower)) * F.max(share)).alias(med_name),
    )


def selected_by_frequency(freq: DataFrame, keys: Sequence[str], value: str, n: str, q: float) \
        -> tuple[Column, Column, Column, DataFrame]:
    """The interpolated ``q`` quantile of values that come ``n`` times, by their cumulative frequencies.

    Returns the columns whose minimum over a group is the value below and the value above the quantile's place,
    the place's share of the way between them (equal in all rows of a group), and the frame to aggregate.
    Rows of a NULL value must have ``n`` 0.
    """
    group = Window.partitionBy(*keys)
    upto = group.orderBy(F.col(value).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    picked = freq.withColumns({"_upto": F.sum(n).over(upto), "_place": (F.sum(n).over(group) - 1) * F.lit(q)})
    held = F.col(n) > 0
    lower = F.when(held & (F.col("_upto") > F.floor("_place")), F.col(value)).cast("double")
    upper = F.when(held & (F.col("_upto") > F.ceil("_place")), F.col(value)).cast("double")
    return lower, upper, F.col("_place") - F.floor("_place"), picked


def outcome_label(flags: Sequence[tuple[Column, str]], default: str) -> Column:
    """The label of the first flag that holds (NULL flags count as not holding)."""
    out = F.lit(default)
    for cond, label in reversed(list(flags)):
        out = F.when(F.coalesce(cond, F.lit(False)), F.lit(label)).otherwise(out)
    return out
