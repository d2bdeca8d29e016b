"""B06 conditional counters, B18 value exclusion."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import exclude_values_predicate


def conditional_counts(df: DataFrame, keys: Sequence[str], counters: Mapping[str, Column],
                       aggregates: Sequence[Column] = ()) -> DataFrame:
    """One ``count_if`` per named condition (0, not NULL, for a group without matches).

    ``aggregates`` are computed in the same pass (one hash aggregate with map-side partial
    aggregation, so a hot key is combined before the shuffle).
    """
    aggs = list(aggregates) + [F.count_if(cond).alias(name) for name, cond in counters.items()]
    return df.groupBy(*keys).agg(*aggs)


def exclude_values(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    """``WHERE col NOT IN (values)``; NULL ``col`` is dropped as well (pushed to the scan)."""
    return df.filter(exclude_values_predicate(col, values))
