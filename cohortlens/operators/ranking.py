"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column],
                   tie_break: Sequence[str] | None = None, rank_col: str = "_rank") -> DataFrame:
    """Keep one row per key: the first by ``order`` (e.g. ``desc_nulls_last`` columns).

    A full tie would be non-deterministic, so the remaining columns (``tie_break``, default: every
    column) are appended to the ordering. The filter sits directly on ``row_number`` so Catalyst
    plans a partial WindowGroupLimit before the shuffle: each map task forwards at most one row per
    key, which keeps a hot key from landing whole in one reducer.
    """
    tie_break = list(df.columns if tie_break is None else tie_break)
    w = Window.partitionBy(*keys).orderBy(*order, *[F.col(c).asc_nulls_last() for c in tie_break])
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)
