"""Three-way entity resolution between a left (system of record) and a right source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checks import KeyCheck


def resolve_entities(left: DataFrame, right: DataFrame, keys: Sequence[str], label_col: str,
                     labels: tuple[str, str, str], check: KeyCheck | None = None) -> DataFrame:
    """Label every key as in both / left only / right only and return their union.

    * every ``left`` row is kept, with the ``right`` columns of its key: label 0 when the right
      side has the key, label 1 when it does not;
    * ``right`` rows whose key ``left`` lacks are added with NULL left columns and label 2. A NULL key
      never matches, so it survives on either side.

    Both inputs should be at key grain (one row per key). The resolution is one full outer join on the
    key: each side is shuffled once, and nothing is computed twice. The result's columns are ``left``'s,
    then ``right``'s non-key columns, then the label. ``check`` counts the rows of both sides and of the result
    on the way, to find a key that a side repeats.
    """
    both, left_only, right_only = labels
    lm, rm = "_left_present", "_right_present"
    out_cols = list(left.columns) + [c for c in right.columns if c not in keys] + [label_col]
    if check is not None:
        left, right = check.left(left), check.right(right)
    joined = left.withColumn(lm, F.lit(True)).join(right.withColumn(rm, F.lit(True)), list(keys), "full_outer")
    if check is not None:
        joined = check.joined(joined, F.col(lm), F.col(rm))
    label = (F.when(F.col(lm) & F.col(rm), F.lit(both))
             .when(F.col(lm), F.lit(left_only)).otherwise(F.lit(right_only)))
    return joined.withColumn(label_col, label).select(out_cols)
