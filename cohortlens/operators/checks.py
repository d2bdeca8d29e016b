"""Key uniqueness at joins, counted while the join runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..sources.publish import Counters


class KeyCheck:
    """Rows of a join's inputs and of its result, observed in the pass that computes them.

    A key that one side repeats makes the other side's rows come out more often than they went in;
    ``verify``, called after the action, raises then.
    """

    def __init__(self, name: str):
        self.name, self._counters = name, Counters()

    def left(self, df: DataFrame) -> DataFrame:
        return self._counters.count(df, "left")

    def right(self, df: DataFrame) -> DataFrame:
        return self._counters.count(df, "right")

    def joined(self, df: DataFrame, left: Column | None = None, right: Column | None = None) -> DataFrame:
        """``left``/``right``: whether a row of the result comes from that side (leave out a side not to check)."""
        sides = {k: c for k, c in (("left", left), ("right", right)) if c is not None}
        return self._counters.count(df, "joined", **sides)

    def verify(self) -> dict[str, int]:
        n = self._counters.get()
        for side, other in (("left", "right"), ("right", "left")):
            if f"joined_{side}" in n and n[f"joined_{side}"] != n[side]:
                raise ValueError(f"{self.name}: {n[side]} rows of the {side} side came out as {n[f'joined_{side}']}; "
                                 f"the {other} side repeats a key")
        return n
