"""B11 period delta, B14 group averages on every row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def period_delta(df: DataFrame, partition: Sequence[str], order: str, value: str, out: str,
                 previous: str | None = None) -> DataFrame:
    """``value`` minus its value on the previous present row of the partition (NULL first).

    Meant for report-grain frames (period x product); the window shuffles on ``partition``.
    """
    prev = F.lag(value, 1).over(Window.partitionBy(*partition).orderBy(order))
    df = df.withColumn(previous or "_prev", prev)
    df = df.withColumn(out, F.col(value) - F.col(previous or "_prev"))
    return df if previous else df.drop("_prev")


def attach_group_avg(df: DataFrame, keys: Sequence[str], averages: Mapping[str, str],
                     salt: int = 32) -> DataFrame:
    """The mean of each column over its group, repeated on every row (``avg() over (partition
    by keys)``), NULL keys forming their own group.

    A whole-partition window would send every row of a group to one task; a group can hold a third
    of the data. Instead the means are aggregated (map-side partial, a few rows per group) and
    joined back with null-safe keys; AQE measures the aggregated side at run time and broadcasts it when
    it is under the broadcast threshold. Where it stays a shuffle join, each group is dealt to ``salt``
    tasks and its row of means copied to all of them.

    The aggregate also reads a hash of the whole row (``_g_all``, never NULL): with it both readers of
    ``df`` need the same columns, so column pruning leaves them equal and they share the shuffles below
    instead of computing ``df`` twice.
    """
    g = df.groupBy(*keys).agg(*[F.avg(src).alias(name) for name, src in averages.items()],
                              F.max(F.hash(*df.columns)).alias("_g_all")).filter("_g_all IS NOT NULL")
    g = g.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *averages.keys(),
                 F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("_g_salt"))
    left = df.withColumn("_salt", F.pmod(F.hash(*df.columns), F.lit(salt)))
    cond = F.col("_salt") == F.col("_g_salt")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return left.join(g, cond, "left").drop("_salt", "_g_salt", *[f"_g_{k}" for k in keys])
