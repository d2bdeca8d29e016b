"""Connected components of an edge list, as Spark joins and aggregates (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that is linked to a smaller one; root is its component's smallest.

    Each round links every node's larger neighbours to its smallest neighbour (large star), then its
    smaller ones (small star), until the edges are one star per component; that takes a number of
    rounds logarithmic in the component's size. Minima are combined before they are shuffled, and the
    joins back to the edges are plain equi-joins, so a node with very many neighbours is split by
    adaptive skew handling. Every round is a table in the shared checkpoint folder.
    """
    ends = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    stars = materialize(ends.distinct(), "edges")
    seen = _signature(stars)
    while seen[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = materialize(down.unionByName(least.withColumnRenamed("m", "b")).distinct(), "edges")
        now = _signature(stars)
        if now == seen:
            break
        seen = now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
