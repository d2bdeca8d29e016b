"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, through Spark's reader (the folder may be in any store Spark reads)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back (cuts the lineage).

    A lost executor costs only its running tasks: the table is not kept on executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def by_chars(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive slices [i, j) of ``texts`` of at most ``limit`` characters (one text at least)."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        if j > i and size + len(t) > limit:
            yield i, j
            i, size = j, 0
        size += len(t)
    if i < len(texts):
        yield i, len(texts)


def crc32_mod(column: str, n: int):
    """crc32 of the column's text, modulo ``n``; NULL stays NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n
