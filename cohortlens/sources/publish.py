"""Full refresh of a table without a moment in which there is none.

A refresh writes the whole new version beside the old one and then switches in one step: for a folder, one small
commit file that names the version; for the catalog, one ``CREATE OR REPLACE VIEW``. A refresh that fails before the
switch leaves the old version in place, and a query that began on it reads it to its end. Old
versions stay until ``expire`` is called.

A folder looks like ``<path>/versions/<version>/`` (the data) and ``<path>/commits/`` (rows of seq, version, written by
appending; the highest seq is current). In the catalog, ``db.name`` is a view of ``db.name__v<version>``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT = "seq long, version string"


def _new_version() -> str:
    return f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """All commits of a folder in order: one small row per refresh."""
    fs, folder = _file_system(spark, f"{path}/commits")
    if not fs.exists(folder):
        return []
    return sorted((r.seq, r.version) for r in spark.read.schema(COMMIT).parquet(f"{path}/commits").collect())


def current(spark: SparkSession, path: str) -> str:
    """The folder of the current version's data."""
    done = _commits(spark, path.rstrip("/"))
    if not done:
        raise ValueError(f"nothing is published under {path}")
    return f"{path.rstrip('/')}/versions/{done[-1][1]}"


def read_published(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(current(spark, path))


def prepare(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Writes a new version of the folder ``path`` without switching to it; returns its name."""
    version = _new_version()
    df.write.format(fmt).partitionBy(*partition_by).save(f"{path.rstrip('/')}/versions/{version}")
    return version


def switch(spark: SparkSession, path: str, version: str) -> str:
    """Makes a prepared version the current one; returns its folder."""
    path = path.rstrip("/")
    done = _commits(spark, path)
    seq = done[-1][0] + 1 if done else 1
    spark.createDataFrame([(seq, version)], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return f"{path}/versions/{version}"


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
            check: Callable[[], object] | None = None) -> str:
    """Full refresh of the folder ``path``; returns the folder of the new version.

    ``check`` runs after the write and before the switch (e.g. counters observed while writing): what it raises
    keeps the old version current.
    """
    version = prepare(df, path, fmt, partition_by)
    if check is not None:
        check()
    return switch(df.sparkSession, path, version)


def publish_table(df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                  bucket_by: tuple[int, Sequence[str]] | None = None, check: Callable[[], object] | None = None) -> str:
    """Full refresh of the catalog name ``table``; returns the name of the version's table.

    ``bucket_by``: number of buckets and columns; the version is also sorted by them, so that joins and
    aggregates on these columns read it without an exchange.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        raise ValueError(f"{table} is a table of its own, not a published view")
    version = f"{table}__v{_new_version()}"
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        n, columns = bucket_by
        writer = writer.bucketBy(n, *columns).sortBy(*columns)
    writer.saveAsTable(version)
    if check is not None:
        check()
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")
    return version


def expire(spark: SparkSession, path: str | None = None, table: str | None = None, keep: int = 2) -> list[str]:
    """Drops all published versions but the newest ``keep`` (at least one) and what failed refreshes left behind
    them; returns their names. Queries that still read a dropped version fail."""
    keep = max(1, keep)
    if table is not None:
        database, _, name = table.rpartition(".")
        names = sorted(t.name for t in spark.catalog.listTables(database or None) if t.name.startswith(f"{name.lower()}__v"))
        live = spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
        at = max(i for i, n in enumerate(names) if n in live)
        old = [f"{database}.{n}" if database else n for n in names[:max(0, at + 1 - keep)]]
        for n in old:
            spark.sql(f"DROP TABLE {n}")
        return old
    path = path.rstrip("/")
    versions = [v for _, v in _commits(spark, path)]
    fs, root = _file_system(spark, f"{path}/versions")
    kept = set(versions[-keep:])
    # Names sort by time: what is newer than the current version may be a refresh that still runs.
    old = sorted(n for n in (s.getPath().getName() for s in fs.listStatus(root))
                 if versions and n not in kept and n < max(kept))
    for n in old:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, n), True)
    return old


class Counters:
    """Counts rows of frames while a query runs (``DataFrame.observe``), without a job of its own."""

    def __init__(self):
        self._seen: list = []

    def count(self, df: DataFrame, name: str, **conditions) -> DataFrame:
        """``df``, its rows counted as ``name``, and as ``name_<key>`` those for which the condition holds."""
        from pyspark.sql import Observation
        obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        self._seen.append(obs)
        return df.observe(obs, F.count(F.lit(1)).alias(name), *[F.count_if(c).alias(f"{name}_{k}") for k, c in conditions.items()])

    def get(self) -> dict[str, int]:
        """All counts; call it after the action that ran the frames."""
        out: dict[str, int] = {}
        for obs in self._seen:
            out.update(obs.get)
        return out
