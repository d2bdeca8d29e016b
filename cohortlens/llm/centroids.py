"""Centroid clustering with n-simplex projection.

Vectors become integers, so sums, means and distances are exact. Some vectors serve as pivots. The distances of a
vector to the n pivots, measured once and kept in the vector's table, place it as the apex of a simplex
over the pivots: n - 1 coordinates from a triangular system, and its height above their plane. For two
apexes, the Euclidean distance is a lower bound of the distance of the vectors, and with the second height
turned to the other side an upper bound. A round projects the centroids alike; of a vector, only centroids
whose lower bound does not exceed the least upper bound are compared, by exact integer distances.

Every round is one pass over the table of vectors; tasks hand on sums by centroid, which Spark adds up, and only
``k`` sums of vectors reach the driver.

Defined results: kept are the vectors with exactly ``DIMENSIONS`` components, none NULL, NaN, infinite or
beyond ``LARGEST``; others have no row in the result. Repeated rows are clustered one by one; a NULL id is kept
and comes last in the order of the first centroids; with fewer than ``k`` vectors there are as many clusters;
an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

DIMENSIONS, SCALE = 64, 1024
K, ROUNDS, SEED = 8, 10, 3
PIVOTS = 16            # vectors tried as pivots; those in the plane of earlier ones are passed over
LARGEST = 1 << 17      # components below it give squared distances of fewer than 63 bits
CHUNK = 20_000         # vectors compared at a time


def _is_kept(v: Column, dimensions: int) -> Column:
    def fine(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST)
    return F.coalesce((F.size(v) == dimensions) & F.forall(v, fine), F.lit(False))


def integers(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """(vec_id, x): the kept vectors as arrays of floor(scale * component)."""
    v = F.col(vector_col)
    return vectors.filter(_is_kept(v, dimensions)).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("x"))


def _matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype).reshape(len(column), width)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to the vector ``y``."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


class Simplex:
    """Pivots and the corners of their simplex."""

    def __init__(self, candidates: np.ndarray):
        self.pivots, self.corners = candidates[:1], np.zeros((1, 0))
        for c in candidates[1:]:
            apex = self.project(c[None])[0]
            if apex[-1] > 1e-6 * (1.0 + np.linalg.norm(apex)):
                self.corners = np.vstack([np.pad(self.corners, ((0, 0), (0, 1))), apex])
                self.pivots = np.vstack([self.pivots, c])

    def project(self, x: np.ndarray) -> np.ndarray:
        """Apex coordinates of the rows of ``x`` over the pivots; the last one is the height."""
        d = np.stack([squared(x, p) for p in self.pivots], 1).astype(np.float64)
        low = self.corners[1:]
        if not len(low):
            return np.sqrt(d)
        # |y - c|^2 = d for the corners c, the first of which is zero: c . y = (d_0 - d_c + |c|^2) / 2.
        right = (d[:, :1] - d[:, 1:] + (low ** 2).sum(1)) / 2
        y = np.linalg.solve(low, right.T).T
        height = np.sqrt(np.maximum(d[:, 0] - (y ** 2).sum(1), 0.0))
        return np.column_stack([y, height])


def nearest(x: np.ndarray, apex: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of each row (of equal ones the first), and how
    many exact distances that took."""
    of = simplex.project(centroids)
    lower = np.stack([((apex - c) ** 2).sum(1) for c in of], 1)
    upper = lower + 4 * apex[:, -1:] * of[:, -1]
    # Rounding: relative to the squares that the bounds were made of.
    slack = 1e-8 * (1.0 + (apex ** 2).sum(1) + (of ** 2).sum(1).max())
    near = lower <= (upper.min(1) + slack)[:, None]
    d = np.full(near.shape, np.iinfo(np.int64).max, np.int64)
    for c in range(len(centroids)):
        rows = np.flatnonzero(near[:, c])
        d[rows, c] = squared(x[rows], centroids[c])
    best = d.argmin(1)
    return best, d[np.arange(len(x)), best], int(near.sum())


def _batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in parts:
        for i in range(0, b.num_rows, CHUNK):
            yield b.slice(i, CHUNK)


def with_apex(kept: DataFrame, simplex: Simplex, dimensions: int) -> DataFrame:
    """The table of vectors with their apex coordinates: the distances to the pivots, measured once."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(parts):
            apex = simplex.project(_matrix(b.column(1), dimensions, np.int64))
            ends = pa.array(np.arange(len(apex) + 1, dtype=np.int32) * apex.shape[1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(apex.ravel()))], ["vec_id", "x", "apex"])

    return kept.mapInArrow(run, "vec_id long, x array<long>, apex array<double>")


def _assigned(b: pa.RecordBatch, centroids: np.ndarray, simplex: Simplex):
    x = _matrix(b.column(1), centroids.shape[1], np.int64)
    best, d, _ = nearest(x, _matrix(b.column(2), len(simplex.pivots), np.float64), centroids, simplex)
    return x, best, d


def means(table: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of their vectors; empty ones stay."""
    k, width = centroids.shape

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for b in _batches(parts):
            x, best, _ = _assigned(b, centroids, simplex)
            for c in range(k):
                own = best == c
                total[c] += x[own].sum(0)
                count[c] += own.sum()
        rows = [(c, int(count[c]), total[c].tolist()) for c in range(k) if count[c]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["cluster", "n", "total"])

    sums = table.mapInArrow(run, "cluster int, n long, total array<long>").groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)])
    out = centroids.copy()
    for r in sums.collect():  # at most k rows
        out[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    return out


def first_vectors(kept: DataFrame, n: int, seed: int, dimensions: int) -> np.ndarray:
    """The n vectors of the smallest sha256 of ``seed:vec_id`` (a NULL id last, then by the vector)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.orderBy(key.asc_nulls_last(), "x").limit(n).collect()
    return np.array([r.x for r in rows], np.int64).reshape(len(rows), dimensions)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, id_col: str = "vec_id",
            vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE,
            pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector, a table in the shared folder, and the centroids."""
    kept = materialize(integers(vectors, id_col, vector_col, dimensions, scale), "integers")
    first = first_vectors(kept, max(k, pivots), seed, dimensions)
    centroids = first[:k]
    if not len(centroids):
        return kept.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    simplex = Simplex(first[:pivots])
    table = materialize(with_apex(kept, simplex, dimensions), "apexes")
    for _ in range(rounds):
        centroids = means(table, centroids, simplex)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(parts):
            _, best, d = _assigned(b, centroids, simplex)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best.astype(np.int32)), pa.array(d)], ["vec_id", "cluster", "distance"])

    return materialize(table.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters"), centroids


def summary(vectors: DataFrame) -> DataFrame:
    """``cluster`` with the summed distances of each cluster and of all, and the centroid's digest."""
    rows, centroids = cluster(vectors)
    sums = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}

    def of_cluster(values: dict, kind: str) -> Column:
        out = F.lit(None).cast(kind)
        for c, v in values.items():
            out = F.when(F.col("cluster") == c, F.lit(v).cast(kind)).otherwise(out)
        return out

    digest = {c: ",".join(map(str, centroids[c].tolist())) for c in range(len(centroids))}
    return rows.select("vec_id", "cluster", "distance", of_cluster(sums, "long").alias("cluster_inertia"),
                       F.lit(sum(sums.values())).cast("long").alias("inertia"),
                       F.sha2(of_cluster(digest, "string").cast("binary"), 256).alias("centroid_sha256"))


def oracle() -> str:
    """DuckDB SQL of ``summary``: the rounds written out one after the other."""
    out = [f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
v AS MATERIALIZED (SELECT r, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM kept),
first AS (SELECT e, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c FROM kept),
c0 AS MATERIALIZED (SELECT c, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM first WHERE c < {K})"""]
    for n in range(ROUNDS + 1):
        out.append(f"""
a{n} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
  SELECT v.r, k.c, CAST(sum((v.x - k.x) * (v.x - k.x)) AS BIGINT) AS d FROM v JOIN c{n} k ON v.i = k.i GROUP BY v.r, k.c) GROUP BY r)""")
        if n < ROUNDS:
            out.append(f"""
m{n} AS (SELECT a.c, v.i, CAST(sum(v.x) AS BIGINT) AS s, count(*) AS n FROM a{n} a JOIN v USING (r) GROUP BY a.c, v.i),
c{n + 1} AS MATERIALIZED (SELECT k.c, CASE WHEN m.n IS NULL THEN k.x ELSE (m.s - (m.s % m.n + m.n) % m.n) // m.n END AS x, k.i
  FROM c{n} k LEFT JOIN m{n} m ON k.c = m.c AND k.i = m.i)""")
    a, c = f"a{ROUNDS}", f"c{ROUNDS}"
    out.append(f"""
digest AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM {c} GROUP BY c)""")
    return ",".join(out) + f"""
SELECT kept.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM {a} a JOIN kept USING (r) JOIN digest USING (c)"""


ORACLE = oracle()
