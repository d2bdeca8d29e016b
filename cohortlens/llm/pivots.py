"""Embedding near-duplicates through a pivot-permutation index.

Every vector is described by its ``NEAREST`` reference points (pivots), nearest first, and stands in the
inverted list of each of them. Two vectors of one label that share a list and at least ``SHARED`` pivots
are a candidate pair, verified by the cosine in double precision; the list of their smallest common
pivot does it, so a pair is verified once. Equal vectors are one class and are not paired.

Pivots are a bounded sample: one vector in ``PER_PIVOT``, ``MIN_PIVOTS`` to ``MAX_PIVOTS``, by hash of the id;
every vector is indexed. A list above ``BLOCK`` vectors is split by a second pivot: a candidate shares two
pivots at least, so each vector goes to the lists of this pivot and every later number of its own nearest
ones, and the two smallest common pivots name the list that verifies a pair. No candidate is lost, and the
lists are those of pairs of pivots, of which there are many more. What is still above ``BLOCK`` vectors (or
was asked with ``shared`` 1) is dealt to pairs of blocks. Of the links of a list, a task emits each vector's
number of links and a spanning forest, not the pairs.

Defined results: a vector that is NULL, empty, zero, or holds a NULL or non-finite component, or whose
label or id is NULL, links with nothing (no id: component NULL); vectors of different length do not
link; rows of equal id count one by one; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import components
from .simhash import forest

MIN_COSINE = 0.98
NEAREST, SHARED = 8, 2
PER_PIVOT, MIN_PIVOTS, MAX_PIVOTS, SEED = 64, 64, 4096, 31
BLOCK, SMALL = 2048, 100_000
LIST = ["label", "dim", "pivot", "second"]
ENTRY = "label int, dim int, rep long, n long, vec binary, nearest binary, near array<int>"


def _usable(vectors: DataFrame) -> DataFrame:
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad
                          & F.exists("embedding", lambda x: x != 0))


def _unit(x: np.ndarray) -> np.ndarray:
    """The rows as unit vectors in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """The pivots by dimension; at most MAX_PIVOTS vectors come to the driver."""
    most = min(MAX_PIVOTS, max(MIN_PIVOTS, classes.count() // PER_PIVOT))
    got = classes.orderBy(F.xxhash64("rep", F.lit(SEED)), "rep").limit(most).select("dim", "embedding").toArrow()
    out = {}
    for dim in sorted(set(got["dim"].to_pylist())):
        rows = got.filter(pa.compute.equal(got["dim"], dim))["embedding"].combine_chunks()
        out[dim] = _unit(rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
    return out


def permutations(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int = NEAREST) -> DataFrame:
    """One row per vector with its components as 32-bit floats and its nearest pivots, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = b.filter(pa.array(dims == dim))
                for i in range(0, rows.num_rows, 2000):
                    part = rows.slice(i, 2000)
                    raw = part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                    p = pivots.get(dim, np.zeros((1, dim)))  # no pivot of this length: one common list
                    k, near = min(nearest, len(p)), _unit(raw) @ p.T
                    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
                    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1)
                    top = top.astype("<i4")
                    vec = pa.array([v.tobytes() for v in raw.astype("<f4")], pa.binary())
                    perm = pa.array([t.tobytes() for t in top], pa.binary())
                    ends = pa.array(np.arange(len(raw) + 1, dtype=np.int32) * k)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("label"), part.column("dim"), part.column("rep"), part.column("n"), vec, perm,
                         pa.ListArray.from_arrays(ends, pa.array(top.ravel()))], [c.split()[0] for c in ENTRY.split(", ")])

    return classes.select("label", "dim", "embedding", "rep", "n").mapInArrow(run, ENTRY)


def _crowded(rows: DataFrame, keys: list[str], block: int) -> tuple[DataFrame, int]:
    """The lists of more than ``block`` rows with their number of blocks, and how many lists these are."""
    found = materialize(rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
                        .filter("blocks > 1"), "crowded")
    return found, found.count()  # at most one in ``block`` of the rows


def _marked(rows: DataFrame, crowd: DataFrame, n: int, keys: list[str]) -> DataFrame:
    return rows.join(F.broadcast(crowd) if n <= SMALL else crowd, keys, "left").fillna(1, ["blocks"])


def lists(index: DataFrame, block: int = BLOCK, shared: int = SHARED) -> DataFrame:
    """Postings: a row per vector and list; ``second`` is -1 in the list of one pivot."""
    single = index.withColumn("pivot", F.explode("near"))
    keys = LIST[:3]
    crowd, n = _crowded(single.select(*keys), keys, block)
    if n == 0 or shared < 2:
        return single.withColumn("second", F.lit(-1)).drop("near")
    later = F.when((F.col("blocks") == 1) | (F.size("near") < 2), F.array(F.lit(-1))) \
        .otherwise(F.filter("near", lambda q: q > F.col("pivot")))
    return _marked(single, crowd, n, keys).withColumn("second", F.explode(later)).drop("near", "blocks")


def _dealt(rows: DataFrame, block: int) -> DataFrame:
    """Postings with their own block and the block pair (i <= j) they are compared in; 0, 0 in short lists."""
    crowd, n = _crowded(rows.select(*LIST), LIST, block)
    if n == 0:
        return rows.withColumns({"own": F.lit(0), "i": F.lit(0), "j": F.lit(0)})
    rows = _marked(rows, crowd, n, LIST)
    rows = rows.withColumn("own", F.pmod(F.hash("rep"), F.col("blocks"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("blocks", "other")


def _pairs(g: pd.DataFrame, min_cosine: float, shared: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the linked pairs that this list (or pair of its blocks) has to verify."""
    x = _unit(np.frombuffer(b"".join(g.vec), "<f4").reshape(len(g), -1))
    perm = np.frombuffer(b"".join(g.nearest), "<i4").reshape(len(g), -1)
    own, here, second = g.own.to_numpy(), g["pivot"].iloc[0], g.second.iloc[0]
    names, local = np.unique(perm, return_inverse=True)
    member = np.zeros((len(g), len(names)), np.float32)
    member[np.arange(len(g))[:, None], local.reshape(perm.shape)] = 1
    # earlier common pivots: none in the list of one pivot, that pivot alone in the list of two
    before, common = (member[:, names < here], 0) if second < 0 else (member[:, names < second], 1)
    need = min(shared, perm.shape[1])
    cross = g.i.iloc[0] != g.j.iloc[0]
    for s in range(0, len(g), 1024):
        e = min(s + 1024, len(g))
        ok = (member[s:e] @ member.T >= need) & (before[s:e] @ before.T == common)
        ok &= (own[s:e, None] < own[None, :]) if cross else (np.arange(s, e)[:, None] < np.arange(len(g))[None, :])
        a, b = np.nonzero(ok)
        for k in range(0, len(a), 200_000):
            u, v = a[k:k + 200_000] + s, b[k:k + 200_000]
            linked = np.einsum("ij,ij->i", x[u], x[v]) >= min_cosine
            if linked.any():
                yield u[linked], v[linked]


def _verify(min_cosine: float, shared: int):
    def of_group(g: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rep, n = g.rep.to_numpy(), g.n.to_numpy()
        links = np.zeros(len(g), np.int64)
        for a, b in _pairs(g, min_cosine, shared):
            np.add.at(links, a, n[b])
            np.add.at(links, b, n[a])
            node, root = forest(rep[a], rep[b])
            yield pd.DataFrame({"a": node, "b": root, "links": 0})
        hit = np.flatnonzero(links)
        if len(hit):
            yield pd.DataFrame({"a": rep[hit], "b": rep[hit], "links": links[hit]})

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # the last group of a batch may go on in the next one
        keys = [*LIST, "i", "j"]
        for p in parts:
            p = p if rest is None else pd.concat([rest, p], ignore_index=True)
            new = (p[keys].to_numpy()[1:] != p[keys].to_numpy()[:-1]).any(1)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if e - s > 1:
                    yield from of_group(p.iloc[s:e])
            rest = p.iloc[cuts[-1]:]
        if rest is not None and len(rest) > 1:
            yield from of_group(rest)
    return run


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, nearest: int = NEAREST, shared: int = SHARED,
                    block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"),
                          F.col("label").cast("int").alias("label"))
    classes = materialize(_usable(rows).groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")).withColumn("dim", F.size("embedding")), "classes")
    index = materialize(permutations(classes, _pivots(classes), nearest), "permutations")
    keys = [*LIST, "i", "j"]
    dealt = _dealt(lists(index, block, shared), block).repartition(*keys).sortWithinPartitions(*keys)
    found = materialize(dealt.mapInPandas(_verify(min_cosine, shared), "a long, b long, links long"), "links")
    roots = components(found, "a", "b")
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    of = classes.join(links, classes.rep == links.a, "left").join(roots, classes.rep == roots.node, "left").select(
        F.col("label").alias("c_label"), F.col("embedding").alias("c_embedding"),
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    out = rows.join(of, (rows.label == of.c_label) & (rows.embedding == of.c_embedding) & rows.vec_id.isNotNull(), "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"))
