"""Embedding near-duplicates against the cosine of all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from cohortlens.llm import pivots
from cohortlens.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, rep string"


def brute(rows, least=0.98):
    ok, unit = [], []
    for i, (vec_id, v, label) in enumerate(rows):
        if vec_id is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            ok.append(i)
            unit.append(x / np.linalg.norm(x))
    root, links = {r[0]: r[0] for r in rows}, [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(ok)):
        for b in range(a):
            i, j = ok[a], ok[b]
            if rows[i][2] == rows[j][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                root[y] = x
    return [(r[0], links[i], find(r[0]), None if r[0] is None else find(r[0]) == r[0]) for i, r in enumerate(rows)]


def rows():
    r = np.random.default_rng(4)
    out = []
    for label in (0, 1, 2):
        centres = r.normal(size=(20, 16))
        for c in centres:
            for noise in (0, 0, 0.03, 0.05, 0.08):
                out.append(((c + noise * r.normal(size=16)).astype(np.float32).tolist(), label))
    out += [(out[0][0], 1), ([0.0] * 16, 1), ([], 1), (None, 1), ([1.0, None], 1), ([float("nan"), 1.0], 1),
            ([float("inf"), 1.0], 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([1e-30, 2e-30], 1), ([1.0, 2.0], None)]
    order = r.permutation(len(out))
    return [(int(i) * 2, v, label) for i, (v, label) in zip(order, out, strict=True)] + [(None, [1.0, 2.0], 1)]


@pytest.mark.parametrize("block", [2048, 5])
def test_equals_all_pairs(spark, block):
    data = rows()
    df = spark.createDataFrame([(*r, "x") for r in data], SCHEMA)
    got = [tuple(r) for r in pivots.near_duplicates(df, block=block).collect()]
    assert sorted(got, key=str) == sorted(brute(data), key=str)


@pytest.mark.parametrize("shared", [1, 3])
def test_split_lists_lose_no_candidate(spark, shared):
    """Lists split by a second pivot (or dealt to blocks only, with ``shared`` 1) give the links of whole lists."""
    df = spark.createDataFrame([(*r, "x") for r in rows()], SCHEMA)
    whole, split = (sorted(map(tuple, pivots.near_duplicates(df, shared=shared, block=b).collect()), key=str)
                    for b in (100_000, 4))
    assert split == whole and sum(r[1] for r in whole) > 0


def test_crowded_lists_become_many_short_ones(spark, monkeypatch):
    monkeypatch.setattr(pivots, "MIN_PIVOTS", 512)
    r = np.random.default_rng(8)
    data = [(i, v.tolist(), 1, i, 1, 16) for i, v in enumerate(r.normal(size=(6000, 16)).astype(np.float32))]
    classes = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, rep long, n long, dim int")
    index = pivots.permutations(classes, pivots._pivots(classes)).cache()
    pairs, copies = [], []
    for block in (100_000, 30):
        sizes = [c["count"] for c in pivots.lists(index, block).groupBy(*pivots.LIST).count().collect()]
        pairs.append(sum(n * (n - 1) // 2 for n in sizes))
        copies.append(sum(sizes))
    assert pairs[1] < pairs[0] / 4
    assert copies[0] == 6000 * 8 and copies[1] <= 6000 * 28
    index.unpersist()


def test_recall_on_the_given_table(spark):
    data = [(r.vec_id, list(r.embedding), r.label) for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    r, size = np.random.default_rng(6), np.linalg.norm(data[0][1])
    for noise in (0.05, 0.1, 0.15, 0.2):  # cosines on both sides of the threshold
        data += [(len(data) + i, (np.array(v) + noise * size * r.normal(size=len(v)) / 8).tolist(), label)
                 for i, (_, v, label) in enumerate(data[:300])]
    df = spark.createDataFrame([(*r, "x") for r in data], SCHEMA)
    got = {r.vec_id: tuple(r) for r in pivots.near_duplicates(df).collect()}
    expected = brute(data)
    assert sum(got[e[0]][1] for e in expected) >= 0.99 * sum(e[1] for e in expected) > 0
    assert all(got[e[0]][1] <= e[1] for e in expected)  # no link below the threshold


def test_empty_table_and_repeated_rows(spark):
    assert pivots.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    twice = spark.createDataFrame([(4, [1.0, 0.0], 1, ""), (4, [1.0, 0.0], 1, ""), (9, [0.0, 1.0], 1, "")], SCHEMA)
    assert sorted(map(tuple, pivots.near_duplicates(twice).collect())) == [(4, 1, 4, True), (4, 1, 4, True), (9, 0, 9, True)]
