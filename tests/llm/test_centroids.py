"""Centroid clustering against plain exact rounds."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from cohortlens.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, x string"


def brute(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * c) for c in v]) for i, v, *_ in rows
            if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    cents = [x for _, x in sorted(kept, key=key)[:k]]

    def assign():
        out = []
        for _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        of = assign()
        for c in range(len(cents)):
            own = [x for (_, x), (b, _) in zip(kept, of, strict=True) if b == c]
            if own:
                cents[c] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    of = assign()
    total = sum(d for _, d in of)
    return sorted(((i, c, d, sum(e for b, e in of if b == c), total,
                    hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for (i, _), (c, d) in zip(kept, of, strict=True)), key=str)


def rows():
    r = np.random.default_rng(5)
    centres = r.normal(size=(6, 64))
    out = [(i, (centres[i % 6] + 0.3 * r.normal(size=64)).tolist()) for i in range(150)]
    grid = [(200 + i, [float(x) for x in r.integers(-1, 2, 64)]) for i in range(60)]  # many ties
    odd = [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [None] * 64), (305, [math.nan] * 64), (306, [math.inf] * 64),
           (None, [0.5] * 64), (7, out[7][1]), (7, out[7][1]), (8, out[9][1]), (307, [0.0] * 64), (308, [-1e-9] * 64), (309, [1e5] * 64)]
    return out + grid + odd


@pytest.mark.parametrize("data", [rows(), rows()[:3], [(i, [float(i % 2)] * 64) for i in range(40)]])
def test_equals_exact_rounds(spark, data):
    df = spark.createDataFrame([(i, v, 1, "y") for i, v in data], SCHEMA)
    assert sorted(map(tuple, centroids.summary(df).collect()), key=str) == brute(data)


def test_bounds_hold_and_spare_distances():
    r = np.random.default_rng(2)
    centres = r.integers(-900, 900, (8, 64))
    x = np.concatenate([c + r.integers(-120, 120, (300, 64)) for c in centres] + [centres])
    s = centroids.Simplex(np.concatenate([centres[:5], centres[:2], x[:6]]))  # two pivots twice: passed over
    assert len(s.pivots) == 11
    a, b = s.project(x), s.project(centres)
    for i, c in enumerate(centres):
        d = np.sqrt(centroids.squared(x, c))
        low = np.sqrt(((a - b[i]) ** 2).sum(1))
        high = np.sqrt(((a - b[i]) ** 2).sum(1) + 4 * a[:, -1] * b[i, -1])
        assert (low <= d + 1e-3).all() and (high >= d - 1e-3).all()
    best, d, n = centroids.nearest(x, a, centres, s)
    full = np.stack([centroids.squared(x, c) for c in centres], 1)
    assert (best == full.argmin(1)).all() and (d == full.min(1)).all()
    assert n < 0.3 * full.size  # most centroids are filtered


def test_empty_table_and_values_beyond_the_bound(spark):
    assert centroids.summary(spark.createDataFrame([], SCHEMA)).collect() == []
    huge = spark.createDataFrame([(1, [1e30] * 64, 1, ""), (2, [1.0] * 64, 1, "")], SCHEMA)
    assert [r.vec_id for r in centroids.summary(huge).collect()] == [2]
