"""R-tree hard negatives against scoring all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, x string"


def brute(rows):
    kept = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * c) for c in v]))
    out = []
    for a, label, x in kept:
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), i, m) for i, m, y in kept if len(y) == len(x))
        for s, p, _ in [t for t in scored if t[2] == label and t[1] != a][:5]:
            inside = [t for t in scored if t[2] != label and 30 * -s <= 100 * -t[0] <= 90 * -s]
            out += [(a, p, n, i, -s, -t) for n, (t, i, _) in enumerate(inside[:10], 1)]
    return sorted(out)


def rows(seed=4, n=900, width=16):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, width)) * 0.4 + 0.15
    out = [(i, (centres[r.integers(12)] + 0.2 * r.normal(size=width)).tolist(), int(r.integers(4) ** 2)) for i in range(n)]
    out += [(2000 + i, [float(x) for x in r.integers(-1, 2, width)], int(r.integers(3))) for i in range(200)]  # ties
    out += [(3000, None, 1), (3100, [], 1), (3200, [1.0, None], 1), (3300, [math.nan] * width, 1), (3400, out[3][1], None), (None, out[4][1], 1),
            (3500, [1.0, 2.0], 1), (3501, [1.0, 1.0], 1), (3502, [1.0, 0.5], 2), (3600, [math.inf] * width, 2), (3700, [0.0] * width, 1)]
    out += [(100, out[100][1], out[100][2]), (5, out[5][1], out[5][2]), (5, out[5][1], out[5][2]), (205, out[6][1], 9)]  # repeated
    return out


@pytest.mark.parametrize("leaf,shard,block", [(64, 8192, 20_000), (4, 100, 3)])
def test_equals_all_pairs(spark, monkeypatch, leaf, shard, block):
    monkeypatch.setattr(hn, "LEAF", leaf)
    monkeypatch.setattr(hn, "FAN", 3)
    data = rows()
    df = spark.createDataFrame([(*r, "y") for r in data], SCHEMA)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hn.mine(hn.clean(df, label=moved), F.col("vec_id") % 100 == 0, block=block, shard=shard).collect()
    expected = brute(data)
    assert sorted(map(tuple, got)) == expected and len(expected) > 200


def test_queue_prunes_and_stays_exact():
    r = np.random.default_rng(1)
    centres = r.normal(size=(40, 3)) * 300
    x = np.concatenate([c + r.normal(size=(50, 3)) * 5 for c in centres]).astype(np.int64)
    ids, label = np.arange(len(x)) * 3, np.repeat(np.arange(2), len(x) // 2)
    tree = hn.Tree(dict(zip([c.split()[0] for c in hn.INDEX.split(", ")], hn._shard(ids, label, x), strict=True)))
    assert sorted(tree.ids.tolist()) == ids.tolist() and (np.diff(np.r_[tree.starts, len(x)]) <= hn.LEAF).all()
    anchors = np.arange(0, len(x), 100)
    low, high = np.full(len(anchors), 1000), np.full(len(anchors), 60_000)
    asked = hn.Asked(x[anchors], ids[anchors], label[anchors], np.arange(len(anchors)), low, high, False, 4)
    best, opened = [[] for _ in anchors], []
    hn.best_first(tree, asked, best, opened)
    for q, a in enumerate(anchors):
        score = x @ x[a]
        ok = np.flatnonzero((label != label[a]) & (score >= 1000) & (score <= 60_000))
        assert sorted(best[q], reverse=True) == sorted(((int(score[i]), -int(ids[i])) for i in ok), reverse=True)[:4]
    assert 0 < opened[0] < 0.4 * len(anchors) * len(tree.starts)


def test_large_values_are_scored_exactly(spark):
    r = np.random.default_rng(3)
    data = [(i, (r.uniform(-1, 1, 64) * 1.3e5).tolist(), i % 2) for i in range(0, 400, 4)]
    df = spark.createDataFrame([(*d, "") for d in data], SCHEMA)
    assert sorted(map(tuple, hn.summary(df).collect())) == brute(data)


def test_empty_tables(spark):
    assert hn.summary(spark.createDataFrame([], SCHEMA)).collect() == []
    assert hn.summary(spark.createDataFrame([(1, [1.0], 1, ""), (2, [1.0], 2, "")], SCHEMA)).collect() == []
    assert hn.summary(spark.createDataFrame([(100, [1.0], 1, ""), (2, [1.0], 2, "")], SCHEMA)).collect() == []
