"""SimHash against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortlens.llm import simhash
from cohortlens.llm.components import components

SCHEMA = "doc_id long, text string, fp string"


def by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def union(ids, fps):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(ids[i]), find(ids[j])))
                root[b] = a
    return {i: find(i) for i in ids}


def texts():
    r = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    out = [None, "", " \t\r\n", "One", "one", "ÄB cd", "äb cd", "a b c", "A  B\x0bC"]
    for _ in range(12):
        t = [r.choice(words) for _ in range(r.randint(3, 300))]
        for _ in range(r.randint(1, 6)):
            out.append(" ".join(t))
            t = list(t)
            t[r.randrange(len(t))] = r.choice(words)
    return [*out, "x " * 60000 + "y", *out[:3]]


def test_summary_equals_brute_force(spark):
    t = texts()
    rows = spark.createDataFrame([(i * 3, x, "z") for i, x in enumerate(t)], SCHEMA)
    got = {r.doc_id: r for r in simhash.summary(rows).collect()}
    fps = [by_hand(x) for x in t]
    roots = union([i * 3 for i in range(len(t))], fps)
    for i, f in enumerate(fps):
        assert got[i * 3].fingerprint == f"{f:016x}" and got[i * 3].component_id == roots[i * 3]


@pytest.mark.parametrize("block", [20_000, 7])
def test_every_link_is_found(spark, block):
    r = np.random.default_rng(5)
    fp = r.integers(0, 2**63, 300, dtype=np.int64)
    for bits in (1, 2, 3, 4):
        x = fp[:40].copy()
        for _ in range(bits):
            x ^= np.int64(1) << r.integers(0, 63, 40)
        fp = np.r_[fp, x]
    fp = np.unique(np.r_[fp, -fp[:20], 0, 7, 1 << 40])
    df = spark.createDataFrame([(int(x), i) for i, x in enumerate(fp)], "fp long, rep long")
    roots = {r.node: r.root for r in components(simhash.link(df, block=block), "a", "b").collect()}
    assert {i: roots.get(i, i) for i in range(len(fp))} == union(list(range(len(fp))), [int(x) % 2**64 for x in fp])


def test_covering_radius_and_replicas():
    r = np.random.default_rng(1)
    fp = r.integers(0, 2**63, 2000, dtype=np.int64)
    row, half, anchor, at_home = simhash.anchors(fp)
    assert at_home.sum() == 2 * len(fp) and 5 < len(row) / len(fp) / 2 < 14
    assert len(set(simhash.home(np.arange(1 << 23, dtype=np.uint32)).tolist())) == 1 << 12
    assert len(set(simhash.home(np.arange(1 << 7, dtype=np.uint32) << np.uint32(23)).tolist())) == 1 << 4


def test_cells_of_a_crowded_anchor(spark):
    """Fingerprints of one half: every anchor they share is crowded, and the cells of the other half must find all links."""
    assert len(set(simhash.cell(np.arange(1 << 16, dtype=np.uint32)).tolist())) == 1 << 12
    r = np.random.default_rng(8)
    for side in (0, 32):
        low = r.integers(0, 2**31, 150, dtype=np.int64)
        for bits in (1, 2, 3, 4):
            x = low[:60].copy()
            for _ in range(bits):
                x ^= np.int64(1) << r.integers(0, 31, 60)
            low = np.r_[low, x]
        fp = np.unique((low << side) | (np.int64(5) << (0 if side else 32)))
        df = spark.createDataFrame([(int(x), i) for i, x in enumerate(fp)], "fp long, rep long")
        expected = union(list(range(len(fp))), [int(x) for x in fp])
        for block in (100, 3):
            roots = {x.node: x.root for x in components(simhash.link(df, block=block), "a", "b").collect()}
            assert {i: roots.get(i, i) for i in range(len(fp))} == expected


def test_cells_cut_the_comparisons():
    fp = np.random.default_rng(9).integers(0, 2**32, 20000, dtype=np.int64)
    p = pd.DataFrame({"half": np.int8(1), "anchor": 7, "fp": fp, "rep": fp, "home": np.arange(len(fp)) % 10 == 0})
    got = pd.concat(simhash._to_cells([p]))
    per_cell = got.groupby("cell").home.agg(["sum", "count"])
    # here half 1 is the same for all, and half 0, random, deals them: 2,000 x 20,000 pairs without cells
    assert (per_cell["sum"] * per_cell["count"]).sum() < 2000 * 20000 / 20 and len(got) < 5 * len(p)


def test_keep_one(spark):
    docs = spark.createDataFrame([(1, "a b c d", 1), (2, "A b  c d", 2), (3, "x y z", 3), (3, "x y z", 3), (None, "a b c d", 9),
                                  (None, None, 9)], "doc_id long, text string, component_id int")
    got = sorted((r.doc_id or 0, r.component_id) for r in simhash.keep_one(docs).collect())
    assert got == [(0, 9), (0, 9), (1, 1), (3, 3)]
    s = {(r.doc_id, r.component_id) for r in simhash.summary(docs).collect()}
    assert s == {(1, 1), (2, 1), (3, 3), (None, None)}


def test_keep_one_loses_no_text_of_a_repeated_id(spark):
    rows = [(1, "a b c d", "x"), (2, "a b c d", "x"), (5, "wholly unrelated words here", "p"), (5, "some other text it is", "q"),
            (5, "some other text it is", "a"), (5, None, "n"), (7, "wholly unrelated words here", "r")]
    expected = [(1, "a b c d", "x"), (5, None, "n"), (5, "some other text it is", "a"), (5, "wholly unrelated words here", "p")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, rank string")
        assert sorted(map(tuple, simhash.keep_one(docs).collect()), key=str) == sorted(expected, key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.summary(empty).collect() == [] and simhash.keep_one(empty).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1000, 1400)]
    star = [(5, 2000 + i) for i in range(500)]
    df = spark.createDataFrame(chain + star + [(7, 7), (9, 8)], "x long, y long").orderBy(F.rand(1))
    got = {r.node: r.root for r in components(df, "x", "y").collect()}
    assert got == {**{i: 1000 for i in range(1001, 1401)}, **{2000 + i: 5 for i in range(500)}, 9: 8}
