"""Mixing against the SQL definition and a brute-force tree."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

from cohortlens.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, tokens int, mix_leaf string"


def share(budget, nodes):
    """Shares by weight with capacities: fix the full ones, share the rest anew, until none overflows."""
    out, open_ = {}, dict(nodes)
    while open_:
        total = sum(w for _, w in open_.values())
        full = {k for k, (cap, w) in open_.items() if budget * w >= cap * total}
        if not full:
            return out | {k: int(budget * w / total) for k, (cap, w) in open_.items()}
        for k in full:
            out[k] = open_.pop(k)[0]
            budget -= out[k]
    return out


def brute(rows, t):
    name = lambda x: (x or "").strip(" ") or "unknown"
    docs = []
    for d, text, lang, source, *_ in rows:
        s = name(source)
        docs.append((d, (s[:-1] if s[-1].isdigit() else s, name(lang), s), len((text or "").split())))
    supply = Counter()
    for _, leaf, n in docs:
        supply[leaf] += n
    weight = lambda level, x: t.weights.get(mixing.LEVELS[level], {}).get(x, t.other)
    alloc = {(): int(sum(supply.values()) * t.share)}
    for level in range(3):
        caps = defaultdict(Counter)
        for leaf, n in supply.items():
            if all(weight(i, leaf[i]) > 0 for i in range(3)):
                caps[leaf[:level]][leaf[:level + 1]] += n * t.max_epochs
        alloc = {k: v for parent, kids in caps.items() for k, v in share(
            alloc[parent], {k: (c, weight(level, k[-1])) for k, c in kids.items()}).items()}
    out = Counter()
    for leaf, budget in alloc.items():
        mine = [(d, n) for d, at, n in docs if at == leaf]
        epoch = 0
        while budget > 0:
            key = lambda x: hashlib.md5(f"{t.seed}:{epoch}:{'' if x[0] is None else x[0]}".encode()).hexdigest()  # noqa: E731,B023
            whole = budget >= supply[leaf]
            left = budget
            for d, n in sorted(mine, key=lambda x: (key(x), x[1])):
                if whole or left > 0:
                    out[(d, leaf, epoch, n, n if whole else min(n, left))] += 1
                left -= n
            budget -= supply[leaf]
            epoch += 1
    return out


def rows():
    out = []
    for i in range(400):
        source = ["src0", "src0", "src1", "src12", "src13", "x", None, " "][i % 8]
        out.append((i, " ".join(["w"] * (i * 7 % 40)), ["en", "en", "de", "fr", None, ""][i % 6], source, i, "z"))
    return [*out, out[5], out[5], (None, "a b", "en", "src0", 1, "z"), (900, None, "en", "src1", 1, None),
            (901, "", "xx", "src1", 1, None), (902, "q " * 20000, "es", "src5", 1, None)]


@pytest.mark.parametrize("t", [
    mixing.Target(), mixing.Target(share=1.9), mixing.Target(share=2.5, max_epochs=3), mixing.Target(share=0.01),
    mixing.Target(weights={"domain": {"src": 0}, "lang": {"fr": 50}}, share=0.3, max_epochs=1),
])
def test_mix_equals_brute_force(spark, t):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = mixing.mix(df, t).collect()
    assert Counter((r.doc_id, (r.domain, r.lang, r.source), r.epoch, r.tokens, r.taken) for r in got) == brute(rows(), t)
    chosen = mixing.select(df, t)
    assert chosen.columns == df.columns
    times = Counter(r.doc_id for r in chosen.collect())
    expected = Counter(r.doc_id for r in got)
    assert set(times) == set(expected) and all(times[k] >= n for k, n in expected.items())
    assert all(times[k] == n for k, n in expected.items() if k != 5)  # equal rows at the edge come together


def test_equals_sql(spark, duck001):
    from cohortlens.llm.queries import ORACLE_SQL, QUERIES
    got = Counter(map(tuple, QUERIES["op8_mixing"](spark, "/root/testdata/sf0.001").collect()))
    assert got == Counter(duck001.execute(ORACLE_SQL["op8_mixing"]).fetchall())


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).collect() == [] and mixing.select(empty).collect() == []


@pytest.mark.parametrize("most,digits", [(1, 1), (3, 2), (2000, 1)])
def test_edge_is_closed_in_on(spark, monkeypatch, most, digits):
    """However small the buckets, and with ids that hashes cannot tell apart, the mix is that of sorting."""
    monkeypatch.setattr(mixing, "EDGE_ROWS", most)
    monkeypatch.setattr(mixing, "DIGITS", digits)
    data = rows() + [(None, "w " * (i % 7), "en", "src0", i, "z") for i in range(60)]
    got = mixing.mix(spark.createDataFrame(data, SCHEMA)).collect()
    assert Counter((r.doc_id, (r.domain, r.lang, r.source), r.epoch, r.tokens, r.taken) for r in got) == brute(data, mixing.Target())
