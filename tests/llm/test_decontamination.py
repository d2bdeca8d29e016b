"""Positional-index decontamination against a scan of all windows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortlens.llm import decontamination as dc

DOCS, ITEMS = "doc_id long, text string, win array<long>, n_hit string", "item_id long, text string, row int"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def windows(text, size=10):
    w = words(text)
    m = min(size, len(w))
    return {tuple(w[i:i + m]) for i in range(len(w) - m + 1)} if w else set()


def brute(docs, items):
    of = {}
    for item, text in items:
        for win in windows(text):
            of.setdefault(win, set()).add(item)
    sizes = {len(w) for w in of}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                win = tuple(w[i:i + m])
                if win in of:
                    hit |= set(range(i, i + m))
                    found |= {str(x) for x in of[win] if x is not None}
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def corpus(seed=3):
    r = random.Random(seed)
    pool = ["the", "a", "É", "ß1", "日本", "x9", "Q", "word"] + [f"t{i}" for i in range(40)]
    text = lambda n: " ".join(r.choices(pool, r.choices([30, 1], k=len(pool)), k=n))
    items = [(i, text(r.choice([0, 1, 3, 9, 10, 11, 30]))) for i in range(25)]
    items += [(3, text(15)), (100, items[6][1]), (None, text(12)), (101, None), (102, "!!"), (103, "rareword"), (20, "the THE the")]
    docs = [(i, text(r.randint(0, 80))) for i in range(120)]
    for i in range(40):
        item = words(r.choice(items)[1])
        a = text(20).split() + item + text(10).split() + item[2:] + item[:11]
        docs.append((200 + i, ", ".join(a).upper() + "."))
    docs += [(None, docs[-1][1]), (None, "the"), (5, docs[130][1]), (5, docs[130][1]), (900, None), (901, ""), (902, " .;"),
             (903, "rareword," * 3000 + items[12][1]), (904, text(30).replace(" ", "\n\x00"))]
    return docs, items


@pytest.mark.parametrize("stretch,block", [(2048, 50_000), (16, 7)])
def test_equals_scanning_all_windows(spark, monkeypatch, stretch, block):
    docs, items = corpus()
    monkeypatch.setattr(dc, "STRETCH", stretch)
    if block < 100:
        matches = dc.matches
        monkeypatch.setattr(dc, "matches", lambda i, a, s, m: matches(i, a, s, m, block))
        items = items[:12] + items[-6:]  # a job for every block
    got = dc.summary(spark.createDataFrame([(*d, [1], "x") for d in docs], DOCS),
                     spark.createDataFrame([(*i, 1) for i in items], ITEMS)).collect()
    expected = brute(docs, items)
    assert sorted(map(tuple, got), key=str) == expected
    assert any(r[2] for r in expected) and not all(r[2] for r in expected)


def term(word):
    return int(np.uint64(xxhash.xxh64_intdigest(word.encode(), seed=42)).view(np.int64)) & ~dc.PLACE


def near(docs, items, size, slop):
    """Places where all words of a window stand within ``slop`` of their place beside its rarest word."""
    df = Counter(w for _, t in docs for w in words(t))  # postings
    out = set()
    for win in {w for _, t in items for w in windows(t, size)}:
        rare = min(range(len(win)), key=lambda k: (df[win[k]], term(win[k]), k))
        for n, (_, t) in enumerate(docs):
            w = words(t)
            for s in [i - rare for i, x in enumerate(w) if x == win[rare]]:
                if all(any(w[j] == x for j in range(max(0, s + k - slop), min(len(w), s + k + slop + 1))) for k, x in enumerate(win)):
                    out.add((n, win, s))
    return out


@pytest.mark.parametrize("stretch,slop", [(2048, 0), (2048, 2), (24, 2)])
def test_phrase_and_proximity_matches(spark, monkeypatch, stretch, slop):
    r = random.Random(1)
    monkeypatch.setattr(dc, "STRETCH", stretch)
    pool = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(r.choices(pool, k=8))) for i in range(4)]
    docs = []
    for i in range(30):
        text = r.choices(pool, k=40)
        part = r.choice(items)[1].split()
        if i % 3:
            j = r.randrange(len(part) - 1)
            part[j], part[j + 1] = part[j + 1], part[j]
        text[i:i] = part
        docs.append((i, " ".join(text)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    index, of, found = dc.search(frame, spark.createDataFrame(items, "item_id long, text string"), 5, slop)
    if stretch < 40:  # words are counted by stretch, so the rarest one may be another; exact places must be there
        exact = {(n, s) for n, _, s in near(docs, items, 5, 0)}
        assert exact <= {(r.row, r.start) for r in found.select("row", "start").collect()}
        return
    name = {term(w): w for w in pool}
    # the window's words, from the places where it stands
    wins = {r.win_id: None for r in of.collect()}
    expected = near(docs, items, 5, slop)
    got = {(r.row, r.start) for r in found.collect()}
    assert got == {(n, s) for n, _, s in expected} and len(wins) == len({w for _, t in items for w in windows(t, 5)})
    assert len(name) == len(pool) and got


def test_empty_tables_and_wide_windows(spark):
    docs, items = spark.createDataFrame([(1, "a b c", [1], "")], DOCS), spark.createDataFrame([(1, "a b c", 1)], ITEMS)
    assert dc.summary(docs.limit(0), items).collect() == []
    clean = dc.summary(docs, items.limit(0)).collect()
    assert [tuple(r)[:4] for r in clean] == [(1, 3, 0, 0)] and not clean[0].contaminated
    assert [tuple(r)[:4] for r in dc.summary(docs, items).collect()] == [(1, 3, 3, 1)]
    with pytest.raises(ValueError):
        dc.build(docs, margin=2000)
    index = dc.build(docs, margin=1)
    with pytest.raises(ValueError):
        dc.matches(index, spark.createDataFrame([(1, [4096, 8192])], "win_id long, win array<long>"), margin=1)


def test_plan_has_no_python_and_shuffles_no_postings(spark):
    docs, items = corpus()
    df = dc.summary(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    index = dc.build(spark.createDataFrame(docs, "doc_id long, text string"))
    assert "Exchange" not in index.filter(F.col("part") == 0)._jdf.queryExecution().executedPlan().toString()
