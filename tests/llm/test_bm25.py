"""Block-max WAND search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from cohortlens.llm import bm25
from cohortlens.llm.common import table


def brute(docs, queries, k, most=None):
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    docs = [(i, Counter(words(t))) for i, t in docs if i is not None]
    mean = sum(sum(c.values()) for _, c in docs) / max(1, len(docs))
    df = Counter(w for _, c in docs for w in c)
    idf = {w: math.log(1 + (len(docs) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    signed = lambda w: np.uint64(xxhash.xxh64_intdigest(w.encode())).view(np.int64)
    out = {}
    for q in {i for i, _ in queries if i is not None}:
        tf = Counter(w for i, t in queries if i == q for w in words(t) if w in df)
        terms = sorted(tf, key=lambda w: (-(tf[w] * idf[w]), signed(w)))[:most]
        scored = [(sum(idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w in terms if w in c), i)
                  for i, c in docs if any(w in c for w in terms)]
        out[q] = sorted(scored, key=lambda x: (-round(x[0], 9), x[1]))[:k]
    return {q: x for q, x in out.items() if x}


def check(got, expected):
    by = {}
    for r in sorted(got, key=lambda r: r.rank):
        by.setdefault(r.query_id, []).append((r.score, r.doc_id))
    assert by.keys() == expected.keys()
    for q, x in expected.items():
        assert [d for _, d in by[q]] == [d for _, d in x] and np.allclose([s for s, _ in by[q]], [s for s, _ in x])


def corpus():
    r = random.Random(8)
    words = [f"w{int(r.paretovariate(0.6))}" for _ in range(3000)]
    docs = [(i, " ".join(r.choices(words, k=r.randint(0, 80)))) for i in range(600)]
    docs += [(700 + i, docs[3][1]) for i in range(90)] + [(None, "w1 w2"), (999, None), (998, ""), (997, "É É w1 " * 9000), (5, docs[5][1])]
    return docs


@pytest.mark.parametrize("tokens,block,query_block,term_block,most", [
    (4_000_000, 64, 50_000, 1_000_000, None), (900, 4, 7, 100, None), (900, 4, 7, 100, 6)])
def test_search_equals_scoring_all(spark, monkeypatch, tokens, block, query_block, term_block, most):
    monkeypatch.setattr(bm25, "QUERY_BLOCK", query_block)
    monkeypatch.setattr(bm25, "TERM_BLOCK", term_block)
    monkeypatch.setattr(bm25, "FIRST", 2)
    docs = corpus()
    queries = [(i, t) for i, t in docs[::20]] + [(2000, "nothing here"), (2001, ""), (None, "w1"), (2002, "é w1"), (20, "w9 w9")]
    index = bm25.build(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, terms int"))
    got = bm25.search(index, spark.createDataFrame(queries, "query_id long, text string"), 7, most).collect()
    check(got, brute(docs, queries, 7, most))


def one_shard(texts, queries):
    """A shard of ``texts`` and the questions of ``queries``, as the tasks see them."""
    words = bm25._Words()
    split = [t.split() for t in texts]
    number = np.array([words[w] for x in split for w in x], np.int64)
    row = bm25._shard(list(range(len(texts))), [len(x) for x in split], number, words).to_pylist()[0]
    df = Counter(w for x in split for w in set(x))
    signed = lambda w: int(np.uint64(xxhash.xxh64_intdigest(w.encode())).view(np.int64))
    rows = [(i, signed(w), math.log(1 + (len(texts) - df[w] + 0.5) / (df[w] + 0.5)), df[w])
            for i, q in enumerate(queries) for w in sorted(set(q.split())) if w in df]
    table_ = pa.table(dict(zip(("query_id", "term", "weight", "df"), map(list, zip(*rows, strict=True)), strict=True)))
    shard, q = bm25.Shard(row, float(np.mean([len(x) for x in split]))), bm25.Queries(table_, None)
    shard.matched(q)
    return shard, q


def all_scores(shard, i):
    return shard._score(shard._blocks(i), np.ones(shard.ranges, bool))


def test_small_ranges_equal_scoring_all(monkeypatch):
    monkeypatch.setattr(bm25, "RANGE", 3)
    monkeypatch.setattr(bm25, "OPEN", 1)
    for seed in range(60):
        r = random.Random(seed)
        texts = [" ".join(r.choices("abcdefgh", k=r.randint(1, 9))) for _ in range(r.randint(1, 70))]
        texts += texts[:r.randint(0, 20)]  # ties
        k = r.randint(1, 7)
        shard, q = one_shard(texts, [" ".join(r.choices("abcdefghxy", k=r.randint(1, 12))) + " a" for _ in range(5)])
        for least in (np.zeros(len(q.names)), None):
            if least is None:  # the threshold of the k-th score: equal ones still come
                least = np.array([np.nextafter(x[-1], 0.0) for x in expected_scores])
            got = {}
            for n, score, doc in shard.search(q, k, least):
                got.setdefault(n, []).append((-score, doc))
            expected_scores = []
            for i, n in enumerate(shard.query.tolist()):
                s = all_scores(shard, i)
                assert (s == shard._score_all(i)).all()
                top = sorted((-x, d) for d, x in enumerate(s.tolist()) if x > 0)[:k]
                expected_scores.append([-x for x, _ in top])
                assert sorted(got[n]) == top, seed


def test_long_queries_skip_ranges(monkeypatch):
    monkeypatch.setattr(bm25, "RANGE", 32)
    r = random.Random(4)
    topics = [[f"t{t}w{i}" for i in range(120)] for t in range(25)]
    common = [f"c{i}" for i in range(60)]
    texts = [" ".join(r.choices(topic, k=40) + r.choices(common, k=40)) for topic in topics for _ in range(64)]
    queries = [" ".join(topics[3] + common), " ".join(topics[20][:90] + common[:20]), " ".join(common)]
    shard, q = one_shard(texts, queries)
    opened = []
    got = {}
    for n, score, doc in shard.search(q, 10, q.least.copy(), opened):
        got.setdefault(n, []).append((-score, doc))
    for i, n in enumerate(shard.query.tolist()):
        assert sorted(got[n]) == sorted((-x, d) for d, x in enumerate(all_scores(shard, i).tolist()))[:10]
    assert opened[0][0] <= 0.3 * opened[0][1] and opened[1][0] <= 0.3 * opened[1][1]


def test_shards_are_bounded(spark, monkeypatch):
    docs = [(i, "a b c") for i in range(5000)]
    got = list(bm25.build(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert sum(len(r.docs) // 8 for r in got) == 5000 and all(len(r.docs) // 8 <= bm25.SHARD_DOCS for r in got)


def test_query_over_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    check(bm25.summary(table(spark, sf, "documents")).collect(),
          brute(docs, [d for d in docs if d[0] % 100 == 0], bm25.TOP, bm25.QUERY_TERMS))


def test_query_asks_for_all_terms(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    queries = [d for d in docs if d[0] % 100 == 0]
    assert any(len(set(re.findall(r"\w+", t.lower()))) > 32 for _, t in queries)
    check(bm25.summary(table(spark, "/root/testdata/sf0.01", "documents")).collect(), brute(docs, queries, bm25.TOP))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bm25.summary(empty).collect() == []
    index = bm25.build(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert bm25.search(index, empty.withColumnRenamed("doc_id", "query_id")).collect() == []


def mixed(n, seed=6):
    """Documents of four languages in turn, short and long: words of their own by rank, a few in common."""
    r = random.Random(seed)
    words = [[f"l{g}w{i}" for i in range(400)] for g in range(4)]
    weights = [1 / (i + 2) for i in range(400)]
    return [" ".join(r.choices(words[i % 4], weights, k=r.randint(20, 120)) + r.choices("abc", k=2)) for i in range(n)]


def test_ranges_hold_like_documents(monkeypatch):
    monkeypatch.setattr(bm25, "RANGE", 32)
    texts = mixed(2000)
    shard, q = one_shard(texts, [*texts[::50], texts[7] + " " + texts[9]])
    least = np.array([np.sort(all_scores(shard, i))[-10] for i in range(len(q.names))])
    opened = []
    got = {}
    for n, score, doc in shard.search(q, 10, np.nextafter(least, 0.0), opened):
        got.setdefault(n, []).append((-score, doc))
    for i, n in enumerate(shard.query.tolist()):
        assert sorted(got[n]) == sorted((-x, d) for d, x in enumerate(all_scores(shard, i).tolist()))[:10]
    assert sum(x for x, _ in opened) < 0.5 * sum(x for _, x in opened)


@pytest.mark.parametrize("common,lists,cells,batch,some,parts", [
    (0.01, 4096, 1 << 24, 1 << 20, 8, 8), (0.01, 5, 1 << 24, 400, 3, 5), (2, 4096, 1 << 24, 1 << 20, 1, 1), (0.1, 4096, 9000, 1, 2, 64)])
def test_common_lists_change_no_score(monkeypatch, common, lists, cells, batch, some, parts):
    for name, value in (("RANGE", 16), ("COMMON", common), ("COMMON_LISTS", lists), ("COMMON_CELLS", cells), ("BATCH_CELLS", batch),
                        ("SOME", some), ("PARTS", parts)):
        monkeypatch.setattr(bm25, name, value)
    texts = mixed(300) + mixed(40)  # copies: equal scores go by id
    shard, q = one_shard(texts, texts[::9])
    for least in (np.zeros(len(q.names)), np.array([np.nextafter(np.sort(all_scores(shard, i))[-4], 0.0) for i in range(len(q.names))])):
        got = {}
        for n, score, doc in shard.search(q, 4, least):
            got.setdefault(n, []).append((-score, doc))
        for i, n in enumerate(shard.query.tolist()):
            assert sorted(got[n]) == sorted((-x, d) for d, x in enumerate(all_scores(shard, i).tolist()) if x > 0)[:4]


def test_nothing_above_the_threshold():
    shard, q = one_shard(mixed(200), mixed(5))
    assert list(shard.search(q, 3, np.full(len(q.names), 1e9))) == []
