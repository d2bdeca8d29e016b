"""The pipeline against the stages' brute-force versions, on a whole small table."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from cohortlens.llm import bpe, mixing, quality
from cohortlens.llm.common import table

from .test_mixing import brute
from .test_simhash import by_hand, union
from .test_spans import PII, base

SF = "/root/testdata/sf0.001"


def redacted(text):
    out, pos = "", 0
    for span in [s.split(":") for s in base(PII, text)[1].split(",") if s]:
        a, b = int(span[1]), int(span[2])
        if a >= pos:
            out += text[pos:a] + f"[{span[0].upper()}]"
        pos = max(pos, b)
    return out + text[pos:]


def test_run_equals_brute_force(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = docs.collect()
    quality_of = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    x = {r.doc_id: quality.features(r.text or "").astype(np.float64) for r in rows}
    p = np.array([x[i] for i, q in quality_of.items() if q == 1])
    u = np.array([v for i, v in x.items() if zlib.crc32(str(i).encode()) % 5])
    p, u = p[np.lexsort(p.T)], u[np.lexsort(u.T)]

    def fit():
        both = np.concatenate([p, u])
        order = np.lexsort(both.T)
        mine = np.r_[np.ones(len(p), bool), np.zeros(len(u), bool)][order]
        a, b = both[order][mine], both[order][~mine]
        first = quality.fit(a, b, min(0.95, max(0.05, np.mean(list(quality_of.values())))))
        prior = quality.share_of_positives(quality.predict(first, a), quality.predict(first, b))
        return quality.fit(a, b, min(0.99, max(0.05, prior)))
    model = fit()
    kept = [r for r in rows if quality.predict(model, x[r.doc_id][None])[0] >= quality.THRESHOLD]
    roots = union([r.doc_id for r in kept], [by_hand(r.text) for r in kept])
    kept = [r for r in kept if roots[r.doc_id] == r.doc_id]
    texts = {r.doc_id: redacted(r.text) for r in kept}
    chosen = Counter()
    for (doc_id, *_), n in brute([(r.doc_id, texts[r.doc_id], r.lang, r.source) for r in kept], mixing.Target()).items():
        chosen[doc_id] += n

    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in got) == chosen and len(chosen) < len(rows)
    s = bpe.Segmenter(bpe._model(None))
    for r in got:
        assert r.text == texts[r.doc_id] and r.n_chars == len(r.text)
        assert r.ids == s.encode([r.text], np.array([r.doc_id]))[0].tolist() and s.decode(r.ids) == r.text


def test_stages_keep_columns_and_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None, "a"), (2, "", "en", "src0", 0, "b"), (None, "one two three", "en", "src0", 13, None),
         (3, "one two three", "en", "src0", 13, "c"), (3, "one two three", "en", "src0", 13, "c"),
         (4, "w " * 50000, "en", "src1", 100000, "d")],
        "doc_id long, text string, lang string, source string, n_chars long, ids string")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[:6] == docs.columns, name
        out.collect()
        assert stage(spark, docs.limit(0), SF).collect() == []


@pytest.mark.parametrize("texts", [["a good text"], []])
def test_quality_without_positives(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0, 0)], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.summary(docs, labels).collect()] == [0.5] * len(texts)


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = quality.summary(table(spark, sf, "documents"), table(spark, sf, "labels")) \
        .join(table(spark, sf, "labels"), "doc_id").filter("held_out").collect()
    by = {q: [r.predicted for r in got if r.quality == q] for q in (0, 1)}
    assert np.mean(by[1]) > 0.98 and np.mean(by[0]) < 0.1
    assert all(0 <= r.score <= 1 for r in got)


def test_non_negative_risk_and_prior():
    r = np.random.default_rng(0)
    p = r.normal(2, 1, (800, 3))
    u = np.concatenate([r.normal(2, 1, (900, 3)), r.normal(-2, 1, (600, 3))])
    first = quality.fit(p, u, 0.7)
    prior = quality.share_of_positives(quality.predict(first, p), quality.predict(first, u))
    assert abs(prior - 0.6) < 0.05
    s = quality.predict(quality.fit(p, u, prior), u)
    assert (s[:900] >= 0.3).mean() > 0.95 and (s[900:] >= 0.3).mean() < 0.05


@pytest.mark.parametrize("prior", [0.3, 0.97])
def test_steps_follow_the_risks_numerical_gradient(monkeypatch, prior):
    """The first step of Adam goes by the sign of the gradient: that of the risk, written out and differenced."""
    monkeypatch.setattr(quality, "EPOCHS", 1)
    r = np.random.default_rng(2)
    pos, unl = r.normal(0.4, 1, (40, 5)), r.normal(0, 1, (60, 5))
    x = np.concatenate([pos, unl])
    mean, scale = x.mean(0), x.std(0) + 1e-3
    p, u, d = (pos - mean) / scale, (unl - mean) / scale, 5
    seeded = np.random.default_rng(quality.SEED)
    start = [seeded.normal(0, d ** -0.5, (d, quality.HIDDEN)), np.zeros(quality.HIDDEN),
             seeded.normal(0, quality.HIDDEN ** -0.5, quality.HIDDEN), np.zeros(1)]
    g = lambda z, w: np.tanh(z @ w[0] + w[1]) @ w[2] + w[3]
    loss = lambda v: np.log1p(np.exp(-v)).mean()
    negative = lambda w: loss(-g(u, w)) - prior * loss(-g(p, w))
    below = negative(start) < 0
    assert below == (prior == 0.97)

    def risk(w):  # below zero the negatives' part is pushed up alone
        decay = quality.DECAY / 2 * ((w[0] ** 2).sum() + (w[2] ** 2).sum())
        return (-negative(w) if below else prior * loss(g(p, w)) + negative(w)) + decay
    moved = quality.fit(pos, unl, prior)[2:]
    checked = 0
    for i, w in enumerate(start):
        for at in list(np.ndindex(w.shape))[:60]:
            there, back = [x.copy() for x in start], [x.copy() for x in start]
            there[i][at] += 1e-5
            back[i][at] -= 1e-5
            slope = (risk(there) - risk(back)) / 2e-5
            if abs(slope) > 1e-5:
                assert np.sign(start[i][at] - moved[i][at]) == np.sign(slope)
                checked += 1
    assert checked > 60


def test_odd_texts_have_features():
    for t in ("", " ", "\n", "a", "🙂" * 10, "x" * 200000, "\x00"):
        assert np.isfinite(quality.features(t)).all()


