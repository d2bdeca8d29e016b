"""Merge-dropout segmentation: against the library at rate 0, against its own definition otherwise."""

from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece
import xxhash

from cohortlens.llm import bpe

MODEL = bpe._model(None)
SP = sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def texts():
    r = random.Random(2)
    parts = ["the", "ing", " ", " ", "  ", "\n", "é", "ß", "日本", "🙂", "token", "AB", "3.14", "x" * 70, "lorem ipsum dolor", "\t", "\x00"]
    out = ["", " ", "   ", "a", " a", "Hello world", "a  b   c    d", "é" * 100, "ab" * 3000, " 　x"]
    return out + ["".join(r.choice(parts) for _ in range(r.randint(1, 80))) for _ in range(150)]


def test_rate_zero_is_the_librarys_encoding():
    s = bpe.Segmenter(MODEL, 0.0)
    got = s.encode(texts(), np.arange(len(texts())))
    for t, ids in zip(texts(), got, strict=True):
        assert ids.tolist() == SP.encode(t), t
        assert s.decode(ids.tolist()) == t


def by_definition(s, word, variant):
    """One word's agenda, looking for the best candidate anew at every step."""
    key = bpe._mix(xxhash.xxh64_intdigest(word.encode()) ^ bpe._mix(variant ^ s.seed))
    sym = [(i, s.char.get(c, -1 - i)) for i, c in enumerate(word)]
    while True:
        options = []
        for k in range(len(sym) - 1):
            (at, a), (_, b) = sym[k], sym[k + 1]
            hit = s.pairs.get(a << 32 | b) if a >= 0 and b >= 0 else None
            if hit and bpe._mix(bpe._mix(key ^ at) ^ (a << 32 | b)) >= s.limit:
                options.append((hit[0], k, hit[1]))
        if not options:
            break
        _, k, merged = min(options)
        sym[k:k + 2] = [(sym[k][0], merged)]
    return [y for at, x in sym for y in ([x] if x >= 0 else [s.byte[b] for b in word[at].encode()])]


@pytest.mark.parametrize("rate", [0.1, 0.5, 1.0])
def test_arrays_and_heap_follow_the_definition(rate):
    s = bpe.Segmenter(MODEL, rate, seed=5)
    words = sorted({w for t in texts() for w in bpe.WORD.findall(" " + t)}, key=len)[:400]
    words = [w for w in words if len(w) < 200]
    variant = np.arange(len(words)) % 4
    flat, n = s._segment(words, [xxhash.xxh64_intdigest(w.encode()) for w in words], variant)
    for w, v, ids in zip(words, variant.tolist(), np.split(flat, np.cumsum(n)[:-1]), strict=True):
        assert ids.tolist() == by_definition(s, w, v), w


def test_dropout_varies_and_decodes_losslessly():
    t = [*texts(), "▁literal▁ ▁", "internationalization " * 40]
    a, b = bpe.Segmenter(MODEL, 0.3, seed=1), bpe.Segmenter(MODEL, 0.3, seed=2)
    one, two = a.encode(t, np.arange(len(t))), b.encode(t, np.arange(len(t)))
    assert [a.decode(x.tolist()) for x in one] == t and [b.decode(x.tolist()) for x in two] == t
    assert sum(x.tolist() != y.tolist() for x, y in zip(one, two, strict=True)) > 100
    again = bpe.Segmenter(MODEL, 0.3, seed=1)
    alone = [again.encode([x], np.array([i]))[0].tolist() for i, x in enumerate(t)]
    assert alone == [x.tolist() for x in one]  # no matter what else is in the batch
    word = [tuple(x) for x in np.split(one[-1], np.flatnonzero([a.bytes[i].startswith(b" ") for i in one[-1]]))[1:]]
    assert len(set(word)) > 1  # occurrences of one word in one text differ


@pytest.mark.parametrize("rate", [0.1, 0.5])
def test_every_occurrence_draws_for_itself(rate):
    s = bpe.Segmenter(MODEL, rate, seed=3)
    t = " ".join(["the", "house", "internationalization", "été"] * 30)
    words = bpe.WORD.findall(" " + t)
    for doc_id, ids in enumerate(s.encode([t] * 8, np.arange(8))):
        draw = [bpe._mix(bpe._mix(doc_id ^ s.seed) ^ place) for place in range(len(words))]
        assert ids.tolist() == [x for w, d in zip(words, draw, strict=True) for x in by_definition(s, w, d)]


@pytest.mark.parametrize("word", ["the", "and", "house", "important"])
def test_share_of_varied_occurrences_is_the_librarys(word):
    n, plain = 20_000, SP.encode(word)
    s = bpe.Segmenter(MODEL, 0.1)
    got = [tuple(x.tolist()) for x in s.encode([word] * n, np.arange(n))]
    library = [tuple(SP.encode(word, enable_sampling=True, alpha=0.1, nbest_size=-1)) for _ in range(n)]
    share = [sum(list(x) != plain for x in xs) / n for xs in (got, library)]
    assert share[1] > 0.05 and abs(share[0] - share[1]) < 0.015
    assert len(set(got)) > 4 or len(set(library)) <= 4


def test_bounded_table(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 5)
    s, t = bpe.Segmenter(MODEL), bpe.Segmenter(MODEL)
    for i, x in enumerate(texts()):
        ids = s.encode([x], np.array([i]))[0].tolist()
        monkeypatch.setattr(bpe, "WORDS", 10**9)
        assert ids == t.encode([x], np.array([i]))[0].tolist()
        monkeypatch.setattr(bpe, "WORDS", 5)


def test_frames(spark):
    rows = [(i, t, "k") for i, t in enumerate(texts())] + [(7, None, "k"), (None, "one two", None), (1, "x " * 50000, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.summary(df).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got) and min(r.n_pieces for r in got) == 0
    enc = bpe.encode(df)
    assert enc.columns == ["doc_id", "text", "ids", "ids_"]
    back = bpe.decode(enc, "ids_").collect()
    assert len(back) == len(rows) and all(r.decoded == (r.text or "") and r.ids in ("k", None) for r in back)
    empty = spark.createDataFrame([], df.schema)
    assert bpe.summary(empty).collect() == [] and bpe.encode(empty).collect() == []
