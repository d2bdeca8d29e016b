"""Language identification and token files."""

from __future__ import annotations

import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import langid, token_files
from cohortlens.llm.common import scratch_path, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return langid.train(table(spark, SF, "documents"), F.lit(True))


def test_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    got = langid.summary(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) == docs.filter("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2").count()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_mixture_of_two_languages(spark, model):
    by = {r.lang: r.text for r in table(spark, SF, "documents").filter("n_chars between 3000 and 6000").collect()}
    text = by["de"][:2000] + " " + by["fr"][:1000]
    (lang, score, langs), = model.predict([text])
    assert lang == "de" and 0.5 < score < 0.85 and [x.split(":")[0] for x in langs.split(",")] == ["de", "fr"]
    assert model.predict([by["de"]])[0][2] == "de:1.000"


def test_bound_never_hides_a_better_set(spark, model):
    rows = table(spark, SF, "documents").limit(150).collect()
    for r in rows:
        grams, _ = langid.trigrams([r.text])
        if len(grams):
            best = int(np.argmax([row[grams].sum() for row in model.log]))
            chosen, share = model._languages(grams, best)
            assert model.predict([r.text])[0][2] == ",".join(f"{model.langs[j]}:{s:.3f}" for j, s in zip(chosen, share))


def test_languages_equal_a_search_of_all_sets(spark, model):
    """Penalised likelihood of every set of languages, by an EM of its own that runs to convergence."""
    from itertools import combinations
    by = {}
    for r in table(spark, SF, "documents").filter("n_chars > 400").collect():
        by.setdefault(r.lang, []).append(r.text)
    langs, r = sorted(by), np.random.default_rng(8)
    assert langs == model.langs
    texts = [by[x][i] for x in langs for i in range(4)]
    for _ in range(40):
        parts = r.choice(langs, r.integers(2, 4), replace=False)
        texts.append(" ".join(by[x][r.integers(len(by[x]))][:r.integers(60, 2500)] for x in parts))
    several = 0
    for t in texts:
        grams, _ = langid.trigrams([t])
        bucket, n = np.unique(grams, return_counts=True)
        best = (-np.inf, ())
        for k in range(1, len(langs) + 1):
            for some in combinations(range(len(langs)), k):
                p, pi = model.p[list(some)][:, bucket].T, np.full(k, 1 / k)
                for _ in range(400):
                    pi = (n / (p @ pi)) @ (p * pi) / n.sum()
                score = n @ np.log(p @ pi) - (k - 1) * langid.PENALTY * np.log(len(grams))
                best = max(best, (score, tuple(langs[i] for i in np.array(some)[np.argsort(-pi, kind="stable")])))
        got = tuple(x.split(":")[0] for x in model.predict([t])[0][2].split(","))
        assert got == best[1], t[:80]
        several += len(got) > 1
    assert several > 20


def test_trigrams_of_a_batch_are_those_of_its_texts():
    texts = ["Ab c", "", "1 2", "é", "x" * 10, " Straße İ 日本 "]
    bucket, text = langid.trigrams(texts)
    for i, t in enumerate(texts):
        assert bucket[text == i].tolist() == langid.trigrams([t])[0].tolist()
        assert (text == i).sum() == sum(c.isalpha() for c in t)


def test_language_of_odd_rows(spark, model):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "123 !?", 5), (None, "the and of", 5), (5, "th " * 60000, 5)],
                                 "doc_id long, text string, lang_pred int")
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert [(got[i].lang_pred, got[i].score) for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[None].lang_pred == "en" and got[5].lang_pred == "en"
    empty = table(spark, SF, "documents").limit(0)
    assert langid.summary(empty).collect() == []
    alone = table(spark, SF, "documents").limit(3).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.summary(alone).collect()} == {"und"}


def test_too_many_languages_are_refused(spark):
    docs = spark.createDataFrame([(i, f"l{i}", "some text") for i in range(langid.MAX_LANGS + 1)], "doc_id long, lang string, text string")
    with pytest.raises(ValueError, match="values of lang"):
        langid.train(docs, F.lit(True))
    assert len(langid.train(docs.filter("doc_id > 0"), F.lit(True)).langs) == langid.MAX_LANGS


ODD = ["", None, "a", " a", "a ", "a  b", "a   b   c", "don't  we'll\n\n x", "\n a\tb \n", "é 日本 🙂 b", "1 22 333", "x" * 5000,
       "<|endoftext|> a <|endoftext|>", "a  b　c", "w " * 50000 + "w", "end\n", "a\x1c b", "it's 's 's", "a \n b"]


def by_library(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(token_files.tokenizer_path())
    t.encode_special_tokens = True
    return [[*t.encode(x or "", add_special_tokens=False).ids, 0] for x in texts]


def test_files_hold_the_librarys_ids(spark):
    texts = ODD + [r.text for r in table(spark, SF, "documents").limit(200).collect()]
    rows = [(i * 7 % 1009, t, 1) for i, t in enumerate(texts)] + [(None, "null id", 1), (3, "twice", 1), (3, "twice", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    path = scratch_path(spark, "test")
    token_files.write(docs, path)
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r.doc_id for r in got] == [r[0] for r in order]
    expected = by_library([r[1] for r in order])
    assert [r.ids for r in got] == expected
    assert [r.start for r in got] == np.r_[0, np.cumsum([len(x) for x in expected])][:-1].tolist()
    sums = sorted(token_files.checksums(spark, path).collect(), key=lambda r: r.start)
    assert [(r.n_tokens, r.ids_crc32) for r in sums] == [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in expected]
    uri = token_files._qualified(spark, path)
    index = token_files.read_index(uri)
    assert index["ids"] == sum(map(len, expected)) and index["documents"] == len(rows) and json.dumps(index)


def test_one_id_is_split_into_files_of_bounded_size(spark, monkeypatch):
    """Two thirds of the rows have no id or one id; files are cut by size, in the defined order."""
    monkeypatch.setattr(token_files, "FILE_BYTES", 2_000)
    rows = [([None, 5, i][i % 3], f"{i * 7919 % 1009} words of a text") for i in range(1200)] + [(5, None), (5, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = scratch_path(spark, "test")
    token_files.write(docs.repartition(3), path)
    files = token_files.read_index(token_files._qualified(spark, path))["files"]
    size = sum(len(t or "") for _, t in rows)
    assert len(files) > size / 2_000 * 0.6 and max(f["docs"] for f in files) < len(rows) / 4
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected = by_library([r[1] for r in order])
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r[0] for r in order] and [r.ids for r in got] == expected


def test_bounded_table_of_words(monkeypatch):
    with open(token_files.tokenizer_path(), encoding="utf-8") as f:
        e = token_files.Encoder(f.read())
    monkeypatch.setattr(token_files, "WORDS", 3)
    texts = [x or "" for x in ODD] * 2
    for t, ids in zip(texts, by_library(texts), strict=True):
        flat, size = e.encode([t])
        assert flat.tolist() == ids and size.tolist() == [len(ids)]


def test_pieces_are_cut_as_the_library_cuts(spark):
    with open(token_files.tokenizer_path(), encoding="utf-8") as f:
        e = token_files.Encoder(f.read())
    chars = "abZÀéÿ×÷ ,.!?\n'1²_-\u00a0日🙂\"s"
    r = np.random.default_rng(3)
    texts = ["".join(r.choice(list(chars), r.integers(0, 30))) for _ in range(4000)]
    flat, size = e.encode(texts)
    got = np.split(flat, np.cumsum(size)[:-1])
    for t, ids, expected in zip(texts, got, by_library(texts), strict=True):
        assert ids.tolist() == expected, repr(t)


def test_added_tokens_are_the_librarys(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(token_files.tokenizer_path())
    texts = [*ODD, "a <|endoftext|> b", "x<|endoftext|>", "<|endoftext", "plain text"]
    expected = [[*library.encode(x or "", add_special_tokens=False).ids, 0] for x in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = token_files.summary(docs).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in expected]
    assert [r.start for r in got] == np.r_[0, np.cumsum([len(x) for x in expected])][:-1].tolist()
    assert [64, 220, 50256, 275, 0] in expected


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.summary(empty).collect() == []


def test_store_names():
    for uri, expected in (("s3a://b/x/s3a://y", "s3://b/x/s3a://y"), ("s3n://b", "s3://b"), ("file:///tmp/s3a", "file:///tmp/s3a"), ("/x", "/x")):
        assert token_files._arrow_uri(uri) == expected
