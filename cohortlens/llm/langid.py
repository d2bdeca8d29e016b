"""Language identification by multilingual mixture inference.

Every language is a distribution over letter trigrams (lower case, a trigram per letter, hashed to
``BUCKETS``). A document's trigrams are taken as drawn from a mixture of languages, whose proportions
expectation-maximisation estimates; the set of languages is the one of the highest likelihood minus
``PENALTY`` log(n) for every language beyond the first, n being the document's letters. Sets are tried in
the order of the proportions over all languages, as long as the penalised likelihood rises.

Where a set of several cannot win, no iteration is run: by Jensen's inequality the likelihood of any
mixture exceeds that of the best single language b by at most n log max_j mean(P_j / P_b).

Fitting uses a bounded sample: about ``PER_LANG`` documents of each language, by hash of the id (all, of a
language with fewer). Every row is predicted from its whole text. A model of more than ``MAX_LANGS`` languages
(64 MB for each of its two matrices) is refused with an error: such a ``lang`` column needs cleaning first.

Defined results: ``und`` with score 0 for a NULL or empty text, one without a letter, or where nothing
could be learnt; of equal likelihoods the first language by name; repeated rows get equal results; an
empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_chars, crc32_mod

BUCKETS = 1 << 15
PER_LANG, SEED, MAX_LANGS = 4000, 23, 256
SMOOTH, PENALTY = 0.1, 4.0
STEPS, TOLERANCE = 60, 1e-4
CHARS = 500_000      # characters handled at a time
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 of all else."""
    t = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            t[i] = ord(c.lower()[0])
    return t


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of every letter of the texts, with its neighbours."""
    sizes = np.array([len(t) + 1 for t in texts])
    codes = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    x = _letters()[codes].astype(np.uint64)
    at = np.flatnonzero(x[1:-1]) + 1
    h = (x[at - 1] * np.uint64(0x9E3779B97F4A7C15)) ^ (x[at] * np.uint64(0xC2B2AE3D27D4EB4F)) \
        ^ (x[at + 1] * np.uint64(0x165667B19E3779F9))
    h ^= h >> np.uint64(29)
    bucket = ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)).astype(np.int64)
    return bucket, np.searchsorted(np.cumsum(sizes), at - 1, "right")


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        self.p = (counts + SMOOTH) / (counts.sum(1, keepdims=True) + SMOOTH * BUCKETS)
        self.log = np.log(self.p)

    def _mixture(self, n: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, float]:
        """EM: proportions of the languages in the columns of ``p``, and the log-likelihood."""
        pi = np.full(p.shape[1], 1 / p.shape[1])
        for _ in range(STEPS):
            part = p * pi
            new = (n / part.sum(1)) @ part / n.sum()
            done = np.abs(new - pi).max() < TOLERANCE
            pi = new
            if done:
                break
        return pi, float(n @ np.log(p @ pi))

    def _languages(self, grams: np.ndarray, best: int) -> tuple[list[int], np.ndarray]:
        """The chosen set, most frequent first, with proportions."""
        bucket, n = np.unique(grams, return_counts=True)
        p, price = self.p[:, bucket].T, PENALTY * np.log(len(grams))
        order = np.argsort(-self._mixture(n, p)[0], kind="stable").tolist()
        chosen, share, top = [best], np.ones(1), float(n @ np.log(p[:, best]))
        for k in range(2, len(order) + 1):
            pi, ll = self._mixture(n, p[:, order[:k]])
            if ll - price * (k - 1) <= top:
                break
            by = np.argsort(-pi, kind="stable")
            chosen, share, top = [order[i] for i in by], pi[by], ll - price * (k - 1)
        return chosen, share

    def predict(self, texts: list[str]) -> list[tuple[str, float, str]]:
        """(language, score, all chosen languages with their shares) of each text."""
        out = [(UNKNOWN, 0.0, "")] * len(texts)
        if not self.langs or not texts:
            return out
        bucket, text = trigrams(texts)
        if not len(bucket):
            return out
        first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        number, n = text[first], np.diff(np.r_[first, len(text)])
        like = np.stack([np.add.reduceat(row[bucket], first) for row in self.log])
        best = like.argmax(0)
        under = self.p.ravel()[np.repeat(best * BUCKETS, n) + bucket]
        ratio = np.stack([np.add.reduceat(row[bucket] / under, first) for row in self.p]) / n
        ratio[best, np.arange(len(n))] = 1.0
        gain = n * np.log(ratio.max(0))
        certain = 1 / np.exp(like - like.max(0)).sum(0)
        for i, (t, b) in enumerate(zip(number.tolist(), best.tolist(), strict=True)):
            name = self.langs[b]
            out[t] = (name, float(certain[i]), f"{name}:1.000")
            if gain[i] > PENALTY * np.log(n[i]):
                chosen, share = self._languages(bucket[first[i]:first[i] + n[i]], b)
                if len(chosen) > 1:
                    out[t] = (self.langs[chosen[0]], float(min(1.0, share[0])), ",".join(
                        f"{self.langs[j]}:{s:.3f}" for j, s in zip(chosen, share.tolist(), strict=True)))
        return out


def train(docs: DataFrame, learn_from: Column) -> Model:
    """Trigram counts by language over the sampled rows where ``learn_from`` holds.

    The driver gets one number per language and, at most, one per language and bucket.
    """
    known = docs.select("doc_id", "lang", "text").filter(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = {r[0]: r[1] for r in known.groupBy("lang").count().limit(MAX_LANGS + 1).collect()}
    if len(n) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} values of lang to learn")
    if not n:
        return Model([], np.zeros((0, BUCKETS)))
    share = F.create_map(*[F.lit(x) for lang, k in n.items() for x in (lang, min(1.0, PER_LANG / k))])
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(SEED)), F.lit(1_000_000)) / 1e6
    sample = known.filter(place < F.element_at(share, F.col("lang"))).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in by_chars(texts, CHARS):
                bucket, text = trigrams(texts[i:j])
                of = np.array(langs[i:j], object)[text]
                for lang in set(langs[i:j]):
                    c = np.bincount(bucket[of == lang], minlength=BUCKETS)
                    counts[lang] = counts[lang] + c if lang in counts else c
        for lang, c in counts.items():
            hit = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(hit), pa.string()), pa.array(hit.astype(np.int32)),
                                              pa.array(c[hit].astype(np.int64))], ["lang", "bucket", "n"])

    sums = sample.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(n)
    counts = np.zeros((len(langs), BUCKETS))
    at = {lang: i for i, lang in enumerate(langs)}
    counts[[at[x] for x in sums["lang"].to_pylist()], sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return Model(langs, counts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, langs), one row per row of ``docs``, from the text only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            got = [x for i, j in by_chars(texts, CHARS) for x in model.predict(texts[i:j])]
            lang, score, langs = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(langs, pa.string())],
                ["doc_id", "lang_pred", "score", "langs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, langs string")


def summary(docs: DataFrame) -> DataFrame:
    held_out = F.coalesce(crc32_mod("doc_id", 4) == 2, F.lit(False))
    model = train(docs, ~held_out & F.col("doc_id").isNotNull())
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "langs")
