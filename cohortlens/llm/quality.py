"""Quality classifier learnt from positive and unlabelled texts.

A small network scores shape features of the whole text. It minimises the non-negative unbiased risk
of positive-unlabelled learning with the logistic loss l:

    p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)])

where E+ runs over trusted positives, Eu over unlabelled web text, and p is the estimated share of
positives. No negative example enters the risk; labels give the positives and the estimate of p.

Bounded sample (fitting only): ``MAX_POSITIVE`` positives and ``MAX_UNLABELLED`` unlabelled texts, those
of the smallest hash of the id. Every row is scored.

Defined results: a NULL text counts as empty and is scored like one; without a trusted positive every
score is 0.5; an empty table gives an empty table; repeated rows get equal scores; further columns are
ignored by ``scores`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_POSITIVE, MAX_UNLABELLED = 10_000, 20_000
THRESHOLD, SEED = 0.3, 17
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 100, 2048, 1e-2, 1e-4
# Classes of characters for the bigram features, in order; all else is the last class.
CLASSES = ("lower", "upper", "digit", "space", "break", ".,;:'\"-()", "!?", "|/\\_[]{}", "#$%&*@^~+=<>`", "other")
N_SHAPE = 12


@cache
def _class_table() -> np.ndarray:
    t = np.full(1 << 16, len(CLASSES) - 1, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c.isupper():
            t[i] = 1
        elif c.isalpha():
            t[i] = 0
        elif c.isdigit():
            t[i] = 2
        elif c == " ":
            t[i] = 3
        elif c.isspace():
            t[i] = 4
    for k in range(5, len(CLASSES) - 1):
        for c in CLASSES[k]:
            t[ord(c)] = k
    return t


def features(text: str) -> np.ndarray:
    """Shape of a text: character-class bigrams, repetition of words and lines, lengths."""
    n = len(CLASSES)
    out = np.zeros(N_SHAPE + n * n, np.float32)
    words = text.split()
    if not words:
        return out
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _class_table()[np.minimum(code, (1 << 16) - 1)].astype(np.int32)
    pairs = np.bincount(kind[:-1] * n + kind[1:], minlength=n * n)
    out[N_SHAPE:] = np.sqrt(pairs / max(1, len(kind) - 1))
    w, count = len(words), Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    common = sorted(count.values(), reverse=True)[:3]
    longest = int(np.diff(np.flatnonzero(np.r_[True, code[1:] != code[:-1], True])).max())
    out[:N_SHAPE] = (
        1.0, np.log1p(len(text)), np.log1p(w), len(text) / w / 8,
        len(count) / w, len(count) / np.sqrt(w) / 10, sum(map(eq, words, words[1:])) / w, common[0] / w,
        sum(common) / w, 1 - len(set(lines)) / len(lines), np.log1p(w / len(lines)), min(1.0, longest / 50),
    )
    return out


def _stable(column: str) -> Column:
    return F.xxhash64(F.col(column), F.lit(SEED))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float):
    """Weights that minimise the non-negative risk, by Adam over mini-batches; fixed seed."""
    r = np.random.default_rng(SEED)
    x = np.concatenate([positive, unlabelled])
    mean, scale = x.mean(0), x.std(0) + 1e-3
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    d = x.shape[1]
    weights = [r.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), r.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    softplus = lambda z: np.logaddexp(0, z)
    batches = max(1, -(-len(u) // BATCH))
    for _ in range(EPOCHS):
        of_p, of_u = r.permutation(len(p)), r.permutation(len(u))
        for k in range(batches):
            bp, bu = p[of_p[k::batches]], u[of_u[k::batches]]
            if not len(bp):
                bp = p[of_p[:1]]
            b = np.concatenate([bp, bu])
            h = np.tanh(b @ weights[0] + weights[1])
            g = h @ weights[2] + weights[3]
            gp, gu, s = g[:len(bp)], g[len(bp):], sigmoid(g)
            negative = softplus(gu).mean() - prior * softplus(gp).mean()
            # l(g) = log(1 + e^-g), l(-g) = log(1 + e^g); derivatives by g are s - 1 and s.
            if negative >= 0:
                dg = np.concatenate([prior * (s[:len(bp)] - 1) / len(bp) - prior * s[:len(bp)] / len(bp),
                                     s[len(bp):] / len(bu)])
            else:  # the estimate of the negatives' risk went below zero: step back from over-fitting
                dg = np.concatenate([prior * s[:len(bp)] / len(bp), -s[len(bp):] / len(bu)])
            dh = np.outer(dg, weights[2]) * (1 - h * h)
            grads = [b.T @ dh + DECAY * weights[0], dh.sum(0), h.T @ dg + DECAY * weights[2], dg.sum(keepdims=True)]
            t += 1
            for i, grad in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                weights[i] = weights[i] - RATE * (first[i] / (1 - 0.9 ** t)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** t)) + 1e-8)
    return mean, scale, *weights


def predict(model, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    mean, scale, w1, b1, w2, b2 = model
    g = np.tanh((x - mean) / scale @ w1 + b1) @ w2 + b2
    return 1 / (1 + np.exp(-np.clip(g, -40, 40)))


def share_of_positives(of_positive: np.ndarray, of_unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from both groups' scores (best bin).

    Above a threshold that few negatives reach, the unlabelled hold p times the share that the
    positives hold. The threshold is the one with the smallest upper bound of that ratio.
    """
    cuts = np.quantile(of_positive, np.linspace(0, 0.9, 91))
    p = np.array([(of_positive >= c).mean() for c in cuts])
    u = np.array([(of_unlabelled >= c).mean() for c in cuts])
    slack = np.sqrt(0.5 * np.log(40) / len(of_positive)) + np.sqrt(0.5 * np.log(40) / len(of_unlabelled))
    return float((u / p)[np.argmin((u + slack) / p)])


def train(docs: DataFrame, labels: DataFrame, learn_from: Column):
    """A model from the labels of the rows where ``learn_from`` (over doc_id) holds; None without positives.

    A first fit takes the share of positives among those labels as prior; its scores give the estimate
    (``share_of_positives``) that the model is fitted with. Only ids are sorted for the samples, and at
    most MAX_POSITIVE + MAX_UNLABELLED of them are broadcast to the scan of the texts.
    """
    known = labels.select("doc_id", "quality").filter(learn_from & F.col("quality").isNotNull())
    n, n_positive = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("quality").cast("long")), F.lit(0))).first()
    if not n_positive:
        return None
    prior = min(0.95, max(0.05, n_positive / n))

    def some(ids: DataFrame, most: int, trusted: bool) -> DataFrame:
        return ids.select("doc_id").orderBy(_stable("doc_id"), "doc_id").limit(most).distinct() \
            .withColumn("trusted", F.lit(trusted))

    ids = some(known.filter("quality = 1"), MAX_POSITIVE, True).unionByName(
        some(docs.filter(learn_from), MAX_UNLABELLED, False))
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("trusted", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t or "").tolist() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float32()))], ["trusted", "x"])

    got = rows.mapInArrow(run, "trusted boolean, x array<float>").toArrow()
    if not got.num_rows:
        return None
    x = np.asarray(got["x"].combine_chunks().flatten(), np.float64).reshape(got.num_rows, -1)
    trusted = got["trusted"].to_numpy(zero_copy_only=False).astype(bool)
    order = np.lexsort(x.T)  # the same model whatever the order of the rows
    x, trusted = x[order], trusted[order]
    if not trusted.any() or trusted.all():
        return None
    first = fit(x[trusted], x[~trusted], prior)
    prior = share_of_positives(predict(first, x[trusted]), predict(first, x[~trusted]))
    return fit(x[trusted], x[~trusted], min(0.99, max(0.05, prior)))


def _scored(batch: pa.RecordBatch, text_at: int, model) -> np.ndarray:
    texts = batch.column(text_at).to_pylist()
    out = [predict(model, np.stack([features(t or "") for t in texts[i:i + 1000]])) for i in range(0, len(texts), 1000)]
    return np.concatenate(out) if out else np.zeros(0)


def scores(docs: DataFrame, model) -> DataFrame:
    """(doc_id, score), one row per row of ``docs``; the score sees the text only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_scored(b, 1, model))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_scored(b, at, model) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def summary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = train(docs, labels, ~held_out)
    return scores(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
