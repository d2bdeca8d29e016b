"""Exact top-k search: BM25 over sharded inverted indexes with block-max WAND, merged with global statistics.

``build`` turns every scan task's documents into index shards of bounded size (one row each: documents,
lengths, terms, postings), written once. ``search`` takes queries in blocks of bounded size. For a block,
the document frequencies of its terms are summed over all shards; with these, the number of documents
and the mean length - the same for every shard - each shard finds its own top k by block-max WAND, and
the best k of all shards are the result. Scores do not depend on the sharding, so the merge is exact.
Of equal scores the smaller id comes first.

A shard's documents stand in an order of likeness (groups by their commonest words, then by length), so that a
range of ``RANGE`` documents holds like ones. A block is the postings of one list in one part of a range (``PARTS`` each),
and its maximum the best score among them. WAND's test - can the upper bounds of the lists that meet here add up to
more than the threshold? - is made for a part of a range at once, and for many queries at once: a shard's common lists, which
have most of the postings, are bounded by their block maxima, all other lists are added up at once. Only
in ranges above the threshold the common lists are added up too. A query without a threshold opens its best
ranges first and takes the k-th score found. This holds for queries of any number of terms.

The common lists stand as a matrix of single precision, so that the bounds and the sums of many queries are matrix
products; these scores only tell which documents may be among the best, with room for their error. The scores
of such documents are then added up in double, in the order of the query's terms, whatever the shard.

So that shards without good documents need not hand on ten of their own, one in ``FIRST`` shards is searched
first: the k-th best score there is a lower bound of the final one, and the threshold that all other
shards start with.

A term is a run of word characters in lower case, named by its 64-bit XXH64.

Defined results: rows without an id are not indexed and no query; a NULL or empty text, and a query none
of whose terms occurs, gives no result; rows of one query id form one query; repeated documents are
ranked one by one; empty tables give an empty table; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_chars, materialize

K1, B = 1.2, 0.75
TOP, QUERY_TERMS = 10, None   # all terms of a query's text
RANGE = 128                   # documents under one block maximum
OPEN = 4                      # ranges opened first
PARTS = 8                     # parts of a range, with block maxima of their own
COMMON = 1 / 16               # lists in more than this part of a shard's documents are common,
COMMON_LISTS, COMMON_CELLS = 4096, 1 << 24  # the longest of them, so many lists and scores at most
SLACK = 1e-3                  # bounds the error of single precision, COMMON_LISTS * 2**-24 and little more
BATCH_CELLS, SOME = 1 << 21, 8  # queries times documents searched at a time; queries whose other lists are read at a time
GROUPS, LIKE_WORDS, LIKE_ROUNDS = 8, 256, 4  # groups of like documents in a shard, by so many words, found in so many rounds
FIRST = 8                     # one in so many shards is searched first, for a threshold
SHARD_TOKENS, SHARD_DOCS = 4_000_000, 1 << 16
CHARS = 1_000_000
QUERY_BLOCK = 50_000          # queries whose terms are sent to the tasks at a time
QUERY_ROWS = 1_000_000        # and terms of these queries at a time, about
TERM_BLOCK = 1_000_000        # terms whose frequencies are counted at a time
WORD = re.compile(r"\w+")
SHARD = "docs binary, lengths binary, terms binary, ends binary, posts binary, counts binary"


class _Words(defaultdict):
    """Numbers of words, in the order of their first use."""

    def __init__(self):
        super().__init__(count().__next__)

    @property
    def hashes(self) -> list[int]:
        return [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in self]


def _by_likeness(number: np.ndarray, doc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """An order of the documents that puts like ones together: by the nearest of ``GROUPS`` means of their commonest words,
    then by length. ``number``, ``doc``: word and document of every token."""
    n, uses = len(length), np.bincount(number)
    top = np.argsort(-uses, kind="stable")[:LIKE_WORDS]
    column = np.full(len(uses), -1)
    column[top] = np.arange(len(top))
    column = column[number]
    has = np.zeros((n, len(top)), np.float32)
    has[doc[column >= 0], column[column >= 0]] = 1
    has /= np.sqrt(np.maximum(1, has.sum(1, keepdims=True)))
    mean = has[np.linspace(0, n - 1, min(n, GROUPS)).astype(np.int64)]
    for _ in range(LIKE_ROUNDS):
        group = np.argmax(has @ mean.T, 1)
        mean = (group == np.arange(len(mean))[:, None]).astype(np.float32) @ has
        mean /= np.maximum(1e-9, np.sqrt((mean * mean).sum(1, keepdims=True)))
    return np.lexsort((length, group))


def _shard(doc_ids: list[int], lengths: list[int], number: np.ndarray, words: _Words) -> pa.RecordBatch:
    """One index row: documents by likeness, terms by hash, each term's postings by document."""
    doc_id, length = np.array(doc_ids, np.int64), np.array(lengths, np.int64)
    by_id = np.argsort(doc_id, kind="stable")
    place = np.empty(len(doc_id), np.int64)
    place[by_id] = np.arange(len(doc_id))
    doc = np.repeat(place, length)
    if len(number):
        like = _by_likeness(number, doc, length[by_id])
        place[by_id[like]] = np.arange(len(doc_id))
        by_id, doc = by_id[like], np.repeat(place, length)
    terms, term = np.unique(np.array(words.hashes, np.uint64), return_inverse=True)
    key = term[number] << 16 | doc
    key, tf = np.unique(key, return_counts=True)
    ends = np.searchsorted(key, np.arange(1, len(terms) + 1) << 16)
    values = (doc_id[by_id], length[by_id].astype("<i4"), terms, ends.astype("<i4"),
              (key & 0xFFFF).astype("<u2"), tf.astype("<u4"))
    return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in values],
                                      [c.split()[0] for c in SHARD.split(", ")])


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index: one row per shard, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ids, lengths, numbers, size = _Words(), [], [], [], 0
        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for i, j in by_chars(texts, CHARS):
                for s in range(i, j, 1000):
                    e = min(j, s + 1000)
                    split = [WORD.findall(t.lower()) for t in texts[s:e]]
                    n = [len(x) for x in split]
                    if ids and (size + sum(n) > SHARD_TOKENS or len(ids) + e - s > SHARD_DOCS):
                        yield _shard(ids, lengths, np.concatenate(numbers), words)
                        words, ids, lengths, numbers, size = _Words(), [], [], [], 0
                    ids += doc_ids[s:e]
                    lengths += n
                    numbers.append(np.fromiter(map(words.__getitem__, chain.from_iterable(split)), np.int64, sum(n)))
                    size += sum(n)
        if ids:
            yield _shard(ids, lengths, np.concatenate(numbers), words)

    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(run, SHARD), "bm25-index")


def _terms(queries: DataFrame) -> DataFrame:
    """(query_id, term, tf) of the queries' texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for q, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = _Words()
                number = [words[w] for w in WORD.findall((t or "").lower())]
                n = np.bincount(number, minlength=len(words)) if number else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q] * len(words), pa.int64()), pa.array(np.array(words.hashes, np.uint64).view(np.int64)), pa.array(n)],
                    ["query_id", "term", "tf"])

    return queries.mapInArrow(run, "query_id long, term long, tf long").groupBy("query_id", "term").agg(F.sum("tf").alias("tf"))


def _column(rows: DataFrame, name: str) -> np.ndarray:
    return rows.select(name).toArrow()[name].to_numpy()


def frequencies(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df) of the distinct ``terms`` (a table): in how many documents of all shards each occurs."""
    blocks = max(1, -(-terms.count() // TERM_BLOCK))
    out = None
    for k in range(blocks):
        wanted = np.sort(_column(terms.filter(F.pmod("term", F.lit(blocks)) == k), "term").view(np.uint64))

        def run(batches: Iterator[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            df = np.zeros(len(wanted), np.int64)
            for b in batches:
                for t, e in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    term, ends = np.frombuffer(t, np.uint64), np.frombuffer(e, "<i4")
                    at = np.searchsorted(term, wanted)
                    hit = np.flatnonzero(term[np.minimum(at, len(term) - 1)] == wanted) if len(term) else []
                    df[hit] += np.diff(ends, prepend=0)[at[hit]]
            hit = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(wanted[hit].view(np.int64)), pa.array(df[hit])], ["term", "df"])

        part = index.select("terms", "ends").mapInArrow(run, "term long, df long")
        if blocks > 1:
            part = materialize(part, "bm25-frequencies")  # so the driver and the plan hold one block at a time
        out = part if out is None else out.unionByName(part)
    return out.groupBy("term").agg(F.sum("df").alias("df"))


def totals(index: DataFrame) -> tuple[int, int]:
    """Number of documents and of tokens, over all shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [np.frombuffer(x, "<i4") for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in n], pa.int64()), pa.array([int(x.sum()) for x in n], pa.int64())],
                                             ["docs", "tokens"])

    r = index.select("lengths").mapInArrow(run, "docs long, tokens long").agg(F.sum("docs"), F.sum("tokens")).first()
    return r[0] or 0, r[1] or 0


def _runs(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All places from start to end, run after run."""
    size = end - start
    upto = np.cumsum(size)
    return np.repeat(start - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Lists of values, one after the other, as byte strings."""
    offsets = np.r_[0, ends].astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _bytes(lists: pa.Array, kind: type) -> np.ndarray:
    """The values of all lists."""
    size = np.frombuffer(lists.buffers()[1], np.int64)[lists.offset + len(lists)] // np.dtype(kind).itemsize
    return np.frombuffer(lists.buffers()[2] or b"", kind, size)


class Shard:
    """One index row, with BM25 scores by the global statistics."""

    def __init__(self, row: dict, mean: float):
        self.docs = np.frombuffer(row["docs"], np.int64)
        self.terms, self.ends = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["ends"], "<i4")
        self.posts, self.counts = np.frombuffer(row["posts"], "<u2"), np.frombuffer(row["counts"], "<u4")
        self.norm = K1 * (1 - B + B * np.frombuffer(row["lengths"], "<i4") / max(mean, 1e-9))
        self.ranges = -(-len(self.docs) // RANGE)

    def matched(self, q: Queries) -> None:
        """The lists that the queries ask for, the scores of their postings, and the common lists as a matrix."""
        n, at = len(self.docs), np.minimum(np.searchsorted(self.terms, q.vocabulary), len(self.terms) - 1)
        there = self.terms[at] == q.vocabulary
        weight = np.zeros(len(self.terms))
        weight[at[there]] = q.idf[there]
        self.start, size = np.r_[0, self.ends[:-1]].astype(np.int64), np.diff(self.ends, prepend=0)
        self.score = np.repeat(weight * (K1 + 1), size)
        self.score *= self.counts
        self.score /= self.counts + self.norm[self.posts]
        # The lists as bytes, so that many are copied at once.
        self.post_bytes, self.score_bytes = _lists(self.posts, self.ends), _lists(self.score.astype(np.float32), self.ends)
        # Each query's lists here, in the order of their terms: the same in every shard.
        lists = np.where(there, at, -1).astype(np.int32)[q.word]
        hit = np.flatnonzero(lists >= 0)
        self.lists, cut = lists[hit], np.searchsorted(hit, np.r_[q.first, len(q.word)])
        self.query = np.flatnonzero(np.diff(cut))
        self.cut = np.r_[cut[self.query], len(hit)]
        # The common lists, the most common first: a row of scores each, range by range, and the best in every part of a range.
        common = np.flatnonzero((size > COMMON * n) & (weight > 0))
        common = common[np.argsort(-size[common], kind="stable")[:min(COMMON_LISTS, COMMON_CELLS // (self.ranges * RANGE))]]
        row = np.full(len(size), -1, np.int32)
        row[common] = np.arange(len(common))
        self.rows = np.zeros((self.ranges, len(common), RANGE), np.float32)
        place = _runs(self.start[common], self.ends[common])
        self.rows[self.posts[place] // RANGE, np.repeat(row[common], size[common]), self.posts[place] % RANGE] = self.score[place]
        self.part = np.arange(PARTS) * RANGE // PARTS
        self.top = np.maximum.reduceat(self.rows, self.part, 2).swapaxes(0, 1).reshape(len(common), self.ranges * PARTS)
        # The rows that each query asks for, and its other lists.
        row = row[self.lists]
        self.asked, self.asked_cut = row[row >= 0], np.searchsorted(np.flatnonzero(row >= 0), self.cut)
        self.other, self.other_cut = self.lists[row < 0], np.searchsorted(np.flatnonzero(row < 0), self.cut)

    def _blocks(self, i: int) -> np.ndarray:
        """The places of all postings of the i-th query here, list by list."""
        lists = self.lists[self.cut[i]:self.cut[i + 1]]
        return _runs(self.start[lists], self.ends[lists])

    def _score(self, place: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Scores of the documents, by id, from postings in ``some`` ranges (a mask); others have none."""
        place = place[some[self.posts[place] // RANGE]]
        # Adds in the order of the query's terms, whatever ranges are asked for.
        return np.bincount(self.posts[place], self.score[place], len(self.docs))[np.argsort(self.docs, kind="stable")]

    def _score_all(self, i: int) -> np.ndarray:
        return self._score(self._blocks(i), np.ones(self.ranges, bool))

    def _exact(self, query: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, documents, scores) of pairs in the queries' order: scores in double, added in the order of the query's terms."""
        wanted = np.zeros(len(self.docs), bool)
        wanted[doc] = True
        place = np.flatnonzero(wanted[self.posts])
        place = place[np.argsort(self.posts[place], kind="stable")]
        start = np.searchsorted(self.posts[place], np.arange(len(self.docs) + 1))
        lists, score = np.searchsorted(self.ends, place, "right"), self.score[place]
        asked = np.zeros(len(self.terms), bool)
        cut = np.flatnonzero(np.r_[True, query[1:] != query[:-1], True]).tolist()
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            own, docs = self.lists[self.cut[query[a]]:self.cut[query[a] + 1]], doc[a:b]
            asked[own] = True
            runs = [slice(x, y) for x, y in zip(start[docs].tolist(), start[docs + 1].tolist(), strict=True)]
            mine = np.flatnonzero(asked[np.concatenate([lists[x] for x in runs])])
            asked[own] = False
            number = np.searchsorted(np.cumsum(start[docs + 1] - start[docs]), mine, "right")
            yield int(query[a]), docs, np.bincount(number, np.concatenate([score[x] for x in runs])[mine], len(docs))

    def search(self, q: Queries, k: int, least: np.ndarray, opened: list | None = None) -> Iterator[tuple[int, float, int]]:
        """(query number, score, doc_id) of each query's top k here that score above its ``least``.

        ``opened``: gets the numbers of ranges opened and of all ranges, query by query.
        """
        step = max(1, BATCH_CELLS // max(1, self.ranges * RANGE, self.rows.shape[1]))
        found = [self._batch(range(i, min(i + step, len(self.query))), k, least, opened) for i in range(0, len(self.query), step)]
        if not any(len(x) for x, _ in found):
            return
        for i, docs, score in self._exact(*map(np.concatenate, zip(*found, strict=True))):
            docs, n = self.docs[docs], int(self.query[i])
            best = [x for x in np.lexsort((docs, -score))[:k].tolist() if score[x] > least[n]]
            yield from zip([n] * len(best), score[best].tolist(), docs[best].tolist(), strict=True)

    def _batch(self, queries: range, k: int, least: np.ndarray, opened: list | None) -> tuple[np.ndarray, np.ndarray]:
        """The queries and documents, in their order, that may be among the top k."""
        n = len(self.docs)
        score = np.zeros((len(queries), self.ranges * RANGE), np.float32)
        for i in range(queries.start, queries.stop, SOME):  # the lists without a row, in full
            cut = self.other_cut[i:min(i + SOME, queries.stop) + 1]
            lists = self.other[cut[0]:cut[-1]]
            upto = np.r_[0, np.cumsum(self.ends[lists] - self.start[lists])]
            doc = _bytes(self.post_bytes.take(pa.array(lists)), np.uint16)
            value = _bytes(self.score_bytes.take(pa.array(lists)), np.float32)
            cut = upto[cut - cut[0]].tolist()
            for j, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True), i - queries.start):
                score[j, :n] = np.bincount(doc[a:b], value[a:b], n)
        asks = np.zeros((len(queries), self.rows.shape[1]), np.float32)
        cut = self.asked_cut[queries.start:queries.stop + 1]
        asks[np.repeat(np.arange(len(queries)), np.diff(cut)), self.asked[cut[0]:cut[-1]]] = 1
        # The best that a document of a range can reach: of its parts, the other lists' best sum and the common lists' maxima.
        bound = np.maximum.reduceat(score.reshape(len(queries), self.ranges, RANGE), self.part, 2)
        bound = (bound + (asks @ self.top).reshape(bound.shape)).max(2) * (1 + SLACK)
        floor = least[self.query[queries.start:queries.stop]].copy()
        done = np.zeros(bound.shape, bool)

        def add(wanted: np.ndarray) -> None:
            wanted = wanted & ~done
            done[...] |= wanted
            for r in np.flatnonzero(wanted.any(0)).tolist():
                some = np.flatnonzero(wanted[:, r])
                score[some, r * RANGE:(r + 1) * RANGE] += asks[some] @ self.rows[r]

        def raised(some: np.ndarray) -> None:  # what is added so far is below the whole score
            if n > k and len(some):
                kth = np.partition(score[some, :n], n - k, 1)[:, n - k].astype(np.float64)
                floor[some] = np.maximum(floor[some], np.nextafter(kth * (1 - SLACK), 0.0))

        new = np.flatnonzero(floor <= 0)
        if len(new):  # no threshold yet: the best ranges first
            first = np.zeros(bound.shape, bool)
            first[new[:, None], np.argsort(-bound[new], 1, kind="stable")[:, :OPEN]] = True
            add(first & (bound > 0))
            raised(new)
        add(bound > floor[:, None])
        found = score > (floor * (1 - SLACK))[:, None]
        many = np.flatnonzero(found.sum(1) > 2 * k)
        raised(many)
        found[many] = score[many] > (floor[many] * (1 - SLACK))[:, None]
        if opened is not None:
            opened += [(x, self.ranges) for x in done.sum(1).tolist()]
        j, doc = np.divmod(np.flatnonzero(found), found.shape[1])
        return j + queries.start, doc


class Queries:
    """A block of queries as arrays: query i asks for the words from first[i] on, places in the vocabulary; its least score."""

    def __init__(self, rows: pa.Table, least: pa.Table | None):
        query, term, weight = (rows[c].to_numpy() for c in ("query_id", "term", "weight"))
        term = term.view(np.uint64)
        order = np.lexsort((term, query))
        self.vocabulary, at, word = np.unique(term, return_index=True, return_inverse=True)
        self.idf, self.word = weight[at], word[order].astype(np.int32)
        self.names, self.first = np.unique(query[order], return_index=True)
        self.least = np.zeros(len(self.names))
        if least is not None:
            at = np.searchsorted(self.names, least["query_id"].to_numpy())
            self.least[at] = np.nextafter(least["score"].to_numpy(), 0.0)  # equal scores may still enter


def _per_shard(index: DataFrame, q: Queries, mean: float, k: int) -> DataFrame:
    """(query_id, doc_id, score): each task's k best documents of every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int]]] = {}
        least = q.least.copy()  # rises with what the task's shards hold
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], mean)
                if not len(shard.terms):
                    continue
                shard.matched(q)
                new: dict[int, list[tuple[float, int]]] = {}
                for n, score, doc in shard.search(q, k, least):
                    new.setdefault(n, []).append((score, doc))
                for n, x in new.items():
                    x = best[n] = sorted(best.get(n, []) + x, key=lambda y: (-y[0], y[1]))[:k]
                    if len(x) == k:
                        least[n] = max(least[n], np.nextafter(x[-1][0], 0.0))
        rows = [(int(q.names[n]), d, s) for n, x in best.items() for s, d in x]
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                                         ["query_id", "doc_id", "score"])

    return index.mapInArrow(run, "query_id long, doc_id long, score double")


def _ranked(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return rows.withColumn("rank", F.row_number().over(w))


def search(index: DataFrame, queries: DataFrame, k: int = TOP, most_terms: int | None = None,
           id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """(query_id, rank, doc_id, score) of the k best documents of every query.

    ``most_terms``: ask for a text's terms of the highest tf * idf only, as "more like this" does; all of
    its terms otherwise.
    """
    asked = materialize(_terms(queries.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("query_id"), F.col(text_col).alias("text"))), "bm25-terms")
    n, tokens = totals(index)
    df = frequencies(index, materialize(asked.select("term").distinct(), "bm25-vocabulary"))
    weighted = asked.join(df, "term").withColumn(
        "weight", F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    if most_terms is not None:
        w = Window.partitionBy("query_id").orderBy(F.desc(F.col("tf") * F.col("weight")), "term")
        weighted = weighted.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= most_terms)
    weighted = materialize(weighted.select("query_id", "term", "weight", "df"), "bm25-queries")
    blocks = max(1, -(-weighted.select("query_id").distinct().count() // QUERY_BLOCK), -(-weighted.count() // QUERY_ROWS))
    mean = tokens / max(n, 1)
    is_first = F.pmod(F.xxhash64("docs"), F.lit(FIRST)) == 0
    out = None
    for b in range(blocks):
        # Bounded: about QUERY_ROWS terms, of at most about QUERY_BLOCK queries, at a time go to the tasks.
        rows = weighted.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).toArrow()
        # Each part is a table, so the driver and the plan hold one block at a time.
        first = materialize(_per_shard(index.filter(is_first), Queries(rows, None), mean, k), "bm25-first")
        least = _ranked(first).filter(F.col("rank") == k).select("query_id", "score").toArrow()
        rest = materialize(_per_shard(index.filter(~is_first), Queries(rows, least), mean, k), "bm25-rest")
        out = first.unionByName(rest) if out is None else out.unionByName(first).unionByName(rest)
    return _ranked(out).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def summary(docs: DataFrame) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 100, by all terms of its text."""
    queries = docs.filter("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return search(build(docs), queries, most_terms=QUERY_TERMS)
