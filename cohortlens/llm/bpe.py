"""SentencePiece merge-type encoding with seeded merge-dropout, and its lossless decoding.

The pieces, scores and byte fallback come from a SentencePiece model file. Text is cut at spaces (a space,
written U+2581, only ever starts a piece), and every word is merged by its agenda: the adjacent pair of
the best score, leftmost first, again and again. A candidate merge is skipped for good if its keyed
hash is below the dropout rate; a new neighbour makes a new candidate. The hash is of the seed, the
occurrence (document, place in it and word), the place in the word and both pieces, so every occurrence
is cut by draws of its own, the same on every run and under any partitioning. With rate 0 the result is
the library's own encoding.

Words of a batch are merged together, one step of all agendas at a time, as arrays; words above
``LONG`` characters go through a heap. A bounded table keeps, for each word met twice, the merges of its agenda and
its ids where none of them is skipped, and the same again for the agenda that goes on after one of these
merges is skipped, up to ``DEPTH`` skips. An occurrence draws for the merges of its word's agenda; the
first that it skips leads to the next agenda. Beyond ``DEPTH`` skips an occurrence is merged on its own.

Defined results: a NULL or empty text has no ids and decodes to an empty text; characters outside the
vocabulary, and a literal U+2581, become byte pieces, so decoding always gives the text back;
repeated rows with equal ids get equal segmentations; a NULL id counts as 0; an empty table gives an
empty table; further columns are ignored by ``summary`` and kept by ``encode``.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_chars, fresh

SPACE = "▁"
WORD = re.compile(f" +[^ {SPACE}]*|[^ {SPACE}]+|{SPACE}")
RATE, SEED = 0.1, 11
DEPTH = 3            # skipped merges of a word up to which its agendas are kept
LONG = 64            # characters of a word up to which it is merged with others as arrays
WORDS = 350_000      # words whose segmentations a task keeps
AGENDAS = 400_000    # and agendas of these words
CHARS = 1_000_000    # characters encoded at a time
NONE = np.int64(2**62)
_M = (1 << 64) - 1


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _mix(x):
    """SplitMix64 finaliser over numpy uint64 arrays or Python integers."""
    if isinstance(x, int):
        x = (x + 0x9E3779B97F4A7C15) & _M
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _M
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _M
        return x ^ (x >> 31)
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Table(dict):
    """Word to its number; a new word gets the next one, and its hash is kept."""

    def __init__(self):
        super().__init__()
        self.names, self.hashes = [], []

    def __missing__(self, word):
        n = self[word] = len(self)
        self.names.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")))
        return n


class _Pool:
    """An array that grows at its end; ``a`` may be longer than the ``n`` values that it holds."""

    def __init__(self, dtype, *width: int):
        self.a, self.n = np.zeros((1024, *width), dtype), 0

    def extend(self, values) -> None:
        self.n += self.put(values)

    def put(self, values) -> int:
        """Writes ``values`` after the held ones without holding them."""
        end = self.n + len(values)
        if end > len(self.a):
            grown = np.zeros((max(end, 2 * len(self.a)), *self.a.shape[1:]), self.a.dtype)
            grown[:self.n] = self.a[:self.n]
            self.a = grown
        self.a[self.n:end] = values
        return len(values)


def _code(at, pair):
    """A merge in one number: its place in the word (below ``LONG``) and both pieces (below 2**21)."""
    return at.astype(np.uint64) << np.uint64(42) | pair >> np.uint64(32) << np.uint64(21) | pair & np.uint64((1 << 21) - 1)


class Segmenter:
    """One model, dropout rate and seed; encodes batches of texts."""

    def __init__(self, model: bytes, rate: float = RATE, seed: int = SEED):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.size = sp.get_piece_size()
        self.limit = round(min(1.0, max(0.0, rate)) * 2**64)
        self.seed = _mix(seed & _M)
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)}
        self.piece = {sp.id_to_piece(i): i for i in range(n) if i not in special}
        self.char = {c: i for c, i in self.piece.items() if len(c) == 1 and c != SPACE} | {" ": self.piece[SPACE]}
        #: Id by code point; a character without a piece has the number ``size`` plus its code point.
        self.by_code = np.arange(0x110000, dtype=np.int32) + n
        for c, i in self.char.items():
            self.by_code[ord(c)] = i
        self.bytes = [b"" if i in special else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        for b, i in enumerate(self.byte):
            self.bytes[i] = bytes([b])
        rank = np.zeros(n + 1, np.int64)
        rank[np.array(sorted(range(n), key=lambda i: (-sp.get_score(i), i)))] = np.arange(n)
        pairs = {}
        for p, i in self.piece.items():
            for cut in range(1, len(p)):
                a, b = self.piece.get(p[:cut]), self.piece.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (int(rank[i]), i)
        keys = sorted(pairs)
        self.pairs = pairs
        self.pair_key = np.array([*keys, _M >> 1], np.int64)
        #: Rank and id of the piece that a pair makes, in one number: the least one is the next merge.
        self.pair_best = np.array([*(pairs[k][0] << 32 | pairs[k][1] for k in keys), NONE], np.int64)
        self._forget()

    def _forget(self) -> None:
        #: Of each word: its first agenda (-1: none yet), its hash and its length.
        self.words, self.root, self.hash, self.size_of = _Table(), _Pool(np.int64), _Pool(np.uint64), _Pool(np.int64)
        #: Of each agenda: its word, its ids in ``pool``, its merges in ``at``, ``pair`` and ``next`` without the
        #: ``done`` ones that it shares with the agenda it follows, and the skipped merges.
        self.word, self.start, self.count = _Pool(np.int64), _Pool(np.int64), _Pool(np.int64)
        self.first, self.merges, self.done = _Pool(np.int64), _Pool(np.int64), _Pool(np.int64)
        self.depth, self.skipped = _Pool(np.int64), _Pool(np.uint64, DEPTH)
        self.pool, self.at, self.pair, self.next = _Pool(np.int32), _Pool(np.uint8), _Pool(np.uint64), _Pool(np.int32)

    # -- one agenda ---------------------------------------------------------------------------
    def _skips(self, key: int, at: int, a: int, b: int) -> bool:
        return _mix(_mix(key ^ at) ^ (a << 32 | b)) < self.limit

    def _heap(self, ids: list[int], key: int) -> list[int]:
        n = len(ids)
        left, right, sym = list(range(-1, n - 1)), [*range(1, n), -1], list(ids)
        agenda = []

        def offer(i):
            j = right[i]
            if j >= 0:
                hit = self.pairs.get(sym[i] << 32 | sym[j])
                if hit and not (self.limit and self._skips(key, i, sym[i], sym[j])):
                    heapq.heappush(agenda, (hit[0], i, sym[i], sym[j], hit[1]))
        for i in range(n - 1):
            offer(i)
        while agenda:
            _, i, a, b, merged = heapq.heappop(agenda)
            j = right[i] if sym[i] == a else -1
            if j < 0 or sym[j] != b:
                continue
            sym[i], sym[j], right[i] = merged, -1, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [s for s in sym if s >= 0]

    def _candidates(self, a, b, at, key):
        """Rank and id, in one number, of merging a and b; NONE if the pair is no piece or the merge is skipped.

        ``key``: of each the key of its draws, or (two-dimensional) the codes of the merges that it skips.
        """
        pair = a.astype(np.int64) << 32 | b
        k = np.searchsorted(self.pair_key, pair)
        best = np.where(self.pair_key[k] == pair, self.pair_best[k], NONE)
        if self.limit and key.shape[-1:] != (0,):
            hit = np.flatnonzero(best != NONE)
            if len(hit) and key.ndim == 2:
                code = _code(at[hit], pair[hit].astype(np.uint64))
                best[hit[(key[hit] == code[:, None]).any(1)]] = NONE
            elif len(hit):
                h = _mix(_mix(key[hit] ^ at[hit].astype(np.uint64)) ^ pair[hit].astype(np.uint64))
                best[hit[h < np.uint64(min(self.limit, _M))]] = NONE
        return best

    def _arrays(self, sym: np.ndarray, n: np.ndarray, key: np.ndarray, taken: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Merges the words in the rows of ``sym`` (n symbols each), one step of every agenda at a time.

        ``taken``: gets (rows, places, pairs) of the merges of every step.
        """
        w, width = sym.shape
        out, size = sym.copy(), n.copy()
        if width < 2 or not w:
            return out, size
        row = np.arange(w)
        cols = np.arange(width)
        at = np.broadcast_to(cols.astype(np.uint8), sym.shape)
        offer = np.full((w, width), NONE, np.int64)
        r, c = np.nonzero(cols[None, :] < n[:, None] - 1)
        offer[r, c] = self._candidates(sym[r, c], sym[r, c + 1], at[r, c], key[r])
        while True:
            best = offer.argmin(1)
            top = offer[np.arange(len(row)), best]
            go = top != NONE
            if not go.all():
                done = ~go
                out[row[done], :width], size[row[done]] = sym[done], n[done]
                row, sym, at, offer, n, key, best, top = (x[go] for x in (row, sym, at, offer, n, key, best, top))
            if not len(row):
                return out, size
            i = np.arange(len(row))
            if taken is not None:
                taken.append((row, at[i, best], sym[i, best].astype(np.uint64) << np.uint64(32) | sym[i, best + 1].astype(np.uint64)))
            sym[i, best] = top & 0xFFFFFFFF
            src = np.minimum(cols[None, :] + (cols[None, :] > best[:, None]), width - 1) + (i * width)[:, None]
            sym, at, offer = (x.take(src) for x in (sym, at, offer))
            n = n - 1
            # The new piece with its right and its left neighbour.
            right, left = np.flatnonzero(best + 1 < n), np.flatnonzero(best > 0)
            j, p = np.r_[right, left], np.r_[best[right], best[left] - 1]
            offer[i, best] = NONE
            offer[j, p] = self._candidates(sym[j, p], sym[j, p + 1], at[j, p], key[j])
            if int(n.max()) < width:
                width = int(n.max())
                cols = cols[:width]
                sym, at, offer = (x[:, :width] for x in (sym, at, offer))

    # -- words and texts ----------------------------------------------------------------------
    def _segment(self, words: list[str], hashes: list[int], variant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each by the draws of its variant (any number), and the number of ids of each."""
        return self._merge(words, self._key(np.array(hashes, np.uint64), variant))

    def _key(self, hashes: np.ndarray, variant: np.ndarray) -> np.ndarray:
        return _mix(hashes ^ _mix(variant.astype(np.uint64) ^ np.uint64(self.seed)))

    def _merge(self, words: list[str], key: np.ndarray, taken: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and the number of ids of each; ``taken`` as in ``_arrays``, of the words up to ``LONG``."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        ids = self.by_code[codes]
        length = np.array([len(w) for w in words])
        first = np.cumsum(length) - length
        count = np.zeros(len(words), np.int64)
        merged = ids.copy()  # a word's ids stand where its characters stood, as far as there are any
        low = 0
        for high in (4, 8, 12, 16, 24, 32, LONG):
            some = np.flatnonzero((length > low) & (length <= high))
            low = high
            for k in range(0, len(some), 20_000):
                part = some[k:k + 20_000]
                place = np.minimum(first[part][:, None] + np.arange(high)[None, :], len(ids) - 1)
                steps = None if taken is None else []
                got, size = self._arrays(ids[place], length[part], key[part], steps)
                if steps:
                    taken += [(part[row], at, pair) for row, at, pair in steps]
                r, c = np.nonzero(np.arange(high)[None, :] < size[:, None])
                merged[place[r, c]] = got[r, c]
                count[part] = size
        for i in np.flatnonzero(length > LONG):
            got = self._heap(ids[first[i]:first[i] + length[i]].tolist(), int(key[i]) if key.ndim == 1 else 0)
            merged[first[i]:first[i] + len(got)], count[i] = got, len(got)
        end = np.cumsum(count)
        flat = merged[np.repeat(first - (end - count), count) + np.arange(count.sum())]
        strange = np.flatnonzero(flat >= self.size)
        if len(strange):  # spelt in bytes
            spelt = [[self.byte[b] for b in chr(x - self.size).encode("utf-8", "surrogatepass")] for x in flat[strange].tolist()]
            width = np.ones(len(flat), np.int64)
            width[strange] = [len(x) for x in spelt]
            to = np.cumsum(width) - width
            out = np.repeat(flat, width)
            for at, x in zip(to[strange].tolist(), spelt, strict=True):
                out[at:at + len(x)] = x
            return out, np.add.reduceat(width, end - count)
        return flat, count

    def _agendas(self, word: np.ndarray, depth: np.ndarray, done: np.ndarray, skipped: np.ndarray) -> None:
        """Adds the agendas of words (by number) that skip the merges of the codes ``skipped``."""
        taken = []
        flat, size = self._merge([self.words.names[i] for i in word.tolist()], skipped[:, :int(depth.max(initial=0))], taken)
        row, at, pair = (np.concatenate(x) for x in zip(*taken)) if taken else (np.zeros(0, t) for t in (np.int64, np.uint8, np.uint64))
        order = np.argsort(row, kind="stable")
        row, at, pair = row[order], at[order], pair[order]
        merges = np.bincount(row, minlength=len(word))
        keep = np.arange(len(row)) - (np.cumsum(merges) - merges)[row] >= done[row]
        merges = merges - done
        self.start.extend(self.pool.n + np.cumsum(size) - size)
        self.first.extend(self.at.n + np.cumsum(merges) - merges)
        for pool, x in ((self.word, word), (self.count, size), (self.merges, merges), (self.done, done), (self.depth, depth),
                        (self.skipped, skipped), (self.pool, flat), (self.at, at[keep]), (self.pair, pair[keep]),
                        (self.next, np.full(keep.sum(), -1))):
            pool.extend(x)

    def _agenda(self, number: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each occurrence of a word: its agenda by its draws, and whether it has to be merged on its own."""
        known = self.root.n
        if known < len(self.words):
            self.hash.extend(np.array(self.words.hashes[known:], np.uint64))
            self.size_of.extend(np.array([len(w) for w in self.words.names[known:]], np.int64))
            self.root.extend(np.full(len(self.words) - known, -1))
        # A word gets its agenda with its second occurrence; the first one alone is merged on its own.
        times = np.bincount(number, minlength=self.root.n)
        due = (times > 0) & (self.root.a[:self.root.n] < 0)
        due[known:] &= times[known:] > 1
        if self.limit:
            due &= self.size_of.a[:self.root.n] <= LONG
        due = np.flatnonzero(due)
        if len(due):
            none = np.zeros(len(due), np.int64)
            self.root.a[due] = self.word.n + np.arange(len(due))
            self._agendas(due, none, none, np.full((len(due), DEPTH), _M, np.uint64))
        agenda = self.root.a[number]
        alone = agenda < 0
        if not self.limit:
            return agenda, alone
        key = self._key(self.hash.a[number], draw)
        left = np.flatnonzero(~alone)
        while len(left):
            merges, first = self.merges.a[agenda[left]], self.first.a[agenda[left]]
            end = np.cumsum(merges)
            merge = np.repeat(first - (end - merges), merges) + np.arange(merges.sum())
            h = _mix(_mix(np.repeat(key[left], merges) ^ self.at.a[merge]) ^ self.pair.a[merge])
            skips = np.flatnonzero(h < np.uint64(min(self.limit, _M)))
            who = np.searchsorted(end, skips, "right")
            one = np.r_[True, who[1:] != who[:-1]][:len(who)]  # the first that each skips
            left, merge = left[who[one]], merge[skips[one]]
            deep = self.depth.a[agenda[left]] >= DEPTH
            alone[left[deep]] = True
            left, merge = left[~deep], merge[~deep]
            new, by = np.unique(merge, return_index=True)
            by, new = by[self.next.a[new] < 0], new[self.next.a[new] < 0]
            if len(new):
                parent = agenda[left[by]]
                depth, skipped = self.depth.a[parent], self.skipped.a[parent]
                skipped[np.arange(len(new)), depth] = _code(self.at.a[new], self.pair.a[new])
                self.next.a[new] = self.word.n + np.arange(len(new))
                self._agendas(self.word.a[parent], depth + 1, self.done.a[parent] + new - self.first.a[parent], skipped)
            agenda[left] = self.next.a[merge]
        return agenda, alone

    def encode(self, texts: list[str], doc_ids: np.ndarray) -> list[np.ndarray]:
        """Ids of each text; ``doc_ids`` key the draws of its words."""
        if len(self.words) > WORDS or self.word.n > AGENDAS:
            self._forget()
        # Spaces start a word; a literal U+2581 stands alone and is spelt in bytes.
        split = [WORD.findall(" " + t) if t else [] for t in texts]
        n = np.array([len(x) for x in split], np.int64)
        number = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, int(n.sum()))
        first = np.cumsum(n) - n
        place = np.arange(len(number)) - np.repeat(first, n)
        draw = _mix(_mix(np.repeat(doc_ids.astype(np.int64).view(np.uint64), n) ^ np.uint64(self.seed)) ^ place.astype(np.uint64))
        agenda, alone = self._agenda(number, draw)
        count, start = self.count.a[agenda], self.start.a[agenda]
        alone = np.flatnonzero(alone)
        if len(alone):
            own = number[alone].tolist()
            flat, size = self._segment([self.words.names[i] for i in own], [self.words.hashes[i] for i in own], draw[alone])
            self.pool.put(flat)
            count[alone], start[alone] = size, self.pool.n + np.cumsum(size) - size
        end = np.cumsum(count)
        ids = self.pool.a[np.repeat(start - (end - count), count) + np.arange(count.sum())]
        return np.split(ids, np.r_[0, end][np.cumsum(n)][:-1]) if len(texts) else []

    def decode(self, ids) -> str:
        text = b"".join([self.bytes[i] for i in ids]).decode("utf-8", "surrogatepass")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def _segmenter(model: bytes, rate: float, seed: int = SEED) -> Segmenter:
    """One segmenter a worker process; a task leaves its table of words empty."""
    return Segmenter(model, rate, seed)


def _model(path: str | None) -> bytes:
    with open(path or model_path(), "rb") as f:  # a file of the driver; its bytes go with the tasks
        return f.read()


def encode(docs: DataFrame, out: str = "ids", id_col: str = "doc_id", text_col: str = "text", rate: float = RATE,
           seed: int = SEED, path: str | None = None) -> DataFrame:
    """``docs`` with the ids of its texts in a further column ``out`` (array<int>)."""
    model, out = _model(path), fresh(docs, out)
    id_at, text_at, names = docs.columns.index(id_col), docs.columns.index(text_col), [*docs.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = _segmenter(model, rate, seed)
        for b in batches:
            texts = [t or "" for t in b.column(text_at).to_pylist()]
            doc_ids = np.array([i or 0 for i in b.column(id_at).to_pylist()], np.int64)
            for i, j in by_chars(texts, CHARS):
                ids = s.encode(texts[i:j], doc_ids[i:j])
                flat = pa.array(np.concatenate(ids).astype(np.int32))
                ends = pa.array(np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32))
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(ends, flat)], names)
        s._forget()

    return docs.mapInArrow(run, docs.withColumn(out, F.array().cast("array<int>")).schema)


def decode(encoded: DataFrame, ids_col: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``encoded`` with the text of its ids in a further column ``out``."""
    model, out = _model(path), fresh(encoded, out)
    at, names = encoded.columns.index(ids_col), [*encoded.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = _segmenter(model, 0.0)
        for b in batches:
            texts = [s.decode(x or ()) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names)

    return encoded.mapInArrow(run, encoded.withColumn(out, F.lit("")).schema)


def summary(docs: DataFrame, rate: float = RATE, seed: int = SEED,
            path: str | None = None) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, lossless): what a text's ids are, and whether they give it back."""
    model = _model(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = _segmenter(model, rate, seed)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            doc_ids = np.array([i or 0 for i in b.column(0).to_pylist()], np.int64)
            n, crc, same = [], [], []
            for i, j in by_chars(texts, CHARS):
                for t, ids in zip(texts[i:j], s.encode(texts[i:j], doc_ids[i:j]), strict=True):
                    n.append(len(ids))
                    crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    same.append(s.decode(ids.tolist()) == t)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
                ["doc_id", "n_pieces", "ids_crc32", "lossless"])
        s._forget()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_pieces long, ids_crc32 long, lossless boolean")
