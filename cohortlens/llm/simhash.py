"""SimHash near-duplicates through anchor points of a covering code.

A 64-bit fingerprint is cut in two halves; of two fingerprints with at most three differing bits, one
half differs in one bit at most. The anchors of a half are the words of a covering code: the binary
Golay code on 23 bits (covering radius 3), the Hamming code on 7 (radius 1) and all words of the last 2
(radius 0). Every half has a home anchor within that radius. A fingerprint is replicated to its home
and to every anchor that is the home of a half one bit away: the anchors within covering radius plus
threshold that a partner can call home (about ten). At each anchor the fingerprints at home are
compared with all that were replicated there, so each link is found, and by the full 64 bits.

The fingerprints of a crowded anchor are dealt to cells by a second covering, of their other half: of its two quarters
one differs in one bit at most. The cells of a quarter are the words of the Hamming code on 15 bits (radius 1) and
those of the last bit. There the fewer, those at home at the anchor, are replicated (to about nine cells a quarter), and
the others stand in their home cell alone. So what one anchor compares falls by a factor of hundreds, and a link is
still always found. A cell that is crowded itself (very many fingerprints of nearly the same bits) is compared in blocks.

Defined results: a NULL text counts as empty; a text without words has fingerprint zero, which links
like any other; a row whose id is NULL gets a fingerprint, but links with nothing and has component
NULL; equal ids share a component; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize
from .components import components

WORDS, MAX_BITS, SEED = 3, 3, 42
# Generator polynomials of the Golay [23,12], the Hamming [7,4] and the Hamming [15,11] code.
GOLAY, HAMMING, HAMMING_15 = 0xC75, 0b1011, 0b10011
BLOCK = 20_000       # rows of one anchor that one group compares; more are dealt to cells, then to pairs of blocks
PAIRS = 2_000_000    # pairs compared at a time
SMALL = 100_000      # rows of the table of crowded anchors up to which it is broadcast
GROUP = ["half", "anchor", "cell", "i", "j"]


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Majority bits of the XXH64 of every word shingle of the lower-cased text."""
    w = text.lower().split()  # on bytes: A-Z only, and white space is 0x20 and 0x09 to 0x0D
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(x) + 1 for x in w))
    starts = [0, *ends]
    h = np.array([xxhash.xxh64_intdigest(joined[s:e - 1], SEED)
                  for s, e in zip(starts, ends[words - 1:], strict=False)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer, one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fp = np.array([fingerprint(t or b"", words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["doc_id", "fp"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, "doc_id long, fp long")


def _decoder(generator: int, n: int, radius: int):
    """Arrays that turn an n-bit word into the number of its code word (perfect cyclic code)."""
    check = generator.bit_length() - 1

    def remainder(x: int) -> int:
        while x.bit_length() > check:
            x ^= generator << (x.bit_length() - 1 - check)
        return x

    unit = [remainder(1 << i) for i in range(n)]
    leader = np.zeros(1 << check, np.uint32)
    for weight in range(1, radius + 1):
        for places in combinations(range(n), weight):
            r = 0
            for i in places:
                r ^= unit[i]
            leader[r] = sum(1 << i for i in places)
    low = n // 2
    tables = []
    for bits in (unit[:low], unit[low:]):
        t = np.zeros(1 << len(bits), np.uint32)
        for i, r in enumerate(bits):
            t[1 << i:2 << i] = t[:1 << i] ^ np.uint32(r)
        tables.append(t)
    return low, check, tables, leader


@cache
def _codes():
    return _decoder(GOLAY, 23, 3), _decoder(HAMMING, 7, 1), _decoder(HAMMING_15, 15, 1)


def _word(x: np.ndarray, n: int, code) -> np.ndarray:
    """The number of the code word nearest to each n-bit word."""
    low, check, (t0, t1), leader = code
    x = x & np.uint32((1 << n) - 1)
    r = t0[x & np.uint32((1 << low) - 1)] ^ t1[x >> np.uint32(low)]
    return (x ^ leader[r]) >> np.uint32(check)


def home(half: np.ndarray) -> np.ndarray:
    """The number of the home anchor (18 bits) of each 32-bit half."""
    golay, hamming, _ = _codes()
    out = half >> np.uint32(30) | _word(half, 23, golay) << np.uint32(6) | _word(half >> np.uint32(23), 7, hamming) << np.uint32(2)
    return out.astype(np.int32)


def cell(quarter: np.ndarray) -> np.ndarray:
    """The number of the home cell (12 bits) of each 16-bit quarter."""
    return (quarter >> np.uint32(15) | _word(quarter, 15, _codes()[2]) << np.uint32(1)).astype(np.int32)


def _first_of_row(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the different values of each row."""
    at = np.sort(at, axis=1)
    keep = np.ones(at.shape, bool)
    keep[:, 1:] = at[:, 1:] != at[:, :-1]
    row, col = np.nonzero(keep)
    return row, at[row, col]


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, half, anchor, at home) of every replica of the given fingerprints."""
    errors = np.array([0] + [1 << i for i in range(32)], np.uint32)
    out = []
    for side in (0, 1):
        half = ((fp.view(np.uint64) >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        at = home(half[:, None] ^ errors[None, :])
        row, a = _first_of_row(at)
        out.append((row, np.full(len(row), side, np.int8), a, a == at[row, 0]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _to_cells(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of crowded anchors with their cells (from 1 on): rows at home in every cell a partner can call home."""
    errors = np.array([0] + [1 << i for i in range(16)], np.uint32)
    for p in parts:
        for i in range(0, len(p), 5000):
            part = p.iloc[i:i + 5000]
            at_home, fp = part["home"].to_numpy(), part["fp"].to_numpy().view(np.uint64)
            other = np.where(part["half"].to_numpy() == 0, fp >> np.uint64(32), fp & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            for q in (0, 1):
                quarter = other >> np.uint32(16 * q) & np.uint32(0xFFFF)
                asks, stays = np.flatnonzero(at_home), np.flatnonzero(~at_home)
                row, at = _first_of_row(cell(quarter[asks, None] ^ errors[None, :]))
                row, at = np.r_[asks[row], stays], np.r_[at, cell(quarter[stays])]
                yield part.iloc[row].assign(cell=(1 + 2 * at + q).astype(np.int32))[["half", "anchor", "cell", "fp", "rep", "home"]]


def _replicate(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        for i in range(0, len(p), 5000):
            fp, rep = p.fp.to_numpy()[i:i + 5000], p.rep.to_numpy()[i:i + 5000]
            row, half, anchor, at_home = anchors(fp)
            yield pd.DataFrame({"half": half, "anchor": anchor, "fp": fp[row], "rep": rep[row], "home": at_home})


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the given edges: every node but the smallest of its tree, with that one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, root = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while True:
        before = root.copy()
        least = np.minimum(root[x], root[y])
        for side in (x, y):
            np.minimum.at(root, root[side], least)
            np.minimum.at(root, side, least)
        root = root[root]
        if (root == before).all():
            keep = root != np.arange(len(nodes))
            return nodes[keep], nodes[root[keep]]


def _links(key: np.ndarray, fp: np.ndarray, rep: np.ndarray, at_home: np.ndarray, max_bits: int):
    """Linked pairs of equal ``key`` (sorted), each home row against all rows, ``PAIRS`` at a time."""
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    group = np.repeat(np.arange(len(first)), size)
    rows = np.flatnonzero(at_home & (size[group] > 1))
    width = size[group[rows]]
    done = np.r_[0, np.cumsum(width)]
    i = 0
    while i < len(rows):
        j = max(i + 1, int(np.searchsorted(done, done[i] + PAIRS, "right")) - 1)
        w = width[i:j]
        x = np.repeat(rows[i:j], w)
        y = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(first[group[rows[i:j]]], w)
        near = (np.bitwise_count(fp[x] ^ fp[y]) <= max_bits) & (fp[x] != fp[y])
        if near.any():
            yield forest(rep[x[near]], rep[y[near]])
        i = j


def _compare(max_bits: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # the last group of a batch may go on in the next one
        for p in parts:
            p = p if rest is None else pd.concat([rest, p], ignore_index=True)
            k = _group_key(p)
            last = int(np.searchsorted(k, k[-1])) if len(k) else 0
            rest = p.iloc[last:]
            yield from _edges(p.iloc[:last], k[:last], max_bits)
        if rest is not None and len(rest):
            yield from _edges(rest, _group_key(rest), max_bits)
    return run


def _group_key(p: pd.DataFrame) -> np.ndarray:
    same = np.zeros(len(p), np.int64)
    for c in GROUP:
        v = p[c].to_numpy()
        same[1:] |= v[1:] != v[:-1]
    return np.cumsum(same)


def _edges(p: pd.DataFrame, key: np.ndarray, max_bits: int) -> Iterator[pd.DataFrame]:
    if len(p):
        for a, b in _links(key, p.fp.to_numpy(), p.rep.to_numpy(), p.home.to_numpy(), max_bits):
            yield pd.DataFrame({"a": a, "b": b})


def _crowded(rows: DataFrame, keys: list[str], block: int) -> tuple[DataFrame, int]:
    """The groups of more than ``block`` rows with their numbers of blocks, and how many such groups there are."""
    crowd = rows.groupBy(*keys).agg(F.count_if("home").alias("n_home"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    crowd = materialize(crowd.select(
        *keys, F.ceil(F.col("n_home") / block).cast("int").alias("ni"),
        F.ceil(F.col("n") / block).cast("int").alias("nj")), "crowded")
    n = crowd.count()  # at most one in ``block`` of the rows
    return F.broadcast(crowd) if n <= SMALL else crowd, n


def _in_cells(replicas: DataFrame, block: int) -> DataFrame:
    """``replicas`` with their group: cell, i and j are 0 but at crowded anchors, whose rows are dealt to cells."""
    zero = F.lit(0)
    crowd, n = _crowded(replicas, ["half", "anchor"], block)
    if n == 0:
        return replicas.withColumns({"cell": zero, "i": zero, "j": zero})
    r = replicas.join(crowd, ["half", "anchor"], "left")
    plain = r.filter("nj IS NULL").select("half", "anchor", zero.alias("cell"), "fp", "rep", "home", zero.alias("i"), zero.alias("j"))
    cells = r.filter("nj IS NOT NULL").select("half", "anchor", "fp", "rep", "home") \
        .mapInPandas(_to_cells, "half byte, anchor int, cell int, fp long, rep long, home boolean")
    return plain.unionByName(_dealt(materialize(cells, "cells"), block))


def _dealt(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` with block numbers (i, j): 0, 0, but in crowded cells every pair of blocks meets.

    There, rows at home are dealt to blocks i and copied to every j, the others the other way round, so
    that no group holds more than about two blocks.
    """
    keys, zero = ["half", "anchor", "cell"], F.lit(0)
    crowd, n = _crowded(rows, keys, block)
    if n == 0:
        return rows.withColumns({"i": zero, "j": zero})
    r = rows.join(crowd, keys, "left").fillna(1, ["ni", "nj"])
    ni, nj = F.greatest("ni", F.lit(1)), F.col("nj")
    own_i, own_j = F.pmod(F.hash("fp"), ni), F.pmod(F.hash("fp"), nj)
    at_home = r.filter("home").withColumn("i", own_i).withColumn("j", F.explode(F.sequence(zero, nj - 1)))
    visits = r.withColumn("home", F.lit(False)).withColumn("j", own_j) \
        .withColumn("i", F.explode(F.sequence(zero, ni - 1)))
    single = (F.col("ni") <= 1) & (F.col("nj") <= 1)
    cols = [*keys, "fp", "rep", "home", "i", "j"]
    return r.filter(single).withColumns({"i": zero, "j": zero}).select(cols) \
        .unionByName(at_home.filter(~single).select(cols)).unionByName(visits.filter(~single).select(cols))


def link(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): links between representatives ``rep`` of distinct fingerprints ``fp``.

    Of the links that one task finds in a group, a spanning forest is emitted, not all pairs.
    """
    if max_bits > 3:
        raise ValueError("two halves with one error each cover at most three bits")
    replicas = materialize(fps.mapInPandas(_replicate, "half byte, anchor int, fp long, rep long, home boolean"), "replicas")
    dealt = _in_cells(replicas, block).repartition(*GROUP).sortWithinPartitions(*GROUP)
    return dealt.mapInPandas(_compare(max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``."""
    prints = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    named = prints.filter(F.col("doc_id").isNotNull())
    fps = materialize(named.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    roots = components(link(fps, max_bits), "a", "b")
    of = fps.join(roots, fps.rep == roots.node, "left").select(
        "fp", F.coalesce("root", "rep").alias("component_id"))
    whole = named.join(of, "fp").select("doc_id", "fp", "component_id")
    unnamed = prints.filter(F.col("doc_id").isNull()).withColumn("component_id", F.lit(None).cast("long"))
    return whole.unionByName(unnamed)


def summary(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose id is not the smallest of their group.

    Rows that agree in id and text are one document and come once (where further columns differ, the row whose
    columns come first as JSON); different texts under the smallest id all stay, for none of them is a copy of
    one that does. Rows whose id is NULL cannot be told apart and all stay.
    """
    best = near_duplicates(docs, id_col, text_col).filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(best, docs[id_col] == best.doc_id, "left_semi")
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    rank = fresh(docs, "rank")
    order = [F.to_json(F.struct(*rest))] if rest else [F.lit(0)]
    same = Window.partitionBy(id_col, text_col).orderBy(*order)  # a rank limit: a task hands on one row of each
    kept = kept.withColumn(rank, F.row_number().over(same)).filter(F.col(rank) == 1).drop(rank)
    return kept.unionByName(docs.filter(F.col(id_col).isNull()))
