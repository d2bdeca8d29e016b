"""Hard-negative mining with an STR-packed R-tree.

Vectors become integers, scores are integer inner products. The index sorts all vectors by label and first
coordinate into ranges (sort, tile); a task cuts its range into shards of at most ``SHARD`` vectors and
packs each shard's labels by sort-tile-recursive into leaves of ``LEAF`` neighbours, with the least and the
greatest value of every coordinate as their box. ``FAN`` leaves make a node, whose box holds theirs. For an anchor, a
box gives an interval of inner products, coordinate by coordinate. A best-first queue takes the
box of the highest upper end next; boxes outside the score window, leaves without a vector of a wanted label, and
boxes whose upper end is strictly below the k-th score so far are never opened (equal scores may still win by
their id). The best k of all shards are the result, so it does not depend on the packing.

Anchors are asked for in blocks of ``ANCHORS``: first their positives (the best of the same label), then, for each
positive, the best of other labels in its window. Each block is a table in the shared folder.

Defined results: rows whose id, label or vector is NULL, or that have a component that is NULL, NaN, infinite or
beyond ``LARGEST``, take no part; vectors of another length than the anchor's are not compared with it. Repeated rows
count one by one, but a row is never a positive of a row with its own id; a repeated anchor gives its rows
again. An anchor without positives, or a positive without negatives in its window, has no row. An empty
table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90     # a negative's score in percent of the positive's
LARGEST = 1 << 17      # components below it give exact scores of up to 2**12 components
LEAF, FAN = 64, 16     # vectors of a leaf, leaves of a node
SHARD = 8192           # vectors of a shard
ANCHORS = 20_000       # anchors sent to the tasks at a time
TILES = 3              # coordinates by which a shard is tiled
INDEX = "n int, width int, ids binary, vectors binary, starts binary, labels binary"
EXACT = 1 << 53


def clean(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
          label: Column | None = None, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, x): the rows that take part, components as floor(scale * component)."""
    v = F.col(vector_col)

    def fine(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST)

    part = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(F.forall(v, fine), F.lit(False))
    return vectors.filter(part).select(
        F.col(id_col).cast("long").alias("vec_id"), (F.col(label_col) if label is None else label).cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("x"))


def tiled(x: np.ndarray) -> list[np.ndarray]:
    """Sort-tile-recursive: the rows of ``x`` in groups of at most ``LEAF`` neighbours, in packing order."""
    by = np.argsort(-x.var(axis=0), kind="stable")[:TILES] if x.shape[1] else np.zeros(0, int)

    def pack(rows: np.ndarray, depth: int) -> Iterator[np.ndarray]:
        leaves = -(-len(rows) // LEAF)
        if depth < len(by):
            rows = rows[np.argsort(x[rows, by[depth]], kind="stable")]
        if leaves <= 1 or depth + 1 >= len(by):
            for i in range(0, len(rows), LEAF):
                yield rows[i:i + LEAF]
            return
        slabs = max(1, round(leaves ** (1 / (len(by) - depth))))
        size = -(-leaves // slabs) * LEAF
        for i in range(0, len(rows), size):
            yield from pack(rows[i:i + size], depth + 1)

    return list(pack(np.arange(len(x)), 0))


def _shard(ids: np.ndarray, label: np.ndarray, x: np.ndarray) -> tuple:
    """One index row: leaves of one label each, packed label by label."""
    order, starts, labels = [], [], []
    at = 0
    for value in np.unique(label):
        own = np.flatnonzero(label == value)
        for leaf in tiled(x[own]):
            order.append(own[leaf])
            starts.append(at)
            labels.append(value)
            at += len(leaf)
    order = np.concatenate(order)
    return (len(ids), x.shape[1], ids[order].tobytes(), x[order].tobytes(), np.array(starts, np.int64).tobytes(),
            np.array(labels, np.int64).tobytes())


def build(rows: DataFrame, shard: int = SHARD) -> DataFrame:
    """The index of ``clean`` rows: one row per shard, written to the shared folder."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def packed():
            ids, label = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            row = _shard(ids, label, np.concatenate([h[2] for h in held]))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row[:2]] + [pa.array([v], pa.binary()) for v in row[2:]],
                                              [c.split()[0] for c in INDEX.split(", ")]).cast(schema)

        for b in parts:
            width = np.diff(b.column(2).offsets.to_numpy())
            cut = np.flatnonzero(np.r_[True, width[1:] != width[:-1], True])
            for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):  # rows come sorted by their width
                for i in range(s, e, shard):
                    part = b.slice(i, min(e, i + shard) - i)
                    new = (part.column(0).to_numpy(), part.column(1).to_numpy(),
                           part.column(2).flatten().to_numpy().reshape(part.num_rows, int(width[s])))
                    if held and (held[0][2].shape[1] != width[s] or sum(len(h[0]) for h in held) + len(new[0]) > shard):
                        yield packed()
                    held.append(new)
        if held:
            yield packed()

    schema = pa.schema([("n", pa.int32()), ("width", pa.int32()), *[(c, pa.binary()) for c in ("ids", "vectors", "starts", "labels")]])
    first = F.when(F.size("x") > 0, F.col("x")[0]).otherwise(F.lit(0).cast("long"))
    keys = [F.size("x"), F.col("label"), first, F.col("vec_id")]  # the id parts a hot label or vector
    return materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, INDEX), "r-tree")


class Tree:
    """One shard: vectors, leaves and nodes with their boxes."""

    def __init__(self, row: dict):
        n, width = row["n"], row["width"]
        self.ids, self.x = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"], np.int64).reshape(n, width)
        self.starts, self.labels = np.frombuffer(row["starts"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.ends = np.r_[self.starts[1:], n]
        self.nodes = np.arange(0, len(self.starts), FAN)
        self.low, self.high = np.minimum.reduceat(self.x, self.starts), np.maximum.reduceat(self.x, self.starts)
        self.node_low, self.node_high = np.minimum.reduceat(self.low, self.nodes), np.maximum.reduceat(self.high, self.nodes)
        self.largest = int(np.abs(self.x).max(initial=0))

    def intervals(self, a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of the anchors with any vector of each box."""
        kind = np.float64 if a.shape[1] * max(1, int(np.abs(a).max(initial=0))) * max(1, self.largest) < EXACT else np.int64
        up, down = np.maximum(a, 0).astype(kind), np.minimum(a, 0).astype(kind)
        low, high = low.T.astype(kind), high.T.astype(kind)
        return (up @ low + down @ high).astype(np.int64), (up @ high + down @ low).astype(np.int64)


class Asked:
    """A block of questions: for an anchor (row of ``vectors``), the best ``k`` rows of its label (or of other
    labels) with scores in [low, high]."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, anchor: np.ndarray, low: np.ndarray,
                 high: np.ndarray, same: bool, k: int):
        self.vectors, self.ids, self.labels, self.same, self.k = vectors, ids, labels, same, k
        self.anchor, self.low, self.high = anchor, low.tolist(), high.tolist()
        self.first = np.searchsorted(anchor, np.arange(len(vectors) + 1)).tolist()  # questions come sorted by anchor


def best_first(tree: Tree, asked: Asked, best: list[list[tuple[int, int]]], opened: list[int] | None = None) -> None:
    """Merges the shard's answers into ``best``: of each question, at most k (score, -vec_id), a heap.

    ``opened``: gets the number of leaves looked into.
    """
    if tree.x.shape[1] != asked.vectors.shape[1]:
        return
    leaf_low, leaf_high = tree.intervals(asked.vectors, tree.low, tree.high)
    node_low, node_high = tree.intervals(asked.vectors, tree.node_low, tree.node_high)
    n_leaves, n_opened = len(tree.starts), 0
    for a in range(len(asked.vectors)):
        if asked.first[a] == asked.first[a + 1]:
            continue
        wanted = (tree.labels == asked.labels[a]) == asked.same
        scored: dict[int, tuple[list[int], list[int]]] = {}  # the questions of one anchor share its scores
        vector = asked.vectors[a]
        tops = [(-int(h), True, i) for i, h in enumerate(node_high[a])]
        for q in range(asked.first[a], asked.first[a + 1]):
            low, high, heap = asked.low[q], asked.high[q], best[q]
            queue = list(tops)
            heapq.heapify(queue)
            while queue:
                end, is_node, i = heapq.heappop(queue)
                if -end < low or (len(heap) == asked.k and -end < heap[0][0]):
                    break  # no box left reaches the window or the k-th score
                if is_node:
                    if node_low[a, i] <= high:
                        s = i * FAN
                        for j in range(s, min(s + FAN, n_leaves)):
                            if wanted[j] and leaf_low[a, j] <= high:
                                heapq.heappush(queue, (-int(leaf_high[a, j]), False, j))
                    continue
                if i not in scored:
                    n_opened += 1
                    s, e = tree.starts[i], tree.ends[i]
                    score, ids = tree.x[s:e] @ vector, tree.ids[s:e]
                    if asked.same:
                        other = ids != asked.ids[a]
                        score, ids = score[other], ids[other]
                    scored[i] = score.tolist(), ids.tolist()
                for score, vec_id in zip(*scored[i], strict=True):
                    if low <= score <= high:
                        if len(heap) < asked.k:
                            heapq.heappush(heap, (score, -vec_id))
                        elif (score, -vec_id) > heap[0]:
                            heapq.heapreplace(heap, (score, -vec_id))
    if opened is not None:
        opened.append(n_opened)


def ask(index: DataFrame, asked: Asked) -> DataFrame:
    """(question, rank, vec_id, score): the best ``k`` rows of every question, over all shards."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in asked.low]
        for b in parts:
            for i in range(b.num_rows):
                best_first(Tree(b.slice(i, 1).to_pylist()[0]), asked, best)
        rows = [(q, -v, s) for q, x in enumerate(best) for s, v in x]
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["question", "vec_id", "score"])

    w = Window.partitionBy("question").orderBy(F.desc("score"), "vec_id")
    return index.mapInArrow(run, "question long, vec_id long, score long") \
        .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= asked.k)


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, block: int = ANCHORS, shard: int = SHARD) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among ``clean`` rows."""
    rows = materialize(rows, "vectors")
    index = build(rows, shard)
    anchors = materialize(rows.filter(is_anchor).withColumn("row", F.monotonically_increasing_id()), "anchors")
    widths = [r.w for r in anchors.select(F.size("x").alias("w")).distinct().collect()]  # lengths of vectors
    out = []
    for width in widths:
        own = anchors.filter(F.size("x") == width)
        blocks = max(1, -(-own.count() // block))
        for b in range(blocks):
            some = own.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).toArrow()
            out.append(_block(index, some, width, positives, negatives, low, high))
    if not out:
        return rows.sparkSession.createDataFrame([], OUT)
    return reduce(DataFrame.unionByName, out)


def _block(index: DataFrame, anchors: pa.Table, width: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    n = anchors.num_rows
    ids, labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
    vectors = np.array([v for c in anchors["x"].chunks for v in c.to_pylist()], np.int64).reshape(n, width)
    all_scores = np.full(n, np.iinfo(np.int64).max, np.int64)
    found = ask(index, Asked(vectors, ids, labels, np.arange(n), -all_scores, all_scores, True, positives)).toArrow()
    # At most ``positives`` for every anchor of the block.
    anchor, positive, score = (found[c].to_numpy() for c in ("question", "vec_id", "score"))
    order = np.lexsort((positive, -score, anchor))
    anchor, positive, score = anchor[order], positive[order], score[order]
    asked = Asked(vectors, ids, labels, anchor, -(-low * score // 100), high * score // 100, False, negatives)

    def named(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            q = b.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[anchor[q]]), pa.array(positive[q]), b.column(3), b.column(1), pa.array(score[q]), b.column(2)],
                [c.split()[0] for c in OUT.split(", ")])

    return materialize(ask(index, asked).select("question", "vec_id", "score", "rank").mapInArrow(named, OUT), "negatives")


def summary(vectors: DataFrame) -> DataFrame:
    """The hard negatives of every row whose id is divisible by 100; labels of ids divisible by 7 move on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(clean(vectors, label=moved), F.col("vec_id") % 100 == 0)


ORACLE = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n
  FROM s WHERE same AND vec_id <> anchor_id QUALIFY n <= {POSITIVES})
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.r, p.n ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.r = s.r AND NOT s.same AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""
