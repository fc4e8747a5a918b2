"""Hard negatives by Fagin's threshold algorithm.

1. Lists. Candidate rows are packed into blocks of at most ``block_rows`` rows.
   A block holds its integer vectors and, for every dimension, its rows sorted
   by that dimension. Blocks are a written table, made once.
2. Search. Anchors come in blocks of at most ``anchor_rows`` rows, and every
   block meets all candidates where they lie. For an anchor, the list of a
   dimension is read from its top where the anchor's component is positive and
   from its bottom where it is negative. Each row met is scored in full by
   random access. The threshold is the score a row would have that equals, in
   every dimension, the last value read; no row that has not been met can
   score higher. Reading stops once the threshold lies strictly below the
   k-th score of each window, the best of the task's earlier blocks included.
3. Windows. The first search has one window an anchor: the other rows of its
   label. The second has one for each distinct positive score ``p``: the rows of
   other labels with a score from ``low p`` to ``high p`` (in hundredths). Rows above
   a window are met, scored and left out.
4. Merge. A task hands on at most ``k`` rows a window; the best of all tasks stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridewise.llm.common import cut_lineage

BLOCKS = "n int, ids binary, ords binary, labels binary, vectors binary, lists binary"
ANCHORS = "vec_id long, ord long, label long, vector binary"
HITS = "anchor long, win long, vec_id long, ord long, score long"
FIRST, GROWTH = 8, 4           # rows read from each list at first, and the factor from step to step
LOWEST = -(2 ** 63)


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``vec_id, label, q``: rows that take part, components as ``floor(scale x)``."""
    x = F.col(vector_col).cast("array<double>")
    ok = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), x.alias("x"))
              .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", ok))
              .select("vec_id", "label", F.transform("x", lambda v: F.floor(F.lit(float(scale)) * v)).alias("q")))


def _dense(column: pa.Array, dims: int) -> np.ndarray:
    """One row a vector; a vector shorter than ``dims`` is filled up with zeros."""
    off = column.offsets.to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(off)
    out = np.zeros((len(size), dims), dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(off[:-1] - off[0], size)] = flat
    return out


def _pack_rows(dims: int, block_rows: int):
    def pack(base, at, parts):
        ids, labels, vectors = (np.concatenate(x) for x in zip(*parts))
        ords = base + at + np.arange(len(ids), dtype=np.int64)
        lists = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array([len(ids)], pa.int32())] + [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
                                                  for x in (ids, ords, labels, vectors, lists)],
            names=["n", "ids", "ords", "labels", "vectors", "lists"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, at, parts, held = TaskContext.get().partitionId() << 40, 0, [], 0
        for b in batches:
            for lo in range(0, b.num_rows, block_rows):
                part = b.slice(lo, block_rows)
                if held + part.num_rows > block_rows:
                    yield pack(base, at, parts)
                    at, parts, held = at + held, [], 0
                parts.append((part.column(0).to_numpy(), part.column(1).to_numpy(), _dense(part.column(2), dims)))
                held += part.num_rows
        if held:
            yield pack(base, at, parts)
    return run


class Block:
    """Candidate rows with a sorted list for each dimension."""

    def __init__(self, n: int, dims: int, ids: bytes, ords: bytes, labels: bytes, vectors: bytes, lists: bytes):
        self.ids, self.ords, self.labels = (np.frombuffer(x, np.int64) for x in (ids, ords, labels))
        self.vectors = np.frombuffer(vectors, np.int64).reshape(n, dims)
        self.lists = np.frombuffer(lists, np.int32).reshape(dims, n)
        self.float = self.vectors.astype(np.float64)
        self.dims = np.arange(dims)
        self.most = int(np.abs(self.vectors).max(initial=0))

    def scores(self, rows: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
        """Inner products; in doubles where they cannot lose a bit."""
        if exact:
            return (self.float[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ anchor

    def search(self, anchor: np.ndarray, own: int, allowed, windows: list[Best]) -> int:
        """Feeds the rows of ``allowed`` (a test of row numbers) other than
        ``own`` to the windows; returns how many rows were scored."""
        n = len(self.ids)
        used = self.dims[anchor != 0]
        up = anchor[used] > 0
        bound = self.most * int(np.abs(anchor).sum())
        if bound >= 2 ** 63:
            raise ArithmeticError("a score may not fit into 64 bits")
        met, depth, step, scored = np.zeros(n, dtype=bool), 0, FIRST, 0
        while True:
            last = self.lists[used, np.where(up, n - 1 - depth, depth)] if depth < n else None
            if last is None or scored == n:
                return scored
            threshold = int(self.vectors[last, used] @ anchor[used])
            if all(threshold < w.least() for w in windows):
                return scored
            upto = min(n, depth + step) if len(used) else n
            rows = (np.r_[self.lists[used[up], n - upto:n - depth].ravel(), self.lists[used[~up], depth:upto].ravel()]
                    if len(used) else np.arange(n))
            fresh = np.zeros(n, dtype=bool)
            fresh[rows] = True
            fresh &= ~met
            met |= fresh
            rows = np.flatnonzero(fresh)
            scored += len(rows)
            rows = rows[allowed(rows) & (self.ords[rows] != own)]
            score = self.scores(rows, anchor, bound < 2 ** 53)
            for w in windows:
                w.take(score, self.ids[rows], self.ords[rows])
            depth, step = upto, step * GROWTH


class Best:
    """The best ``k`` rows with a score in ``low..high``: higher scores first,
    ties by smaller id."""

    def __init__(self, k: int, low: int = LOWEST, high: int = 2 ** 63 - 1):
        self.k, self.low, self.high = k, low, high
        self.score = self.id = self.ord = np.empty(0, np.int64)

    def take(self, score: np.ndarray, ids: np.ndarray, ords: np.ndarray) -> None:
        ok = np.flatnonzero((score >= self.least()) & (score <= self.high))
        if len(ok):
            s, i, o = np.r_[self.score, score[ok]], np.r_[self.id, ids[ok]], np.r_[self.ord, ords[ok]]
            top = np.lexsort((o, i, -s))[:self.k]
            self.score, self.id, self.ord = s[top], i[top], o[top]

    def least(self) -> int:
        """No row below this score can enter any more."""
        return max(self.low, int(self.score[-1])) if len(self.score) >= self.k else self.low


def _anchor_rows(dims: int, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                block = Block(b.column(0)[r].as_py(), dims, *(b.column(c)[r].as_buffer() for c in range(1, 6)))
                at = np.flatnonzero(block.ids % every == 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.ids[at]), pa.array(block.ords[at]), pa.array(block.labels[at]),
                     pa.array([v.tobytes() for v in block.vectors[at]], pa.binary())], names=["vec_id", "ord", "label", "vector"])
    return run


def _search_rows(sent, dims: int):
    """``sent``: anchors as (number, ord, label, vector, same label?, [(win, k, low, high)])."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wins = [[(win, Best(k, low, high)) for win, k, low, high in a[5]] for a in sent.value]
        for b in batches:
            for r in range(b.num_rows):
                block = Block(b.column(0)[r].as_py(), dims, *(b.column(c)[r].as_buffer() for c in range(1, 6)))
                for (_, own, label, vector, same, _), w in zip(sent.value, wins):
                    block.search(vector, own, lambda rows: (block.labels[rows] == label) == same, [x for _, x in w])
        for (number, *_), w in zip(sent.value, wins):
            for win, best in w:
                if len(best.id):
                    m = len(best.id)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number] * m, pa.int64()), pa.array([win] * m, pa.int64()), pa.array(best.id), pa.array(best.ord),
                         pa.array(best.score)], names=["anchor", "win", "vec_id", "ord", "score"])
    return run


def _best(hits: DataFrame, k: int, name: str) -> DataFrame:
    order = Window.partitionBy("anchor", "win").orderBy(F.col("score").desc(), "vec_id", "ord")
    return cut_lineage(hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), name)


def _mine_block(blocks: DataFrame, anchors: list, dims: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark = blocks.sparkSession
    send = spark.sparkContext.broadcast
    first = send([(i, o, lab, v, True, [(0, positives, LOWEST, 2 ** 63 - 1)]) for i, (_, o, lab, v) in enumerate(anchors)])
    found = _best(blocks.mapInArrow(_search_rows(first, dims), HITS), positives, "positives")
    scores: dict[int, set] = {}
    for r in found.select("anchor", "score").collect():                # at most ``positives`` rows an anchor of the block
        scores.setdefault(r["anchor"], set()).add(r["score"])
    asked = []
    for i, (_, o, lab, v) in enumerate(anchors):
        wins = [(p, negatives, -(-low * p // 100), high * p // 100) for p in sorted(scores.get(i, ()))]
        wins = [w for w in wins if w[2] <= w[3]]
        if wins:
            asked.append((i, o, lab, v, False, wins))
    second = send(asked)
    hits = _best(blocks.mapInArrow(_search_rows(second, dims), HITS), negatives, "negatives")
    names = spark.createDataFrame([(i, a) for i, (a, *_) in enumerate(anchors)], "anchor long, anchor_id long")
    return (found.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
                 .join(hits.select("anchor", F.col("win").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"),
                                   F.col("score").alias("negative_score")), ["anchor", "positive_score"])
                 .join(names, "anchor")
                 .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                         "negative_score"))


def mine(df: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
         id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block_rows: int = 8192,
         anchor_rows: int = 1 << 14) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``every``. An anchor's
    positives are its ``positives`` best other rows of the same label; for each,
    the ``negatives`` best rows of other labels with ``low positive_score <= 100
    negative_score <= high positive_score`` follow, ``rank`` from 1.

    * null id, label or vector, null or non-finite components: the row takes no part
    * vectors of different lengths: the shorter counts as filled up with zeros
    * ties: smaller id first; repeated rows, and rows with one id: rows of their own,
      so a copy of an anchor is one of its positives, and an anchor that is there
      twice has its rows twice
    * scores beyond 64 bits: ArithmeticError; empty table: empty result
    * other columns are not read
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vector_col, label_col, scale)
    dims = rows.agg(F.max(F.size("q"))).first()[0] or 0
    blocks = cut_lineage(rows.mapInArrow(_pack_rows(dims, block_rows), BLOCKS), "dimension-lists")
    anchors = cut_lineage(blocks.mapInArrow(_anchor_rows(dims, every), ANCHORS), "anchors")
    out, parts = [], -(-anchors.count() // anchor_rows)
    for k in range(parts):
        some = anchors.where(F.pmod(F.xxhash64("ord"), F.lit(parts)) == k)
        got = sorted((r["vec_id"], r["ord"], r["label"], bytes(r["vector"])) for r in some.collect())     # about anchor_rows rows
        block = [(i, o, lab, np.frombuffer(v, np.int64)) for i, o, lab, v in got]
        if block:
            out.append(cut_lineage(_mine_block(blocks, block, dims, positives, negatives, low, high), "hard-negatives"))
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                                         "negative_score long")
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
