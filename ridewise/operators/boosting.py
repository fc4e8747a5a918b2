"""Gradient boosting on histograms, as a ``pyspark.ml`` estimator and model.

* Bins. Every feature gets at most ``maxBins`` bins, by its distinct values
  where they are few, else by quantiles. The training rows are written once as
  blocks of binned columns, one byte a value.
* Rounds. A tree grows level by level. One job a level sums gradients and
  Hessians per (node, feature, bin): every task adds up its own rows, each
  feature's sums of all tasks are added in one executor, and one histogram
  reaches the driver, whatever the number of rows and tasks. Of two siblings the
  smaller one is summed, the other is its parent minus that. Without weights, the
  Hessian of a squared error is the number of rows and is not summed apart.
* Leaf-wise growth (``maxLeaves``) is best-first: levels are grown ahead, and the
  tree keeps the splits that picking the best leaf again and again would take.
* Row state. A block holds the prediction of the trees up to some round, and
  newer trees are applied in the task. Every ``ADVANCE`` rounds the cached blocks
  are brought up to date, and every ``REBUILD`` rounds they are made anew from the
  checkpoint and all trees. So lineage stays short, nothing but that and
  the trees is needed, and a lost executor's blocks are made again from those.

Rows of a larger table that share all features, ``GROUP_ROWS`` or more on average, are one row each with their number
as its weight and their mean label (all rows counting alike, and no row sample): the sums of
gradients, Hessians and rows are the same, and a round costs as much as there are distinct rows.

A table of at most ``TASK_ROWS`` rows, or ``ALONE_CELLS`` numbers, is one task, which then grows all trees by
the same steps, as there are no sums to exchange; it keeps the gradients and the node
of every row from level to level.

The blocks are one cached RDD: some thousand short jobs run over the same
rows, and planning a DataFrame for each would take longer than the jobs.
Row and column samples are drawn by hash and seed, so a repeated task draws alike.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewise.operators.stages import ColumnOut, ColumnsIn, Param, Params, StageParams, TableEstimator, TableModel, TypeConverters
from ridewise.session import cut_lineage, shared_dir

BLOCK_ROWS = 65_536
ADVANCE, REBUILD = 4, 64
#: nodes that a byte can number, rows from which a tree is walked by whole columns
BYTE_NODES, LONG_COLUMN = 256, 1024
#: rows of a task at least, and tasks of a job for a core at most: a job's fixed cost grows with its tasks,
#: which go over their blocks one by one and so may hold any number of them
TASK_ROWS, CORE_TASKS = 131_072, 1
#: rows of a task at most for which fewer tasks are taken, if their histograms need not be added in executors then
FEW_TASK_ROWS = 2 ** 22
#: rows times features that are one task's after all: the exchange of sums would take longer than adding them up alone
ALONE_CELLS = 25_000_000
#: rows of a group at least, on average, for a larger table to be grouped by its features
GROUP_ROWS = 4
#: with more than twice so many partitions, or if a fit would so fetch more than so many bytes,
#: the tasks' histograms are added in executors first
DIRECT, DIRECT_BYTES = 8, 2 ** 28
#: tasks that add them, each a share of the features
ADDERS = 4
LEAST_GAIN = 1e-9
MAX_BINS = 255


# ------------------------------------------------------------------ bins

def fit_bins(df: DataFrame, features: list[str], max_bins: int, groups: DataFrame | None = None, between: bool = False) -> list[np.ndarray]:
    """Per feature the rising upper edges of all bins but the last; a value
    falls in the first bin whose edge is not below it. NaN and null: bin 0.

    ``groups`` is a table of the same distinct values with fewer rows; quantiles are always
    those of all rows. ``between``: where all values have a bin, edges lie halfway between them."""
    if not 2 <= max_bins <= MAX_BINS:
        raise ValueError(f"bins must number 2 to {MAX_BINS}")
    numbers = lambda t: t.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"x{i}") for i, c in enumerate(features)])
    x, every = numbers(df if groups is None else groups), range(len(features))
    share = [i / max_bins for i in range(1, max_bins)]
    quantiles = lambda ids: [F.percentile_approx(f"x{i}", share, 20_000).alias(f"q{i}") for i in ids]
    least = x.mapInArrow(_least_values(len(features), max_bins + 1), "i int, v double").groupBy("i").agg(
        F.slice(F.sort_array(F.collect_set("v")), 1, max_bins + 1).alias("v"))
    values = {i: np.empty(0) for i in every} | {r["i"]: np.unique(np.array(r["v"], dtype=np.float64)) for r in least.collect()}
    many = [i for i in every if len(values[i]) > max_bins]
    cut = numbers(df).agg(*quantiles(many)).first() if many else None                                 # only of features with many values
    out = []
    for i in every:
        if i in many:
            out.append(np.unique(np.array(cut[f"q{i}"], dtype=np.float64)))
            continue
        out.append((values[i][:-1] + values[i][1:]) / 2 if between else values[i][:-1])
    return out


def _least_values(n: int, most: int):
    """A task's least ``most`` distinct values of every column, as rows (column, value)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0)] * n
        for b in batches:
            for i in range(n):
                new = b.column(i).drop_null().unique().to_numpy(zero_copy_only=False)
                if len(held[i]) == most:
                    new = new[new < held[i][-1]]
                held[i] = np.unique(np.concatenate([held[i], new]))[:most]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(n, dtype=np.int32), [len(v) for v in held])), pa.array(np.concatenate(held))],
                                         names=["i", "v"])
    return run


def grouped(rows: DataFrame, keys: list[str], *sums) -> DataFrame:
    """One row for each distinct ``keys``: their number as ``weight``, other ``sums``, and a mark."""
    return rows.groupBy(*keys).agg(*sums, F.count(F.lit(1)).cast("double").alias("weight")).withColumn("mark", F.lit(0).cast("long"))


def to_bins(columns: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    """One row a feature, one byte a value."""
    out = np.empty((len(columns), len(columns[0]) if columns else 0), dtype=np.uint8)
    for j, (x, e) in enumerate(zip(columns, edges)):
        out[j] = np.where(np.isnan(x), 0, np.searchsorted(e, x, side="left"))
    return out


def _block_rows(edges: list[np.ndarray], n: int):
    """Rows (features..., label, weight, mark) packed into blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(lo, BLOCK_ROWS)
                col = [part.column(j).to_numpy(zero_copy_only=False).astype(np.float64) for j in range(n + 2)]
                data = (to_bins(col[:n], edges), col[n], col[n + 1], part.column(n + 2).to_numpy().view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in data],
                                                 names=["bins", "label", "weight", "mark"])
    return run


BLOCKS = "bins binary, label binary, weight binary, mark binary"


@dataclass
class Block:
    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray | None            # None: all are 1
    mark: np.ndarray | None
    margin: np.ndarray


def _unpack(row, features: int, start: float, trees: list, weights: bool = True, marks: bool = True) -> Block:
    """``weights``, ``marks``: whether the fit looks at them; what a block does not hold is not read in every job."""
    y, w, m = (np.frombuffer(row[c], t) for c, t in ((1, np.float64), (2, np.float64), (3, np.uint64)))
    bins = np.frombuffer(row[0], np.uint8).reshape(features, len(y))
    return Block(bins, y, w if weights else None, m if marks else None, margin_of(trees, bins, start))


# ------------------------------------------------------------------ trees

@dataclass
class Tree:
    """Nodes as parallel lists; a leaf has feature -1. Rows with ``bin <= cut`` go left."""
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> int:
        """The left child's number; the right one is the next."""
        first = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, first, gain
        for x, v in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.value, 0.0), (self.gain, 0.0)):
            x += [v, v]
        return first

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.feature, np.int16), np.array(self.cut, np.int16), np.array(self.left, np.int32), np.array(self.value))


def _levels(feature: np.ndarray, left: np.ndarray) -> int:
    """Splits on the longest way down; children have greater numbers than their parent."""
    depth = [0] * len(feature)
    for n in np.flatnonzero(feature >= 0).tolist():
        depth[left[n]] = depth[left[n] + 1] = depth[n] + 1
    return max(depth, default=0)


def _move(node: np.ndarray, bins: np.ndarray, tree: tuple[np.ndarray, ...], splits: np.ndarray) -> None:
    """Moves the rows at each of ``splits`` (rising) to its children: a whole column is compared at a time, one byte a value."""
    feature, cut, left, _ = tree
    kind = node.dtype.type
    for k, f, c, a in zip(splits.tolist(), feature[splits].tolist(), cut[splits].tolist(), left[splits].tolist()):
        step = (bins[f] > c).astype(kind)
        step += kind(a - k)
        step *= node == k
        node += step


def leaf_of(tree: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """The leaf of every row."""
    feature, cut, left, _ = tree
    n = bins.shape[1]
    if LONG_COLUMN <= n and len(feature) <= BYTE_NODES:
        node = np.zeros(n, dtype=np.uint8)
        _move(node, bins, tree, np.flatnonzero(feature >= 0))
        return node
    node = np.zeros(n, dtype=np.intp)
    if feature[0] < 0:
        return node
    # a leaf is its own child, so all rows take as many steps; no bin is above 255
    leaf = feature < 0
    start = np.where(leaf, 0, feature).astype(np.intp) * n
    cut = np.where(leaf, 255, cut).astype(np.uint8)
    left = np.where(leaf, np.arange(len(feature)), left).astype(np.intp)
    flat, rows = np.ascontiguousarray(bins).ravel(), np.arange(n)
    for _ in range(_levels(feature, left)):
        node = left.take(node) + (flat.take(start.take(node) + rows) > cut.take(node))
    return node


def margin_of(trees, bins: np.ndarray, start) -> np.ndarray:
    out = np.array(start, dtype=np.float64) if np.ndim(start) else np.full(bins.shape[1], float(start))
    for t in trees:
        out += t[3].take(leaf_of(t, bins).astype(np.intp, copy=False))
    return out


def _drawn(mark: np.ndarray, turn: int, seed: int, rate: float) -> np.ndarray:
    """Rows of this round's sample."""
    with np.errstate(over="ignore"):
        h = (mark ^ np.uint64((turn * 0x9E3779B97F4A7C15 + seed * 0xD1342543DE82EF95) & (2 ** 64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(11)).astype(np.float64) < rate * 2 ** 53


@dataclass
class Pass:
    """What one job needs: trees newer than the blocks' margins, the growing
    tree, and which of its nodes to sum (``slot`` of the others is -1)."""
    trees: list
    tree: tuple
    slot: np.ndarray
    slots: int
    columns: np.ndarray
    width: int
    turn: int
    seed: int
    rate: float
    objective: str
    unit: bool = False                   # all weights are 1, or numbers of rows
    grouped: bool = False                # a weight is a number of rows


def gradients(objective: str, margin, label, weight) -> tuple[np.ndarray, np.ndarray | None]:
    """Gradients and Hessians; without weights (None) the Hessian of a squared error is 1 and None."""
    if objective == "squared":
        return (margin - label if weight is None else weight * (margin - label)), weight
    p = 1.0 / (1.0 + np.exp(-margin))
    g, h = p - label, np.maximum(p * (1.0 - p), 1e-16)
    return (g, h) if weight is None else (weight * g, weight * h)


def _add_rows(out: np.ndarray, job: Pass, bins: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray | None, n: np.ndarray | None) -> None:
    """Adds a block's rows to ``out`` by their slots (-1: left out): gradients, Hessians (if ``out`` has them) and numbers of rows (None: 1)."""
    rows, cells = np.flatnonzero(slot >= 0), out.shape[1] * job.width
    if not len(rows):
        return
    some = len(rows) < len(slot)
    base = slot.take(rows) * job.width if out.shape[1] > 1 else None
    stats = [v if v is None or not some else v.take(rows) for v in ((g, h, n) if len(out) == 3 else (g, n))]
    for j, c in enumerate(job.columns):
        at = (bins[c].take(rows) if some else bins[c]).astype(np.intp)
        if base is not None:
            at += base
        for s, v in enumerate(stats):
            out[s, :, j] += np.bincount(at, v, cells).reshape(-1, job.width)


def _whole(out: np.ndarray) -> np.ndarray:
    """Sums (gradient, Hessian, rows), the Hessian being the rows where it was left out."""
    return out if len(out) == 3 else out[[0, 1, 1]]


def _stats(job: Pass) -> int:
    return 2 if job.unit and job.objective == "squared" else 3


def _sum_blocks(job: Pass, blocks) -> Iterator[np.ndarray]:
    """Sums (gradient, Hessian if it is not 1, rows) by (slot, column, bin) over a task's blocks."""
    out = np.zeros((_stats(job), job.slots, len(job.columns), job.width))
    for b in blocks:
        slot = job.slot.take(leaf_of(job.tree, b.bins).astype(np.intp, copy=False))
        if job.rate < 1:
            slot[~_drawn(b.mark, job.turn, job.seed, job.rate)] = -1
        g, h = gradients(job.objective, margin_of(job.trees, b.bins, b.margin), b.label, b.weight)
        _add_rows(out, job, b.bins, slot, g, h, b.weight if job.grouped else None)
    yield out


def _by_column(out: np.ndarray) -> list[tuple[int, np.ndarray]]:
    return [(j, np.ascontiguousarray(out[:, :, j])) for j in range(out.shape[2])]


def _sums(blocks, job: Pass, direct: bool = False) -> np.ndarray:
    part = blocks.mapPartitions(functools.partial(_sum_blocks, job))
    if direct:
        return _whole(sum(part.collect()))
    added = part.flatMap(_by_column).reduceByKey(np.add, min(ADDERS, len(job.columns))).collect()      # one histogram in all
    return _whole(np.stack([x for _, x in sorted(added, key=lambda kv: kv[0])], axis=2))


@dataclass
class Split:
    gain: float
    column: int
    cut: int
    left: np.ndarray           # gradient, Hessian, rows
    total: np.ndarray


def best_splits(hist: np.ndarray, l2: float, least_hessian: float, least_rows: float, allowed: np.ndarray | None = None) -> list[Split]:
    """The best split of each node's ``(3, columns, bins)`` sums: greatest gain,
    then first column, then lowest cut. Gain 0 if none is allowed; ``allowed`` has a node's columns."""
    total = hist[:, :, 0, :].sum(axis=2)
    left = np.cumsum(hist, axis=3)[:, :, :, :-1]
    right = total[:, :, None, None] - left
    lg, lh, ln = left[:, 0], left[:, 1], left[:, 2]
    rg, rh, rn = right[:, 0], right[:, 1], right[:, 2]
    ok = (ln >= least_rows) & (rn >= least_rows) & (ln > 0) & (rn > 0) & (lh >= least_hessian) & (rh >= least_hessian)
    if allowed is not None:
        ok &= allowed[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = total[:, 0] * total[:, 0] / (total[:, 1] + l2)
        gain = lg * lg / (lh + l2) + rg * rg / (rh + l2) - whole[:, None, None]
    gain = np.where(ok, gain, 0.0)
    if not gain[0].size:
        return [Split(0.0, 0, 0, t, t) for t in total]
    at = gain.reshape(len(gain), -1).argmax(axis=1)
    return [Split(float(gain[i, c, k]), int(c), int(k), left[i, :, c, k].copy(), total[i])
            for i, (c, k) in enumerate(zip(*np.unravel_index(at, gain.shape[1:])))]


def grow(sums, columns: np.ndarray, max_depth: int, max_leaves: int, l2: float, least_hessian: float, least_rows: float,
         rate: float, draw=lambda nodes: None) -> Tree:
    """One tree. ``sums(tree, nodes)`` gives the histograms of leaves of ``tree``, ``draw(nodes)`` the columns so many
    nodes may be split by (None: all)."""
    ahead, depth = Tree(), {0: 0}
    root = sums(ahead, [0])
    hist, best = {0: root[0]}, {0: best_splits(root, l2, least_hessian, least_rows, draw(1))[0]}
    open_ = [0]
    while True:
        chosen, unknown = _best_first(ahead, best, max_leaves) if max_leaves else (None, True)
        todo = [n for n in open_ if best[n].gain > LEAST_GAIN and depth[n] < max_depth]
        if not unknown or not todo:
            break
        pairs = []
        for n in todo:
            s = best[n]
            a = ahead.split(n, int(columns[s.column]), s.cut, s.gain)
            depth[a] = depth[a + 1] = depth[n] + 1
            pairs.append((n, a, a + 1) if s.left[2] <= s.total[2] - s.left[2] else (n, a + 1, a))
        if depth[pairs[0][1]] < max_depth:
            open_ = [k for _, *both in pairs for k in both]
            got = np.empty((len(open_), *root.shape[1:]))
            got[0::2] = sums(ahead, open_[0::2])
            for i, (n, _, _) in enumerate(pairs):
                np.subtract(hist.pop(n), got[2 * i], out=got[2 * i + 1])
            hist |= zip(open_, got)
            best |= zip(open_, best_splits(got, l2, least_hessian, least_rows, draw(len(open_))))
        else:
            for n, small, large in pairs:
                s = best[n]
                lo, hi = min(small, large), max(small, large)
                best[lo], best[hi] = (Split(0.0, 0, 0, t, t) for t in (s.left, s.total - s.left))
            open_ = []
    out = Tree()
    keep = chosen if max_leaves else None
    stack = [(0, 0)]
    while stack:
        old, new = stack.pop()
        if ahead.feature[old] >= 0 and (keep is None or old in keep):
            first = out.split(new, ahead.feature[old], ahead.cut[old], ahead.gain[old])
            stack += [(ahead.left[old], first), (ahead.left[old] + 1, first + 1)]
        g, h, _ = best[old].total
        out.value[new] = -rate * g / (h + l2) if h + l2 > 0 else 0.0
    return out


def _best_first(tree: Tree, best: dict[int, Split], max_leaves: int) -> tuple[set[int], bool]:
    """Nodes that best-first growth splits, and whether it ran into a leaf whose
    children are not known yet."""
    chosen, leaves = set(), [0]
    while len(leaves) < max_leaves:
        n = max(leaves, key=lambda k: (best[k].gain, -k))
        if best[n].gain <= LEAST_GAIN:
            return chosen, False
        if tree.feature[n] < 0:
            return chosen, True
        chosen.add(n)
        leaves.remove(n)
        leaves += [tree.left[n], tree.left[n] + 1]
    return chosen, False


# ------------------------------------------------------------------ estimator and model

def task_count(rows: int, cores: int) -> int:
    return min(-(-rows // TASK_ROWS), max(DIRECT, CORE_TASKS * cores))


class BoostingParams(ColumnsIn, ColumnOut, StageParams):
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "row weight", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "row key, for row samples", TypeConverters.toString)
    objective = Param(Params._dummy(), "objective", "squared or logistic", TypeConverters.toString)
    rounds = Param(Params._dummy(), "rounds", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "greatest depth of a leaf", TypeConverters.toInt)
    maxLeaves = Param(Params._dummy(), "maxLeaves", "best-first growth up to so many leaves; 0: by levels", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of a leaf's value that counts", TypeConverters.toFloat)
    rowShare = Param(Params._dummy(), "rowShare", "share of rows drawn for a tree", TypeConverters.toFloat)
    columnShare = Param(Params._dummy(), "columnShare", "share of features drawn for a tree", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "added to a leaf's Hessian", TypeConverters.toFloat)
    leastHessian = Param(Params._dummy(), "leastHessian", "least Hessian of a leaf", TypeConverters.toFloat)
    leastRows = Param(Params._dummy(), "leastRows", "least rows of a leaf", TypeConverters.toInt)
    start = Param(Params._dummy(), "start", "margin before the first tree; default: the best constant", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the samples", TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(outputCol="prediction", objective="squared", rounds=100, maxDepth=6, maxLeaves=0, rate=0.1, rowShare=1.0,
                         columnShare=1.0, maxBins=64, l2=0.0, leastHessian=0.0, leastRows=1, seed=42)


class HistogramBoosting(TableEstimator, BoostingParams):
    """Boosted trees; ``outputCol`` is the value, or with the logistic objective
    the probability of label 1.

    Null or NaN features count as the smallest value, rows with a null label
    take no part, a null weight is 1. An empty table gives the constant 0.
    """

    def __init__(self, **kw):
        super().__init__()
        self.with_params(**kw)

    def _fit(self, df: DataFrame) -> "HistogramBoostingModel":
        get = lambda name: self.getOrDefault(name)
        features, spark = self.getInputCols(), df.sparkSession
        if get("objective") not in ("squared", "logistic"):
            raise ValueError(get("objective"))
        weight = F.coalesce(F.col(get("weightCol")).cast("double"), F.lit(1.0)) if self.isDefined("weightCol") else F.lit(1.0)
        mark = F.xxhash64(F.col(get("keyCol"))) if self.isDefined("keyCol") else F.xxhash64(*features, get("labelCol"))
        rows = df.where(F.col(get("labelCol")).isNotNull()).select(
            *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)], F.col(get("labelCol")).cast("double").alias("label"),
            weight.alias("weight"), mark.alias("mark"))
        names = [f"f{i}" for i in range(len(features))]
        alike = not self.isDefined("weightCol") and get("rowShare") >= 1
        total = rows.agg(F.sum(F.col("label") * F.col("weight")), F.sum("weight"), F.count(F.lit(1)),
                         F.approx_count_distinct(F.xxhash64(*names)) if alike else F.count(F.lit(1))).first()
        count, groups = total[2], None
        if TASK_ROWS < count and GROUP_ROWS * total[3] <= count:
            sums = F.sum("label") / F.count(F.lit(1))
            groups = cut_lineage(grouped(rows, names, sums.alias("label")).select(*rows.columns), "boosting-groups")
            count = groups.count()
        edges = fit_bins(rows, names, get("maxBins"), groups)
        mean = total[0] / total[1] if total[1] else 0.0
        if self.isDefined("start"):
            start = get("start")
        elif get("objective") == "squared" or not 0 < mean < 1:
            start = mean if get("objective") == "squared" else 0.0
        else:
            start = float(np.log(mean / (1 - mean)))
        table = cut_lineage((rows if groups is None else groups).mapInArrow(_block_rows(edges, len(features)), BLOCKS), "boosting-blocks")
        tasks = task_count(count, spark.sparkContext.defaultParallelism)
        few = DIRECT_BYTES // max(1, self._settings(edges, groups is not None).histogram_bytes())
        if count * len(features) <= ALONE_CELLS:
            tasks = 1
        elif DIRECT // 2 <= few < tasks and count <= few * FEW_TASK_ROWS:
            tasks = few
        trees = self._grow_all(table, edges, start, tasks, groups is not None) if total[1] else []
        return self._model(HistogramBoostingModel, model_arrays(edges, trees, start))

    def _settings(self, edges: list[np.ndarray], grouped: bool) -> "Settings":
        get = self.getOrDefault
        return Settings(len(edges), max((len(e) for e in edges), default=0) + 1, *(get(k) for k in (
            "rounds", "seed", "columnShare", "rowShare", "objective", "maxDepth", "maxLeaves", "l2", "leastHessian", "leastRows", "rate")),
                        not self.isDefined("weightCol"), grouped)

    def _grow_all(self, table: DataFrame, edges: list[np.ndarray], start: float, tasks: int, grouped: bool = False) -> list[Tree]:
        settings = self._settings(edges, grouped)
        unpack = lambda trees: functools.partial(_unpack, features=len(edges), start=start, trees=trees,
                                                 weights=grouped or not settings.unit, marks=settings.row_share < 1)
        if tasks == 1:                                                   # one task's rows: no sums to exchange
            return table.rdd.coalesce(1).map(tuple).map(unpack([])).mapPartitions(functools.partial(_boost_in_task, settings)).collect()
        shared_dir(table.sparkSession)                                   # the folder checkpoint() writes to
        packed = table.rdd.coalesce(tasks).map(tuple)
        packed.checkpoint()
        packed.count()                                                   # from here on tasks carry no query plan
        direct = tasks <= 2 * DIRECT and tasks * settings.histogram_bytes() <= DIRECT_BYTES
        held, done, fresh = [packed.map(unpack([])).persist(StorageLevel.MEMORY_AND_DISK)], [], []

        def sums(job):
            job.trees = fresh
            return _sums(held[-1], job, direct)

        trees = []
        try:
            for tree in boost(settings, sums):
                trees.append(tree)
                fresh = fresh + [tree.arrays()]
                while len(held) > 1:                                     # the last job has made its successor
                    held.pop(0).unpersist()
                if len(trees) % ADVANCE == 0:
                    done, new, fresh = done + fresh, fresh, []
                    held.append((packed.map(unpack(done)) if len(trees) % REBUILD == 0 else held[-1].map(functools.partial(_advance, new)))
                                .persist(StorageLevel.MEMORY_AND_DISK))
        finally:
            for x in held:
                x.unpersist()
        return trees


@dataclass
class Settings:
    features: int
    width: int
    rounds: int
    seed: int
    column_share: float
    row_share: float
    objective: str
    max_depth: int
    max_leaves: int
    l2: float
    least_hessian: float
    least_rows: int
    rate: float
    unit: bool = False
    grouped: bool = False

    def histogram_bytes(self) -> int:
        """Of all levels of all trees at most, from one task."""
        return 8 * (2 if self.unit and self.objective == "squared" else 3) * self.features * self.width * 2 ** (self.max_depth - 1) * self.rounds


def boost(s: Settings, sums) -> Iterator[Tree]:
    """The trees, one by one; ``sums`` gives the histograms of a ``Pass``."""
    rng = np.random.RandomState(s.seed)
    for turn in range(s.rounds):
        columns = np.sort(rng.permutation(s.features)[:max(1, round(s.column_share * s.features))])

        def of_nodes(tree, nodes):
            slot = np.full(len(tree.feature), -1, dtype=np.int64)
            slot[nodes] = np.arange(len(nodes))
            job = Pass([], tree.arrays(), slot, len(nodes), columns, s.width, turn, s.seed, s.row_share, s.objective, s.unit, s.grouped)
            return np.moveaxis(sums(job), 1, 0)

        yield grow(of_nodes, columns, s.max_depth, s.max_leaves, s.l2, s.least_hessian, s.least_rows, s.rate)


class _Growing:
    """A task's block while a tree grows: the drawn rows' bins, gradients and nodes."""

    def __init__(self, job: Pass, b: Block):
        rows = np.flatnonzero(_drawn(b.mark, job.turn, job.seed, job.rate)) if job.rate < 1 else None
        of = lambda x: x if rows is None or x is None else x.take(rows, axis=-1)
        self.bins, weight = np.ascontiguousarray(of(b.bins)), of(b.weight)
        self.g, self.h = gradients(job.objective, of(b.margin), of(b.label), weight)
        self.n = weight if job.grouped else None
        self.node, self.known = np.zeros(len(self.g), dtype=np.uint8), 1

    def add(self, job: Pass, out: np.ndarray) -> None:
        feature, left = job.tree[0], job.tree[2]
        if len(feature) > BYTE_NODES:
            self.node = self.node.astype(np.uint32, copy=False)
        _move(self.node, self.bins, job.tree, np.flatnonzero((feature >= 0) & (left >= self.known)))       # splits made since
        self.known = len(feature)
        _add_rows(out, job, self.bins, job.slot.take(self.node.astype(np.intp)), self.g, self.h, self.n)


def _boost_in_task(settings: Settings, blocks: Iterator[Block]) -> Iterator[Tree]:
    held, growing = list(blocks), []                                     # at most TASK_ROWS rows

    def sums(job: Pass) -> np.ndarray:
        if len(job.tree[0]) == 1:                                        # the root: a new tree
            growing[:] = [_Growing(job, b) for b in held]
        out = np.zeros((_stats(job), job.slots, len(job.columns), job.width))
        for x in growing:
            x.add(job, out)
        return _whole(out)

    for tree in boost(settings, sums):
        yield tree
        held = [_advance([tree.arrays()], b) for b in held]


def _advance(trees, block: Block) -> Block:
    return Block(block.bins, block.label, block.weight, block.mark, margin_of(trees, block.bins, block.margin))


def model_arrays(edges: list[np.ndarray], trees: list[Tree], start: float) -> dict[str, np.ndarray]:
    size = np.array([len(t.feature) for t in trees], dtype=np.int32)
    flat = lambda name, t: np.array([x for tree in trees for x in getattr(tree, name)], dtype=t)
    return {"edges": np.concatenate(edges) if edges else np.empty(0), "edge_count": np.array([len(e) for e in edges], dtype=np.int32),
            "size": size, "feature": flat("feature", np.int16), "cut": flat("cut", np.int16), "left": flat("left", np.int32),
            "value": flat("value", np.float64), "gain": flat("gain", np.float64), "start": np.array([start])}


class HistogramBoostingModel(TableModel, BoostingParams):
    #: what a null or NaN feature counts as; NaN has bin 0
    missing = np.nan

    @property
    def edges(self) -> list[np.ndarray]:
        return np.split(self.arrays["edges"], np.cumsum(self.arrays["edge_count"])[:-1]) if len(self.arrays["edge_count"]) else []

    @property
    def trees(self) -> list[tuple[np.ndarray, ...]]:
        cut = np.cumsum(self.arrays["size"])[:-1]
        parts = [np.split(self.arrays[k], cut) for k in ("feature", "cut", "left", "value")]
        return list(zip(*parts)) if len(self.arrays["size"]) else []

    @property
    def importances(self) -> np.ndarray:
        """Share of the total gain by feature."""
        out = np.zeros(len(self.arrays["edge_count"]))
        inner = self.arrays["feature"] >= 0
        np.add.at(out, self.arrays["feature"][inner], self.arrays["gain"][inner])
        return out / out.sum() if out.sum() > 0 else out

    def nodes(self, df: DataFrame) -> DataFrame:
        """The trees as a table: tree, node, feature, threshold (rows up to it go left), left, right, gain, value."""
        rows, names, edges = [], self.getInputCols(), self.edges
        gain = np.split(self.arrays["gain"], np.cumsum(self.arrays["size"])[:-1])
        for t, (feature, cut, left, value) in enumerate(self.trees):
            for n, f in enumerate(feature.tolist()):
                inner = f >= 0
                rows.append((t, n, names[f] if inner else None, float(edges[f][cut[n]]) if inner else None,
                             int(left[n]) if inner else None, int(left[n]) + 1 if inner else None,
                             float(gain[t][n]) if inner else None, None if inner else float(value[n])))
        return df.sparkSession.createDataFrame(rows, "tree int, node int, feature string, threshold double, left int, right int, "
                                                     "gain double, value double")

    def _transform(self, df: DataFrame) -> DataFrame:
        edges, trees, start = self.edges, self.trees, float(self.arrays["start"][0])
        logistic, missing = self.getOrDefault("objective") == "logistic", self.missing

        @F.pandas_udf(T.DoubleType())
        def score(*columns: pd.Series) -> pd.Series:
            bins = to_bins([c.to_numpy(dtype=np.float64, na_value=missing) for c in columns], edges)
            out = margin_of(trees, bins, start)
            return pd.Series(1.0 / (1.0 + np.exp(-out)) if logistic else out)

        return df.withColumn(self.getOutputCol(), score(*[F.col(c).cast("double") for c in self.getInputCols()]))
