"""Random forest over tables whose rows repeat, as a ``pyspark.ml`` estimator and model.

MLlib's forest draws a number for every row and tree, keeps them beside the rows, and goes over all
rows and trees once a level. Rows with the same features and label need not be told apart: how
often a tree draws ``n`` of them, each by Poisson(1) as MLlib does, is Poisson(n). So Spark counts them once, and a
tree is grown in one task from the counts it has drawn, by the steps of ``boosting``.

A table of at most ``TASK_ROWS`` rows, one with more than ``FOREST_GROUPS`` distinct rows or fewer
than ``GROUP_ROWS`` rows of each, and any setting other than ``OWN`` go to MLlib's forest.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewise.operators import boosting as bo
from ridewise.session import cut_lineage

#: distinct rows at most, 32 bytes each, as every task that grows trees holds them all
FOREST_GROUPS = 2 ** 18
#: settings that trees grown here follow
OWN = {"featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "numTrees", "seed"}


class Forest(RandomForestRegressor):
    """MLlib's forest of ``featuresCol``, the assembled ``inputCols``."""

    def __init__(self, inputCols: list[str], **params):
        super().__init__(**params)
        self.inputCols = list(inputCols)

    def _fit(self, df: DataFrame):
        if self.getMaxBins() > bo.MAX_BINS or any(self.isSet(p) and p.name not in OWN for p in self.params):
            return super()._fit(df)
        names = [f"f{i}" for i in range(len(self.inputCols))]
        keys = [*names, "label"]
        rows = df.select(*[F.col(c).cast("double").alias(k) for c, k in zip([*self.inputCols, self.getLabelCol()], keys)])
        finite = functools.reduce(lambda a, b: a & b, [F.coalesce(F.abs(k) < float("inf"), F.lit(False)) for k in keys])     # NaN is above all
        count, about, bad = rows.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*keys)), F.count_if(~finite)).first()
        if count <= bo.TASK_ROWS or about > FOREST_GROUPS or bo.GROUP_ROWS * about > count or bad:
            return super()._fit(df)                                      # which refuses rows with a missing number
        groups = cut_lineage(bo.grouped(rows, keys).select(*keys, "weight", "mark"), "forest-groups")
        edges = bo.fit_bins(rows, names, self.getMaxBins(), groups, between=True)
        table = cut_lineage(groups.mapInArrow(bo._block_rows(edges, len(names)), bo.BLOCKS), "forest-blocks")
        n, (mean, spread) = self.getNumTrees(), _spread(groups)
        wanted = len(names) if n == 1 else -(-len(names) // 3)           # MLlib's choice for regression
        settings = Growth(len(names), max(map(len, edges)) + 1, wanted, self.getMaxDepth(), self.getSeed() % 2 ** 32, mean, spread)
        sc = df.sparkSession.sparkContext
        held = sc.broadcast([tuple(r) for r in table.collect()])         # at most some FOREST_GROUPS rows
        try:
            tasks = min(n, max(bo.DIRECT, bo.CORE_TASKS * sc.defaultParallelism))
            trees = sc.parallelize(range(n), tasks).mapPartitions(functools.partial(_grow_trees, settings, held)).collect()
        finally:
            held.destroy()
        for t in trees:
            share = sum(t.gain)                                          # each tree's gains count alike, as in MLlib
            t.gain = [g / share if share else 0.0 for g in t.gain]
            t.value = [(mean + spread * v) / n for v in t.value]
        return ForestModel(bo.model_arrays(edges, trees, 0.0)).with_params(inputCols=self.inputCols, outputCol=self.getPredictionCol())


def _spread(groups: DataFrame) -> tuple[float, float]:
    """The label's mean and deviation over all rows."""
    total = F.sum("weight")
    mean = groups.agg(F.sum(F.col("weight") * F.col("label")) / total).first()[0]
    var = groups.agg(F.sum(F.col("weight") * F.pow(F.col("label") - F.lit(mean), 2)) / total).first()[0]
    return mean, float(np.sqrt(var)) or 1.0


class ForestModel(bo.HistogramBoostingModel):
    """The mean of the trees, each leaf's value being its share of it; NaN and null count as the greatest value, as with MLlib."""
    missing = np.inf


@dataclass
class Growth:
    features: int
    width: int
    wanted: int                # features a node may be split by
    max_depth: int
    seed: int
    mean: float
    spread: float


def _grow_trees(s: Growth, held: Broadcast, turns: Iterator[int]) -> Iterator[bo.Tree]:
    blocks = [bo._unpack(r, s.features, 0.0, []) for r in held.value]
    bins = np.concatenate([b.bins for b in blocks], axis=1)
    label, count = (np.concatenate([getattr(b, k) for b in blocks]) for k in ("label", "weight"))
    order = np.lexsort((label, *bins))                                   # the same draws, whatever the order of the groups
    bins, label, count = np.ascontiguousarray(bins[:, order]), (label[order] - s.mean) / s.spread, count[order]
    for turn in turns:
        yield grow_tree(s, bins, label, count, turn)


def grow_tree(s: Growth, bins: np.ndarray, label: np.ndarray, count: np.ndarray, turn: int) -> bo.Tree:
    """The tree of a bootstrap: ``count`` rows of each group are drawn Poisson(1) times each; every node is split by one
    of ``wanted`` features of its own. With all margins 0, a leaf's value is the mean of its labels."""
    rng = np.random.RandomState([s.seed, turn])
    times = rng.poisson(count).astype(np.float64)
    at = np.flatnonzero(times)
    block = bo.Block(bins[:, at], label[at], times[at], np.empty(0, np.uint64), np.zeros(len(at)))
    columns, growing = np.arange(s.features), []

    def sums(tree: bo.Tree, nodes: list[int]) -> np.ndarray:
        slot = np.full(len(tree.feature), -1, dtype=np.int64)
        slot[nodes] = np.arange(len(nodes))
        job = bo.Pass([], tree.arrays(), slot, len(nodes), columns, s.width, turn, s.seed, 1.0, "squared", True, True)
        if not growing:
            growing.append(bo._Growing(job, block))
        out = np.zeros((bo._stats(job), job.slots, s.features, s.width))
        growing[0].add(job, out)
        return np.moveaxis(bo._whole(out), 1, 0)

    def draw(nodes: int) -> np.ndarray:
        return rng.rand(nodes, s.features).argsort(axis=1).argsort(axis=1) < s.wanted

    return bo.grow(sums, columns, s.max_depth, 0, 0.0, 0.0, 1, 1.0, draw)
