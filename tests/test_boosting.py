"""Histogram boosting against a plain version, and its stored form."""

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ridewise.operators import boosting as bo
from ridewise.session import scratch_path


def frame(spark, n=900, seed=3, parts=3):
    rng = np.random.RandomState(seed)
    x = np.column_stack([rng.randint(0, 7, n), rng.randint(0, 5, n), rng.rand(n).round(2), rng.randint(0, 2, n)]).astype(float)
    y = np.floor(3 * x[:, 0] - 2 * x[:, 1] * (x[:, 2] > 0.5) + 5 * x[:, 3] + rng.randint(0, 3, n))
    rows = [(i, *map(float, r), float(v), float(v > 12), float(1 + i % 3)) for i, (r, v) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double, k double, w double").repartition(parts)


def plain_tree(x, g, h, depth, l2, rate):
    """A tree by definition: all values of all features as thresholds."""
    def value():
        return -rate * g.sum() / (h.sum() + l2)
    best = (1e-9, None, None)
    for f in range(x.shape[1]) if depth else ():
        for t in np.unique(x[:, f])[:-1]:
            m = x[:, f] <= t
            gain = (g[m].sum() ** 2 / (h[m].sum() + l2) + g[~m].sum() ** 2 / (h[~m].sum() + l2) - g.sum() ** 2 / (h.sum() + l2))
            if gain > best[0]:
                best = (gain, f, t)
    if best[1] is None:
        return lambda z, v=value(): np.full(len(z), v)
    _, f, t = best
    m = x[:, f] <= t
    lo, hi = plain_tree(x[m], g[m], h[m], depth - 1, l2, rate), plain_tree(x[~m], g[~m], h[~m], depth - 1, l2, rate)
    return lambda z: np.where(z[:, f] <= t, lo(z), hi(z))


COLS = ["a", "b", "c", "d"]


def scores(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy("id").select(model.getOutputCol()).collect()])


@pytest.mark.parametrize("objective,label,weight", [("squared", "y", None), ("logistic", "k", None), ("logistic", "k", "w")])
def test_rounds_equal_a_plain_version(spark, objective, label, weight):
    x, y, df = frame(spark)
    target = y if label == "y" else (y > 12).astype(float)
    w = np.ones(len(y)) if weight is None else 1.0 + np.arange(len(y)) % 3
    margin = np.zeros(len(y))
    for _ in range(5):
        g, h = bo.gradients(objective, margin, target, w)
        margin = margin + plain_tree(x, g, h, 3, 1.0, 0.3)(x)
    kw = {"weightCol": weight} if weight else {}
    m = bo.HistogramBoosting(inputCols=COLS, labelCol=label, objective=objective, rounds=5, maxDepth=3, rate=0.3, l2=1.0, start=0.0,
                             maxBins=255, keyCol="id", **kw).fit(df)
    want = margin if objective == "squared" else 1 / (1 + np.exp(-margin))
    assert np.allclose(scores(m, df), want, atol=1e-9)


@pytest.mark.parametrize("kw", [{}, {"maxLeaves": 6, "leastRows": 5}, {"rowShare": 0.6, "columnShare": 0.5}])
def test_one_task_and_many_grow_the_same_trees(spark, monkeypatch, kw):
    _, _, df = frame(spark)
    est = bo.HistogramBoosting(inputCols=COLS, labelCol="y", keyCol="id", rounds=9, maxDepth=4, rate=0.2, l2=0.5, **kw)
    whole = est.fit(df)
    monkeypatch.setattr(bo, "TASK_ROWS", 200)
    monkeypatch.setattr(bo, "BLOCK_ROWS", 150)
    monkeypatch.setattr(bo, "ADVANCE", 2)
    monkeypatch.setattr(bo, "REBUILD", 4)
    many = est.fit(df)
    for k in ("feature", "cut", "left", "size"):
        assert np.array_equal(whole.arrays[k], many.arrays[k]), k
    assert np.allclose(whole.arrays["value"], many.arrays["value"], atol=1e-9)
    monkeypatch.setattr(bo, "DIRECT", 2)                     # sums added in executors
    again = est.fit(df)
    assert np.array_equal(whole.arrays["cut"], again.arrays["cut"])


def test_best_first_takes_the_largest_gains():
    rng = np.random.RandomState(1)
    bins = rng.randint(0, 12, (3, 4000)).astype(np.uint8)
    y = np.where(bins[0] > 5, bins[1] * 2.0, 0) + rng.rand(4000)
    block = bo.Block(bins, y, np.ones(4000), np.arange(4000, dtype=np.uint64), np.zeros(4000))
    cols = np.arange(3)

    def sums(tree, nodes):
        slot = np.full(len(tree.feature), -1)
        slot[nodes] = np.arange(len(nodes))
        return np.moveaxis(next(bo._sum_blocks(bo.Pass([], tree.arrays(), slot, len(nodes), cols, 12, 0, 1, 1.0, "squared"), [block])), 1, 0)

    full = bo.grow(sums, cols, 6, 0, 0.0, 0.0, 1, 1.0)
    for leaves in (2, 5, 9):
        t = bo.grow(sums, cols, 6, leaves, 0.0, 0.0, 1, 1.0)
        assert sum(f < 0 for f in t.feature) == leaves
        # greedily by hand over the full tree's gains
        open_, gains = [0], []
        while len(gains) < leaves - 1:
            n = max((k for k in open_ if full.feature[k] >= 0), key=lambda k: full.gain[k])
            gains.append(full.gain[n])
            open_.remove(n)
            open_ += [full.left[n], full.left[n] + 1]
        assert np.allclose(sorted(g for f, g in zip(t.feature, t.gain) if f >= 0), sorted(gains))


def test_stored_in_a_pipeline_and_loaded(spark):
    _, _, df = frame(spark)
    m = bo.HistogramBoosting(inputCols=COLS, labelCol="y", rounds=4, maxDepth=3).fit(df)
    path = scratch_path(spark, "boosted")
    PipelineModel([m]).save(path)
    back = PipelineModel.load(path)
    assert np.array_equal(scores(back.stages[0], df), scores(m, df))
    assert back.stages[0].getInputCols() == COLS and back.stages[0].uid == m.uid
    assert abs(m.importances.sum() - 1) < 1e-12


def test_nulls_empty_and_constant(spark):
    _, _, df = frame(spark, 60)
    bad = df.withColumn("a", F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("a"))) \
            .withColumn("y", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("y")))
    m = bo.HistogramBoosting(inputCols=COLS, labelCol="y", rounds=3, maxDepth=2).fit(bad)
    assert np.isfinite(scores(m, bad)).all()
    assert set(scores(bo.HistogramBoosting(inputCols=COLS, labelCol="y", rounds=3).fit(df.limit(0)), df)) == {0.0}
    flat = df.withColumn("y", F.lit(4.0))
    assert set(scores(bo.HistogramBoosting(inputCols=COLS, labelCol="y", rounds=3).fit(flat), df)) == {4.0}
    with pytest.raises(ValueError):
        bo.fit_bins(df, ["a"], 300)


def test_quantile_bins_hold_similar_shares(spark):
    df = spark.range(20_000).select((F.col("id") * F.col("id")).cast("double").alias("x"))
    edges = bo.fit_bins(df, ["x"], 32)[0]
    share = np.bincount(np.searchsorted(edges, np.arange(20_000.0) ** 2, side="left"), minlength=32) / 20_000
    assert len(edges) == 31 and share.max() < 0.04


def _blocks(n=6000, block=500):
    rng = np.random.RandomState(4)
    bins = rng.randint(0, 20, (5, n)).astype(np.uint8)
    y = bins[0] * 2.0 + rng.rand(n)
    return [bo.Block(bins[:, i:i + block].copy(), y[i:i + block], np.ones(block), np.arange(i, i + block, dtype=np.uint64), np.zeros(block))
            for i in range(0, n, block)]


def test_one_task_makes_gradients_once_a_tree(monkeypatch):
    calls, gradients = [], bo.gradients
    monkeypatch.setattr(bo, "gradients", lambda *a: calls.append(1) or gradients(*a))
    settings = bo.Settings(5, 20, 3, 42, 1.0, 0.7, "squared", 5, 0, 1.0, 0.0, 1, 0.3)
    trees = list(bo._boost_in_task(settings, iter(_blocks())))
    assert max(len(t.feature) for t in trees) > 31 and len(calls) == 3 * 12


@pytest.mark.parametrize("unit", [False, True])
def test_one_histogram_reaches_the_driver(spark, monkeypatch, unit):
    blocks, columns = _blocks(), np.array([0, 2, 4])
    tree = bo.Tree()
    tree.split(0, 0, 9, 1.0)
    job = bo.Pass([], tree.arrays(), np.array([-1, 0, 1]), 2, columns, 20, 0, 1, 0.5, "squared", *([True] if unit else []))
    want = bo._whole(sum(next(bo._sum_blocks(job, [b])) for b in blocks))
    rdd = spark.sparkContext.parallelize(blocks, 6)
    fetched, collect = [], type(rdd).collect
    size = lambda x: x.nbytes if isinstance(x, np.ndarray) else sum(map(size, x)) if isinstance(x, (list, tuple)) else 0
    monkeypatch.setattr(RDD, "collect", lambda self: fetched.append(collect(self)) or fetched[-1])
    got = bo._sums(rdd, job)
    assert got.shape == (3, 2, 3, 20) and np.allclose(got, want)
    assert size(fetched) <= want.nbytes                      # six tasks, one histogram


def test_leaves_of_uneven_trees():
    rng = np.random.RandomState(2)
    bins = rng.randint(0, 256, (3, 700)).astype(np.uint8)
    tree = bo.Tree()
    a = tree.split(0, 1, 100, 1.0)
    b = tree.split(a + 1, 2, 254, 1.0)
    tree.split(b, 0, 30, 1.0)
    want = [a if x[1] <= 100 else b + 1 if x[2] > 254 else b + 2 if x[0] <= 30 else b + 3 for x in bins.T]
    assert bo.leaf_of(tree.arrays(), bins).tolist() == want
    assert bo.leaf_of(bo.Tree().arrays(), bins).tolist() == [0] * 700


def test_tasks_of_a_fit_do_not_grow_with_the_rows():
    from ridewise.operators.boosting import CORE_TASKS, DIRECT, TASK_ROWS, task_count
    assert [task_count(n, 12) for n in (1, TASK_ROWS, TASK_ROWS + 1)] == [1, 1, 2]
    assert task_count(29_000_000, 12) == task_count(290_000_000, 12) == max(DIRECT, 12 * CORE_TASKS)


def test_few_numbers_exchange_no_sums(spark, monkeypatch):
    _, _, df = frame(spark)
    est = bo.HistogramBoosting(inputCols=COLS, labelCol="y", keyCol="id", rounds=9, maxDepth=4, rate=0.2, l2=0.5, rowShare=0.6)
    monkeypatch.setattr(bo, "TASK_ROWS", 200)                # five tasks
    jobs, sums = [], bo._sums
    monkeypatch.setattr(bo, "_sums", lambda *a: jobs.append(1) or sums(*a))
    alone = est.fit(df)
    assert not jobs
    monkeypatch.setattr(bo, "ALONE_CELLS", 0)
    for k, v in (("BLOCK_ROWS", 150), ("ADVANCE", 2), ("REBUILD", 4), ("DIRECT", 2)):
        monkeypatch.setattr(bo, k, v)
    many = est.fit(df)
    assert len(jobs) >= 9
    for k in ("feature", "cut", "left", "size"):
        assert np.array_equal(alone.arrays[k], many.arrays[k]), k
    assert np.allclose(alone.arrays["value"], many.arrays["value"], atol=1e-9)


@pytest.mark.parametrize("depth", [3, 9])
def test_columns_walk_trees_as_rows_do(monkeypatch, depth):
    rng = np.random.RandomState(depth)
    bins = rng.randint(0, 256, (4, 5000)).astype(np.uint8)
    tree, open_ = bo.Tree(), [(0, 0)]
    while open_:
        n, d = open_.pop()
        if d < depth and rng.rand() < 0.9:
            a = tree.split(n, rng.randint(4), rng.randint(255), 1.0)
            open_ += [(a, d + 1), (a + 1, d + 1)]
    got = bo.leaf_of(tree.arrays(), bins)
    monkeypatch.setattr(bo, "LONG_COLUMN", 10 ** 9)
    assert np.array_equal(got, bo.leaf_of(tree.arrays(), bins))


def test_quantiles_are_asked_of_features_with_many_values_only(spark, monkeypatch):
    df = spark.range(3000).repartition(5).select((F.col("id") % 30).cast("double").alias("a"), F.col("id").cast("double").alias("b"),
                                                 F.when(F.col("id") % 3 > 0, F.col("id") % 16 - 8.0).alias("c"), F.lit(None).cast("double").alias("d"))
    asked, quantiles = [], F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda c, *a: asked.append(c) or quantiles(c, *a))
    edges = bo.fit_bins(df, ["a", "b", "c", "d"], 30)
    assert asked == ["x1"]
    assert edges[0].tolist() == list(range(29)) and edges[2].tolist() == list(range(-8, 7)) and not len(edges[3]) and len(edges[1]) == 29


def test_fewer_tasks_where_their_histograms_need_no_adding(spark, monkeypatch):
    _, _, df = frame(spark)
    est = bo.HistogramBoosting(inputCols=COLS, labelCol="y", keyCol="id", rounds=3, maxDepth=3, rate=0.2)
    whole = est.fit(df)
    one = est._settings(whole.edges, False).histogram_bytes()
    calls, sums, grow_all = [], bo._sums, bo.HistogramBoosting._grow_all
    monkeypatch.setattr(bo, "_sums", lambda blocks, job, direct=False: calls.append(direct) or sums(blocks, job, direct))
    monkeypatch.setattr(bo.HistogramBoosting, "_grow_all", lambda self, *a: calls.append(a[3]) or grow_all(self, *a))
    for k, v in (("TASK_ROWS", 100), ("BLOCK_ROWS", 30), ("ALONE_CELLS", 0), ("CORE_TASKS", 4), ("DIRECT_BYTES", 5 * one)):
        monkeypatch.setattr(bo, k, v)                        # nine tasks
    many = est.fit(df)
    assert calls[0] == 5 and set(calls[1:]) == {True} and np.array_equal(whole.arrays["cut"], many.arrays["cut"])
    monkeypatch.setattr(bo, "FEW_TASK_ROWS", 100)            # five tasks would hold too many rows
    calls.clear()
    est.fit(df)
    assert calls[0] == 9 and set(calls[1:]) == {False}
