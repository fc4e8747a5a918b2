"""Fits over rows that repeat: groups of equal rows give what the rows give."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from ridewise.operators import boosting as bo
from ridewise.operators import forecast, forest
from ridewise.session import scratch_path
from test_boosting import plain_tree

COLS = ["a", "b", "c"]


def frame(spark, n=3000, seed=5):
    """Some 105 distinct features, 3 labels each."""
    rng = np.random.RandomState(seed)
    x = np.column_stack([rng.randint(0, 7, n), rng.randint(0, 5, n) / 4, rng.randint(0, 3, n)]).astype(float)
    y = np.floor(3 * x[:, 0] - 8 * x[:, 1] * (x[:, 2] > 0) + rng.randint(0, 3, n))
    rows = [(i, *map(float, r), float(v), float(v > 8)) for i, (r, v) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "id long, a double, b double, c double, y double, k double").repartition(4)


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(bo, "TASK_ROWS", 500)


def predictions(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()])


@pytest.mark.parametrize("kw", [{"labelCol": "y"}, {"labelCol": "y", "maxLeaves": 6, "leastRows": 40},
                                {"labelCol": "k", "objective": "logistic", "leastHessian": 2.0, "leastRows": 30}])
@pytest.mark.parametrize("task_rows", [500, 60])
def test_boosting_goes_over_groups(spark, monkeypatch, kw, task_rows):
    _, _, df = frame(spark)
    df = df.withColumn("a", F.when(F.col("a") == 0, None).otherwise(F.col("a")))
    est = bo.HistogramBoosting(inputCols=COLS, keyCol="id", rounds=6, maxDepth=4, rate=0.3, l2=0.5, **kw)
    whole = est.fit(df)
    monkeypatch.setattr(bo, "TASK_ROWS", task_rows)
    counted, task_count = [], bo.task_count
    monkeypatch.setattr(bo, "task_count", lambda rows, cores: counted.append(rows) or task_count(rows, cores))
    got = est.fit(df)
    assert counted == [105]                                  # not 3,000 rows a round
    for k in ("edges", "feature", "cut", "left", "size"):
        assert np.array_equal(whole.arrays[k], got.arrays[k]), k
    assert np.allclose(whole.arrays["value"], got.arrays["value"], atol=1e-9)


@pytest.mark.parametrize("kw", [{"rowShare": 0.6}, {"weightCol": "k"}])
def test_row_samples_and_weights_keep_their_rows(spark, small_tasks, monkeypatch, kw):
    _, _, df = frame(spark)
    counted, task_count = [], bo.task_count
    monkeypatch.setattr(bo, "task_count", lambda rows, cores: counted.append(rows) or task_count(rows, cores))
    bo.HistogramBoosting(inputCols=COLS, labelCol="y", keyCol="id", rounds=1, maxDepth=2, **kw).fit(df)
    assert counted == [3000]


def test_a_tree_of_groups_is_the_tree_of_the_drawn_rows():
    rng = np.random.RandomState(1)
    bins, y, count = rng.randint(0, 6, (3, 200)).astype(np.uint8), rng.randint(0, 9, 200) / 4, rng.randint(1, 30, 200).astype(float)
    s = forest.Growth(3, 6, 3, 4, 42, 0.0, 1.0)
    tree = forest.grow_tree(s, bins, y, count, 7)
    times = np.random.RandomState([42, 7]).poisson(count)
    x, t = np.repeat(bins.T.astype(float), times, axis=0), np.repeat(y, times)
    want = plain_tree(x, -t, np.ones(len(t)), 4, 0.0, 1.0)
    assert np.allclose(bo.margin_of([tree.arrays()], bins, 0.0), want(bins.T.astype(float)), atol=1e-9)


def test_each_node_has_features_of_its_own():
    rng = np.random.RandomState(3)
    bins, count = rng.randint(0, 9, (8, 2000)).astype(np.uint8), np.full(2000, 50.0)
    y = 9.0 * bins[0] + bins[1] + 0.1 * rng.rand(2000)
    trees = [forest.grow_tree(forest.Growth(8, 9, 3, 4, 42, 0.0, 1.0), bins, y, count, t) for t in range(60)]
    roots = np.bincount([t.feature[0] for t in trees], minlength=8)
    assert 12 <= roots[0] <= 34                              # in 3 of 8 roots' choices, and the best one there
    assert len({tuple(t.feature) for t in trees}) > 50


def test_forest_of_groups_is_like_the_forest_of_rows(spark, small_tasks, monkeypatch):
    x, y, df = frame(spark)
    pipe = forecast.forest(COLS, "y", numTrees=60, maxDepth=5)
    got = pipe.fit(df)
    assert isinstance(got.stages[-1], forest.ForestModel)    # grown from some 300 groups
    monkeypatch.setattr(bo, "TASK_ROWS", 10 ** 6)
    rows = pipe.fit(df)
    assert isinstance(rows.stages[-1], RandomForestRegressionModel)
    a, b = predictions(got, df), predictions(rows, df)
    assert np.corrcoef(a, b)[0, 1] > 0.99 and abs(a.mean() - b.mean()) < 0.1
    assert abs(np.mean((a - y) ** 2) / np.mean((b - y) ** 2) - 1) < 0.25
    one, two = ({r.feature: r.importance for r in forecast.feature_importance(spark, m, COLS).collect()} for m in (got, rows))
    assert abs(sum(one.values()) - 1) < 1e-9 and all(abs(one[c] - two[c]) < 0.08 for c in COLS)
    path = scratch_path(spark, "forest-model")
    got.save(path)
    assert np.array_equal(predictions(PipelineModel.load(path), df), a)


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_numbers(spark, small_tasks, bad):
    _, _, df = frame(spark)
    m = forecast.forest(COLS, "y", numTrees=10, maxDepth=4).fit(df).stages[-1]
    two = spark.createDataFrame([(0, bad, 0.0, 0.0), (1, 99.0, 0.0, 0.0)], "id long, a double, b double, c double")
    p = predictions(m, two)
    assert isinstance(m, forest.ForestModel) and p[0] == p[1]                # as the greatest value, as with MLlib
    for c in ("a", "y"):                                     # MLlib refuses to fit them, at every size
        with pytest.raises(Exception, match="MUST NOT be"):
            forecast.forest(COLS, "y", numTrees=2).fit(df.withColumn(c, F.when(F.col("id") > 9, F.col(c)).otherwise(bad)))


def test_other_tables_and_settings_are_mllibs(spark, small_tasks):
    _, _, df = frame(spark)
    unlike = df.withColumn("y", F.col("y") + F.rand(1))
    for pipe, table in ((forecast.forest(COLS, "y", numTrees=2, maxDepth=2), unlike),
                        (forecast.forest(COLS, "y", numTrees=2, maxDepth=2, minInstancesPerNode=3), df)):
        assert isinstance(pipe.fit(table).stages[-1], RandomForestRegressionModel)


def test_scenarios_are_forecast_by_a_fit_over_groups(spark, small_tasks, monkeypatch, tmp_path):
    from ridewise.plans import q_models
    (spark.range(12_000).select(F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-03-01' + make_interval(0, 0, 0, 0, int(id div 10 % 96))").alias("ts"),
                                (F.col("id") % 50).alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.5).alias("value"), F.lit("{}").alias("props"))
     .write.parquet(f"{tmp_path}/events.parquet"))
    counted, task_count, demand = [], bo.task_count, q_models._demand
    monkeypatch.setattr(bo, "task_count", lambda rows, cores: counted.append(rows) or task_count(rows, cores))
    monkeypatch.setattr(q_models, "_demand", lambda spark, d: demand(spark, d, 3, 4))
    got = q_models.scenario_demand_forecast(spark, str(tmp_path)).collect()
    assert len(got) == 120 and all(0 <= r.predicted_demand <= 1.5 for r in got)
    assert counted == [960]                                  # hours of four days in ten zones
    assert isinstance(q_models._demand(spark, str(tmp_path)).model("random_forest").stages[-1], forest.ForestModel)


def test_the_demand_fit_does_not_grow_with_the_events(spark, monkeypatch, tmp_path):
    """Above ``TASK_ROWS`` rows a fit goes over the hours of the week in a month and the zones, however many events there are."""
    from ridewise.plans import q_models
    counted, task_count, demand = [], bo.task_count, q_models._demand
    monkeypatch.setattr(bo, "task_count", lambda rows, cores: counted.append(rows) or task_count(rows, cores))
    monkeypatch.setattr(q_models, "_demand", lambda spark, d: demand(spark, d, 2, 2))
    for n in (180_000, 360_000):
        (spark.range(n).select(F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-03-01' + make_interval(0, 0, 0, 0, int(id div 10 % 720))").alias("ts"),
                               (F.col("id") % 50).alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.5).alias("value"), F.lit("{}").alias("props"))
         .write.parquet(f"{tmp_path}/{n}/events.parquet"))
        assert len(q_models.scenario_demand_forecast(spark, f"{tmp_path}/{n}").collect()) == 120
        assert isinstance(q_models._demand(spark, f"{tmp_path}/{n}").model("random_forest").stages[-1], forest.ForestModel)
    assert counted == [1680, 1680]
