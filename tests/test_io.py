"""Sources and sinks: typed CSV round trip, metrics JSON, model persistence."""

import datetime as dt
import tempfile

import numpy as np

from ridewise.sources import io
from ridewise.operators import anomaly


def test_csv_roundtrip_keeps_none_category_and_dates(spark):
    d = tempfile.mkdtemp(prefix="rw-io-", dir="/tmp")
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "none", 1.5), (dt.date(2024, 1, 2), "pop", None)],
                               "date date, music_pref string, v double")
    io.write_table(df, f"{d}/t", fmt="csv")
    back = io.read_csv(spark, f"{d}/t", "date date, music_pref string, v double")
    assert sorted(back.collect()) == sorted(df.collect())


def test_metrics_json_and_model_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="rw-io-", dir="/tmp")
    m = spark.createDataFrame([("mae", 1.0)], "metric string, value double")
    io.write_metrics(m, f"{d}/metrics")
    assert spark.read.json(f"{d}/metrics").count() == 1
    df = spark.createDataFrame([(i, float(i % 5), float(i % 3)) for i in range(100)], "id long, a double, b double")
    forest = anomaly.fit_isolation_forest(df, "id", ["a", "b"], n_trees=5, sample=32)
    io.save_forest(spark, forest, f"{d}/forest")
    f2 = io.load_forest(spark, f"{d}/forest")
    assert f2["psi"] == forest["psi"] and len(f2["trees"]) == 5
    assert all(np.array_equal(a, b) for a, b in zip(f2["leaf"], forest["leaf"]))
    net = anomaly.Network.drawn([2, 3, 1, 3, 2], 0.5, 1)
    io.save_network(spark, net, f"{d}/net")
    x = np.random.default_rng(0).normal(size=(5, 2))
    assert np.array_equal(io.load_network(spark, f"{d}/net").reconstruct(x), net.reconstruct(x))


def test_pipeline_saved_loaded_scored_and_cached(spark):
    from ridewise import constants as K
    from ridewise.operators import forecast
    d = tempfile.mkdtemp(prefix="rw-io-", dir="/tmp")
    rng = np.random.default_rng(1)
    rows = [tuple(float(v) for v in rng.normal(size=len(K.PRICING_FEATURES) + 1)) for _ in range(80)]
    df = io.cached(spark.createDataFrame(rows, [*K.PRICING_FEATURES, "price_usd"]))
    model = forecast.forest(K.PRICING_FEATURES, "price_usd", numTrees=2, maxDepth=2).fit(df)
    io.save_model(model, f"{d}/model")
    back = io.load_model(f"{d}/model")
    assert back.stages[0].getInputCols() == K.PRICING_FEATURES
    a, b = ([r["prediction"] for r in m.transform(df).orderBy(*K.PRICING_FEATURES).collect()] for m in (model, back))
    assert a == b and df.is_cached
    df.unpersist()


def test_gradient_against_differences():
    net = anomaly.Network.drawn([3, 4, 2, 4, 3], 0.7, 3)
    size = sum(m.size + c.size for m, c in net.layers)
    net = net.moved(np.random.default_rng(5).normal(size=size) * 0.2)       # no unit right at its kink
    x = np.random.default_rng(2).normal(size=(6, 3))
    g, loss = net.gradient(x)
    for k in range(0, len(g), 5):
        step = np.zeros(len(g))
        step[k] = 1e-6
        num = (net.moved(step).gradient(x)[1] - net.moved(-step).gradient(x)[1]) / 2e-6
        assert abs(num - g[k]) < 1e-4 * max(1.0, abs(num))
    assert abs(loss - np.square(net.reconstruct(x) - x).sum()) < 1e-9


def test_scratch_is_dropped_on_request(spark, monkeypatch):
    import os
    from ridewise import session
    monkeypatch.setattr(session, "_SCRATCH", [])
    t = session.cut_lineage(spark.range(3), "drop-me")
    path = session._SCRATCH[0]
    assert t.count() == 3 and os.path.isdir(path.removeprefix("file:"))
    assert session.drop_scratch(spark) == 1 and not os.path.exists(path.removeprefix("file:"))
