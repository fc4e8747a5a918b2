"""Golden and invariant tests for KPI, statistics, window, geo, split,
scaling and evaluation operators on small typed fixtures."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridewise import constants as K
from ridewise.operators import evaluate, geo, kpi, lookup, scale, split, stats, window


def _daily(spark, days, start=dt.date(2024, 1, 1)):
    rows = [(start + dt.timedelta(days=i), float(v) if v is not None else None) for i, v in days]
    return spark.createDataFrame(rows, "date date, v double")


def test_weekly_resample_sunday_labels_and_empty_weeks(spark):
    # 2024-01-01 is a Monday; a gap of a full week must give a 0 row
    d = _daily(spark, [(0, 1), (6, 2), (7, 4), (21, 8)])
    out = {r["week"]: r["v"] for r in kpi.weekly_resample(d, "date", {"v": "v"}).collect()}
    assert out == {dt.date(2024, 1, 7): 3.0, dt.date(2024, 1, 14): 4.0,
                   dt.date(2024, 1, 21): 0.0, dt.date(2024, 1, 28): 8.0}


def test_frequency_drops_null_keys_and_orders(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "k string")
    got = [(r["k"], r["n"]) for r in kpi.frequency(df, "k", "n").collect()]
    assert got == [("b", 2), ("a", 1), ("c", 1)]


def test_pivot_count_missing_cells_are_null(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "hour int, date date")
    p = kpi.pivot_count_ordered(df, "hour", "date", K.WEEKDAY_NAMES)
    assert p.columns == ["hour", "Monday", "Tuesday"]
    rows = {r["hour"]: (r["Monday"], r["Tuesday"]) for r in p.collect()}
    assert rows == {1: (1, None), 2: (None, 1)}


def test_rolling_mean_needs_full_window(spark):
    d = _daily(spark, [(i, i + 1) for i in range(9)])
    for distributed in (False, True):
        r = {x["date"]: x["m"] for x in window.rolling_mean(d, "date", "v", 7, "m", distributed).collect()}
        assert r[dt.date(2024, 1, 6)] is None
        assert r[dt.date(2024, 1, 7)] == pytest.approx(4.0)
        assert r[dt.date(2024, 1, 9)] == pytest.approx(6.0)


def test_rolling_mean_null_measure(spark):
    d = _daily(spark, [(0, 1), (1, None)] + [(i, 1) for i in range(2, 9)])
    r = {x["date"]: x["m"] for x in window.rolling_mean(d, "date", "v", 7, "m").collect()}
    assert r[dt.date(2024, 1, 7)] is None          # only 6 non-null values in the window
    assert r[dt.date(2024, 1, 9)] == pytest.approx(1.0)


def test_prefix_sums_match_window_at_any_partitioning(spark):
    d = spark.range(0, 500).select(F.col("id"), (F.col("id") % 7).cast("double").alias("v"))
    expect = np.cumsum([i % 7 for i in range(500)])
    for n in (1, 4, 16):
        got = window.prefix_sums(d, ["id"], {"c": "v"}, num_partitions=n).orderBy("id").select("c").collect()
        assert [r[0] for r in got] == list(expect)


def test_top_k_per_group_tie_break(spark):
    df = spark.createDataFrame([(1, 10, 0.5), (1, 11, 0.5), (1, 12, 0.9), (2, 20, 0.1)], "g int, i int, s double")
    got = sorted((r["g"], r["i"], r["rank"]) for r in window.top_k_per_group(df, "g", "s", "i", 2).collect())
    assert got == [(1, 10, 2), (1, 12, 1), (2, 20, 1)]


def test_box_summary_linear_quartiles(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]], "g string, v double")
    r = stats.box_summary(df, "g", "v").first()
    assert (r["q1"], r["median"], r["q3"]) == (2.0, 3.0, 4.0)
    assert r["upper_whisker"] == 4.0 and r["n_outliers"] == 1


def test_histogram_top_edge_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "v double")
    h = {r["bin"]: r["count"] for r in stats.histogram(df, "v", 5).collect()}
    assert h == {0: 2, 1: 0, 2: 0, 3: 0, 4: 1}


def test_minmax_rescale_constant_gives_zero(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0)], "id int, s double")
    assert {r["x"] for r in stats.minmax_rescale(df, "s", "x").collect()} == {0.0}


def test_trend_line(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1) for x in range(10)], "x double, y double")
    r = stats.trend_line(df, "y", "x").first()
    assert r["slope"] == pytest.approx(2.0) and r["intercept"] == pytest.approx(1.0) and r["r2"] == pytest.approx(1.0)


def test_nearest_centroid_tie_and_cutoff(spark):
    z = [("A", 0.0, 0.0, 0, 0, 0), ("B", 0.0, 0.02, 0, 0, 0)]
    pts = spark.createDataFrame([(1, 0.0, 0.01), (2, 0.0, 0.5)], "id int, lat double, lon double")
    out = {r["id"]: r["nearest_zone"] for r in geo.assign_zone(pts, "lat", "lon", 0.06, zones=z).collect()}
    assert out == {1: "A"}                         # equidistant -> first zone; far point dropped


def test_nearest_centroid_join_matches_projection(spark):
    pts = spark.range(0, 200).select(F.col("id"), (F.lit(25.70) + (F.col("id") % 20) * 0.01).alias("lat"),
                                     (F.lit(-80.36) + (F.col("id") % 13) * 0.02).alias("lon"))
    a = {r["id"]: r["nearest_idx"] for r in geo.assign_zone(pts, "lat", "lon", 0.06).collect()}
    zdf = spark.createDataFrame([(i, z[1], z[2]) for i, z in enumerate(K.ZONES)], "zone_idx int, lat double, lon double")
    b = {r["id"]: r["nearest_zone"] for r in geo.nearest_centroid_join(pts, zdf, "id", "lat", "lon", 0.06).collect()}
    assert a == b


def test_stratified_split_exact_counts(spark):
    df = spark.range(0, 1003).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    s = split.stratified_split(df, "id", "y", 0.2)
    c = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    n1, n0 = 101, 902
    assert c[(1, "test")] == int(np.floor(n1 * 0.2 + 0.5)) and c[(0, "test")] == int(np.floor(n0 * 0.2 + 0.5))
    assert s.count() == 1003


def test_hash_split_is_stable_under_repartition(spark):
    df = spark.range(0, 300)
    a = {r["id"]: r["split"] for r in split.hash_split(df, "id").collect()}
    b = {r["id"]: r["split"] for r in split.hash_split(df.repartition(7), "id").collect()}
    assert a == b


def test_scalers_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    mm = scale.minmax_transform(df, scale.minmax_fit(df, ["a", "b"]), ["a", "b"]).collect()
    assert sorted((r["a"], r["b"]) for r in mm) == [(0.0, 0.0), (1.0, 0.0)]
    st = scale.standard_transform(df, scale.standard_fit(df, ["a", "b"]), ["a", "b"]).collect()
    assert sorted((r["a"], r["b"]) for r in st) == [(-1.0, 0.0), (1.0, 0.0)]   # population std


def test_roc_auc_perfect_constant_and_ties(spark):
    perfect = spark.createDataFrame([(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)], "y int, s double")
    const = spark.createDataFrame([(0, 0.5), (1, 0.5), (0, 0.5), (1, 0.5)], "y int, s double")
    tied = spark.createDataFrame([(0, 0.1), (1, 0.5), (0, 0.5), (1, 0.9)], "y int, s double")
    for d in (True, False):
        assert evaluate.roc_auc(perfect, "y", "s", d).first()["auc"] == 1.0
        assert evaluate.roc_auc(const, "y", "s", d).first()["auc"] == 0.5
        assert evaluate.roc_auc(tied, "y", "s", d).first()["auc"] == pytest.approx(0.875)


def test_confusion_and_report_with_missing_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    cm = {(r["actual"], r["predicted"]): r["count"] for r in evaluate.confusion_matrix(df, "y", "p").collect()}
    assert cm == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    rep = {r["class"]: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["f1"] == 0.0
    assert rep["accuracy"]["f1"] == pytest.approx(2 / 3)


def test_regression_metrics_mape_skips_zero(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0), (4.0, 5.0)], "y double, p double")
    r = evaluate.regression_metrics(df, "y", "p").first()
    assert r["mae"] == pytest.approx(1.0)
    assert r["mape"] == pytest.approx((0.5 + 0.25) / 2 * 100)


def test_dense_index(spark):
    df = spark.createDataFrame([(5,), (3,), (5,), (9,)], "k long")
    assert {r["k"]: r["idx"] for r in lookup.dense_index(df, "k").collect()} == {3: 0, 5: 1, 9: 2}


def test_point_lookup_found_flag(spark):
    dim = spark.createDataFrame([(1, "x")], "k int, v string")
    ids = spark.createDataFrame([(1,), (2,)], "k int")
    got = {r["k"]: r["found"] for r in lookup.point_lookup(ids, dim, "k").collect()}
    assert got == {1: True, 2: False}


def test_rider_day_features_skew_safe_equals_window(spark):
    from ridewise.sources import bindings as B
    from conftest import SF
    t = B.trips(spark, SF)
    cols = ["trip_id", "trip_count_today", "cancellations_today", "location_jump_km"]
    a = sorted(tuple(r) for r in B.rider_day_features(t, skew_safe=False).select(*cols).collect())
    for m in (1, 10, 60):
        b = sorted(tuple(r) for r in B.rider_day_features(t, skew_safe=True, bucket_minutes=m).select(*cols).collect())
        assert a == b


def test_rider_day_features_hot_key(spark):
    from ridewise.sources import bindings as B
    import datetime as dt
    rows = [(i, dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=i), 7, "view" if i % 3 else "error",
             25.0 + i * 0.001, -80.0) for i in range(300)]
    t = spark.createDataFrame(rows, "trip_id long, ts timestamp_ntz, customer_id long, trip_type string, "
                                    "pickup_lat double, pickup_lon double").withColumn("date", F.to_date("ts"))
    a = sorted(tuple(r) for r in B.rider_day_features(t, skew_safe=False).select("trip_id", "location_jump_km").collect())
    b = sorted(tuple(r) for r in B.rider_day_features(t, True, 7).select("trip_id", "location_jump_km").collect())
    assert a == b


@pytest.mark.parametrize("parts", [1, 8, 32])
def test_exact_percentile_of_ties_groups_and_skew(spark, parts):
    from ridewise.operators import stats
    rng = np.random.default_rng(parts)
    v = np.r_[rng.integers(0, 50, 3000) * 1.0, rng.standard_cauchy(2000), [1e12, -1e12]]
    g = np.where(np.arange(len(v)) % 7 == 0, "b", "a")
    df = spark.createDataFrame(list(zip(g.tolist(), v.tolist())), "g string, v double").repartition(parts)
    ps = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = {r["g"]: r["q"] for r in stats.percentile(df, "v", ps, group="g", name="q").collect()}
    for k in "ab":
        assert got[k] == pytest.approx(np.quantile(v[g == k], ps).tolist())
    assert stats.percentile(df, "v", 0.5).first()["p"] == pytest.approx(float(np.median(v)))
    assert stats.percentile(df.limit(0), "v", 0.5).first()["p"] is None


@pytest.mark.parametrize("parts", [1, 8, 32])
def test_distributed_auc_with_many_scores_and_other_columns(spark, parts):
    from ridewise.operators import evaluate
    df = (spark.range(0, 150_000, 1, parts).select(
        F.xxhash64("id").alias("s"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0).cast("int").alias("y"),
        F.col("id").cast("string").alias("other"), (F.col("id") * 2).alias("more")))
    a = evaluate.roc_auc(df, "y", "s", distributed=True).first()
    b = evaluate.roc_auc(df, "y", "s", distributed=False).first()
    assert a["auc"] == pytest.approx(b["auc"], abs=1e-12) and 0 <= a["auc"] <= 1
    assert (a["positives"], a["negatives"]) == (b["positives"], b["negatives"])


def test_running_sum_with_an_extra_column(spark):
    df = spark.range(0, 200_000, 1, 16).select("id", F.lit(1).alias("v"), F.uuid().alias("x"))
    r = window.prefix_sums(df, ["id"], {"c": "v"}, num_partitions=24).agg(
        F.max("c").alias("m"), F.countDistinct("c").alias("d"), F.sum((F.col("c") != F.col("id") + 1).cast("int")).alias("bad")).first()
    assert (r["m"], r["d"], r["bad"]) == (200_000, 200_000, 0)


def test_auc_counts_pass_a_long(spark):
    from ridewise.operators import evaluate
    big = spark.createDataFrame([(1, 0.9)] * 3 + [(0, 0.1)] * 5, "y int, s double")
    assert evaluate.roc_auc(big, "y", "s").first()["auc"] == 1.0
    one = spark.createDataFrame([(1, 0.9)], "y int, s double")
    assert evaluate.roc_auc(one, "y", "s").first()["auc"] is None


def test_density_of_a_given_range(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (50.0,)], "v double")
    h = stats.histogram(df, "v", 4, lo=0.0, hi=2.0, density=True).collect()
    assert sum(r["density"] * (r["bin_hi"] - r["bin_lo"]) for r in h) == pytest.approx(1.0)


def test_nearest_zone_join_neither_groups_nor_shuffles_points(spark):
    rng = np.random.RandomState(5)
    zones = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.rand(40, 2).round(2))] + [(40, 0.5, 0.5), (41, 0.5, 0.5)]
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.rand(300, 2) * 1.4 - 0.2)] + [(300, 0.5, 0.5), (300, 0.5, 0.5), (301, None, 0.5),
                                                                                           (None, 0.5, 0.5)]
    z = spark.createDataFrame(zones, "zone_idx int, lat double, lon double")
    p = spark.createDataFrame(pts, "id long, x double, y double").repartition(3)
    out = geo.nearest_centroid_join(p, z, "id", "x", "y", 0.1)
    want = []
    for i, x, y in pts:
        if i is not None and x is not None:
            d, k = min((math.sqrt((x - a) ** 2 + (y - b) ** 2), k) for k, a, b in zones)
            want += [(i, k)] if d <= 0.1 else []
    assert sorted((r["id"], r["nearest_zone"]) for r in out.collect()) == sorted(want) and (300, 40) in want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [id" not in plan and plan.count("Join") == 1
