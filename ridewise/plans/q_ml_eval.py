"""Splits, scalers, metrics and class summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridewise import constants as K
from ridewise.operators import evaluate, kpi, scale, split, stats
from ridewise.plans.catalog import register
from ridewise.plans.sql_views import (D, drivers_cte, fraud_trips_cte, interactions_cte, labelled_cte, pm,
                                      rides_cte, trips_cte, with_)
from ridewise.session import cut_lineage
from ridewise.sources import bindings as B

R6 = 6


def _h(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 8))::BIGINT"


# ---------------------------------------------------------------- J1

@register("trip_hash_split", with_(trips_cte()) + f"""
SELECT trip_id, CAST({pm(_h('CAST(trip_id AS VARCHAR)'), 100)} AS INTEGER) AS bucket,
       CASE WHEN {pm(_h('CAST(trip_id AS VARCHAR)'), 100)} < 20 THEN 'test' ELSE 'train' END AS split
FROM trips""", ops=("J1",))
def trip_hash_split(spark, sf_dir):
    s = split.hash_split(B.trips(spark, sf_dir).select("trip_id"), "trip_id", 20)
    return s.select("trip_id", "bucket", "split")


# ---------------------------------------------------------------- J2

@register("labelled_stratified_split", with_(labelled_cte()) + f"""
, h AS (SELECT doc_id, quality, {_h('CAST(doc_id AS VARCHAR)')} AS h FROM labelled),
r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) AS rn,
             count(*) OVER (PARTITION BY quality) AS n FROM h)
SELECT doc_id, quality, CASE WHEN rn <= floor(n * {D(0.2)} + {D(0.5)}) THEN 'test' ELSE 'train' END AS split FROM r""",
          ops=("J2", "D12"))
def labelled_stratified_split(spark, sf_dir):
    s = split.stratified_split(B.labelled(spark, sf_dir).select("doc_id", "quality"), "doc_id", "quality", 0.2)
    return s.select("doc_id", "quality", "split")


# ---------------------------------------------------------------- J3

@register("interaction_sample", with_(interactions_cte(False)) + f"""
SELECT order_id, line_no, customer_id, driver_id FROM interactions
ORDER BY {_h("concat_ws('|', CAST(order_id AS VARCHAR), CAST(line_no AS VARCHAR))")}, order_id, line_no
LIMIT 500""", ops=("J3",))
def interaction_sample(spark, sf_dir):
    i = B.interactions(spark, sf_dir, with_compatibility=False)
    return split.hash_sample(i.select("order_id", "line_no", "customer_id", "driver_id"), ["order_id", "line_no"], 500)


# ---------------------------------------------------------------- J4

def _minmax_sql():
    fs = K.DRIVER_FEATURES
    stats_sel = ", ".join(f"min(CAST({f} AS DOUBLE)) AS {f}__lo, max(CAST({f} AS DOUBLE)) AS {f}__hi" for f in fs)
    cols = ", ".join(
        f"round(CASE WHEN m.{f}__hi - m.{f}__lo <> 0 THEN (CAST(coalesce(d.{f}, 0) AS DOUBLE) - m.{f}__lo) / (m.{f}__hi - m.{f}__lo) "
        f"ELSE CAST(coalesce(d.{f}, 0) AS DOUBLE) - m.{f}__lo END, {R6}) AS {f}" for f in fs)
    return with_(drivers_cte()) + f", m AS (SELECT {stats_sel} FROM drivers)\nSELECT d.driver_id, {cols} FROM drivers d, m"


@register("driver_minmax_features", _minmax_sql(), ops=("J4", "B8"))
def driver_minmax_features(spark, sf_dir):
    d = B.drivers(spark, sf_dir).select("driver_id", *K.DRIVER_FEATURES)
    m = scale.minmax_fit(d, K.DRIVER_FEATURES)
    t = scale.minmax_transform(d, m, K.DRIVER_FEATURES)
    return t.select("driver_id", *[F.round(f, R6).alias(f) for f in K.DRIVER_FEATURES])


# ---------------------------------------------------------------- J5 (fit on the train split only)

def _standard_sql():
    fs = K.FRAUD_FEATURES
    st = ", ".join(f"avg({f}) AS {f}__m, stddev_pop({f}) AS {f}__s" for f in fs)
    cols = ", ".join(
        f"round((s.{f} - m.{f}__m) / (CASE WHEN m.{f}__s <> 0 THEN m.{f}__s ELSE 1.0 END), {R6}) AS {f}" for f in fs)
    return with_(trips_cte(), fraud_trips_cte()) + f"""
, h AS (SELECT *, {_h('CAST(trip_id AS VARCHAR)')} AS h FROM fraud_trips),
r AS (SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY h, trip_id) AS rn,
             count(*) OVER (PARTITION BY is_fraud) AS n FROM h),
s AS (SELECT *, CASE WHEN rn <= floor(n * {D(0.2)} + {D(0.5)}) THEN 'test' ELSE 'train' END AS split FROM r),
m AS (SELECT {st} FROM s WHERE split = 'train')
SELECT s.trip_id, s.split, {cols} FROM s, m"""


@register("fraud_standardized", _standard_sql(), ops=("J5", "J2"))
def fraud_standardized(spark, sf_dir):
    f = B.fraud_trips(spark, sf_dir).select("trip_id", "is_fraud", *K.FRAUD_FEATURES)
    s = cut_lineage(split.stratified_split(f, "trip_id", "is_fraud", 0.2), "split")      # read by fit and transform
    m = scale.standard_fit(s.where(F.col("split") == "train"), K.FRAUD_FEATURES)
    t = scale.standard_transform(s, m, K.FRAUD_FEATURES)
    return t.select("trip_id", "split", *[F.round(c, R6).alias(c) for c in K.FRAUD_FEATURES])


# ---------------------------------------------------------------- J22

@register("fare_baseline_metrics", with_(trips_cte(), rides_cte()) + f"""
, p AS (SELECT price_usd AS y, {D(14.0)} + distance_km * {D(1.5)} AS p FROM rides WHERE price_usd IS NOT NULL)
SELECT round(avg(abs(y - p)), {R6}) AS mae, round(sqrt(avg((y - p) * (y - p))), {R6}) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), {R6}) AS r2,
       round(avg(abs(y - p) / abs(nullif(y, 0.0))) * 100, {R6}) AS mape, count(*) AS n
FROM p""", ops=("J22",))
def fare_baseline_metrics(spark, sf_dir):
    r = B.rides(spark, sf_dir).select("price_usd", (F.lit(14.0) + F.col("distance_km") * F.lit(1.5)).alias("p"))
    m = evaluate.regression_metrics(r, "price_usd", "p")
    return m.select(*[F.round(c, R6).alias(c) for c in ("mae", "rmse", "r2", "mape")], "n")


# ---------------------------------------------------------------- J23

def _auc_sql(label: str) -> str:
    return f"""
SELECT '{label}' AS target, round(sum(pos * (cneg - neg + neg * 0.5)) / (sum(pos) * sum(neg)), {R6}) AS auc,
       sum(pos) AS positives, sum(neg) AS negatives
FROM (SELECT score, pos, neg, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg
      FROM (SELECT score, sum(CAST({label} = 1 AS BIGINT)) AS pos, sum(CAST({label} <> 1 AS BIGINT)) AS neg
            FROM labelled WHERE {label} IS NOT NULL AND score IS NOT NULL GROUP BY score))"""


@register("labelled_roc_auc", with_(labelled_cte()) + _auc_sql("quality") + "\nUNION ALL" + _auc_sql("toxic"),
          ops=("J23",))
def labelled_roc_auc(spark, sf_dir):
    lab = B.labelled(spark, sf_dir)
    out = None
    for t in ("quality", "toxic"):
        a = evaluate.roc_auc(lab, t, "score").select(F.lit(t).alias("target"), F.round("auc", R6).alias("auc"),
                                                      F.col("positives").cast("bigint").alias("positives"),
                                                      F.col("negatives").cast("bigint").alias("negatives"))
        out = a if out is None else out.unionByName(a)
    return out


# ---------------------------------------------------------------- J24

_PRED = "CAST(score >= 0.5 AS INTEGER)"


@register("labelled_confusion", with_(labelled_cte()) + f"""
, c AS (SELECT CAST(quality AS INTEGER) AS actual, {_PRED} AS predicted, count(*) AS n FROM labelled
        WHERE quality IS NOT NULL AND score IS NOT NULL GROUP BY 1, 2)
SELECT s.actual, s.predicted, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) s(actual, predicted)
LEFT JOIN c ON s.actual = c.actual AND s.predicted = c.predicted""", ops=("J24",))
def labelled_confusion(spark, sf_dir):
    lab = B.labelled(spark, sf_dir).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    return evaluate.confusion_matrix(lab, "quality", "pred")


# ---------------------------------------------------------------- J25

@register("labelled_class_report", with_(labelled_cte()) + f"""
, c AS (SELECT CAST(quality AS INTEGER) AS a, {_PRED} AS p FROM labelled WHERE quality IS NOT NULL AND score IS NOT NULL),
per AS (SELECT k AS cls,
          coalesce(sum(CASE WHEN a = k AND p = k THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN p = k THEN 1 ELSE 0 END), 0), 0.0) AS precision,
          coalesce(sum(CASE WHEN a = k AND p = k THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN a = k THEN 1 ELSE 0 END), 0), 0.0) AS recall,
          CAST(sum(CASE WHEN a = k THEN 1 ELSE 0 END) AS BIGINT) AS support
        FROM c, (VALUES (0), (1)) ks(k) GROUP BY k),
per2 AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM per)
SELECT CAST(cls AS VARCHAR) AS class, round(precision, {R6}) AS precision, round(recall, {R6}) AS recall, support,
       round(f1, {R6}) AS f1 FROM per2
UNION ALL SELECT 'accuracy', NULL, NULL, CAST(count(*) AS BIGINT), round(avg(CAST(a = p AS INTEGER)), {R6}) FROM c
UNION ALL SELECT 'macro avg', round(avg(precision), {R6}), round(avg(recall), {R6}), CAST(sum(support) AS BIGINT),
                 round(avg(f1), {R6}) FROM per2
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), {R6}),
                 round(sum(recall * support) / sum(support), {R6}), CAST(sum(support) AS BIGINT),
                 round(sum(f1 * support) / sum(support), {R6}) FROM per2""", ops=("J25", "H1"))
def labelled_class_report(spark, sf_dir):
    lab = B.labelled(spark, sf_dir).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    r = evaluate.classification_report(lab, "quality", "pred")
    return r.select("class", *[F.round(c, R6).alias(c) for c in ("precision", "recall")], "support",
                    F.round("f1", R6).alias("f1"))


# ---------------------------------------------------------------- E24 E25

_MEANS = ["fare_usd", "distance_km", "speed_kmh", "location_jump_km"]


@register("fraud_class_means", with_(trips_cte(), fraud_trips_cte()) + f"""
SELECT is_fraud, count(*) AS rows, {', '.join(f'round(avg({c}), 9) AS mean_{c}' for c in _MEANS)},
       round(count(*) / (SELECT count(*) FROM fraud_trips), {R6}) AS share
FROM fraud_trips WHERE is_fraud IS NOT NULL GROUP BY is_fraud""", ops=("E24", "E25"))
def fraud_class_means(spark, sf_dir):
    m = stats.class_means(B.fraud_trips(spark, sf_dir), "is_fraud", _MEANS, digits=9)
    return m.select("is_fraud", "rows", *[f"mean_{c}" for c in _MEANS], F.round("share", R6).alias("share"))


# ---------------------------------------------------------------- E29

@register("fraud_ratio_rescaled", with_(trips_cte(), fraud_trips_cte()) + f"""
, b AS (SELECT min(fare_distance_ratio) AS lo, max(fare_distance_ratio) AS hi FROM fraud_trips)
SELECT trip_id, round(CASE WHEN hi - lo > 0 THEN (fare_distance_ratio - lo) / (hi - lo) ELSE 0.0 END, {R6}) AS ratio_scaled
FROM fraud_trips, b""", ops=("E29",))
def fraud_ratio_rescaled(spark, sf_dir):
    f = B.fraud_trips(spark, sf_dir).select("trip_id", "fare_distance_ratio")
    r = stats.minmax_rescale(f, "fare_distance_ratio", "ratio_scaled")
    return r.select("trip_id", F.round("ratio_scaled", R6).alias("ratio_scaled"))


# ---------------------------------------------------------------- E26

@register("fraud_type_jump_means", with_(trips_cte(), fraud_trips_cte()) + f"""
SELECT fraud_type, round(avg(location_jump_km), {R6}) AS mean_jump, count(location_jump_km) AS count
FROM fraud_trips WHERE is_fraud = 1 AND fraud_type IS NOT NULL GROUP BY fraud_type""", ops=("E26", "B6"))
def fraud_type_jump_means(spark, sf_dir):
    f = B.fraud_trips(spark, sf_dir).where(F.col("is_fraud") == 1)
    g = kpi.group_mean_count(f, "fraud_type", "location_jump_km", "mean_jump", "count", ascending=False)
    return g.select("fraud_type", F.round("mean_jump", R6).alias("mean_jump"), "count")
