"""Source and sink queries (A1-A4, A7, A8), fills of nulls and NaN (B8), the
duplicate-cell sum (E28), display formats, and the AUC over many scores.

Files go to the shared folder (``spark.checkpoint.dir``) and are read back by
the query, so the result depends on writer and reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridewise.functions.exprs import hour_label, money, percent
from ridewise.operators import evaluate, matching, scale
from ridewise.plans.catalog import register
from ridewise.plans.sql_views import interactions_cte, with_
from ridewise.session import scratch_path
from ridewise.sources import bindings as B
from ridewise.sources import io
from ridewise.sources.tables import read_table

R6 = 6


@register("csv_orders_by_month", f"""
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, o_orderstatus AS status, count(*) AS orders,
       round(sum(o_totalprice), {R6}) AS revenue, max(CAST(o_orderdate AS DATE)) AS last_day
FROM orders GROUP BY ALL""", ops=("A1", "A2", "A3"))
def csv_orders_by_month(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderdate").cast("timestamp").alias("at"),
        "o_totalprice", F.when(F.col("o_orderstatus") == "O", "none").otherwise(F.col("o_orderstatus")).alias("status"))
    path = scratch_path(spark, "orders-csv")
    io.write_table(o, path, fmt="csv")
    back = io.read_csv(spark, path, "o_orderkey long, day date, at timestamp, o_totalprice double, status string",
                       timestamp_format="yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]")
    status = F.when(F.col("status") == "none", "O").otherwise(F.col("status"))       # a category, not a null
    return (back.groupBy(F.year("day").alias("year"), F.month("at").alias("month"), status.alias("status"))
                .agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), R6).alias("revenue"),
                     F.max("day").alias("last_day")))


@register("json_metrics_roundtrip", f"""
SELECT event_type, count(*) AS n, round(avg(value), {R6}) AS mean_value FROM events GROUP BY event_type""", ops=("A4",))
def json_metrics_roundtrip(spark, sf_dir):
    m = (read_table(spark, sf_dir, "events").groupBy("event_type")
         .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")))
    path = scratch_path(spark, "metrics-json")
    io.write_metrics(m, path)
    back = spark.read.schema("event_type string, n long, mean_value double").json(path)
    return back.select("event_type", "n", F.round("mean_value", R6).alias("mean_value"))


@register("event_props_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract(props, '$.k') IS NOT NULL AS valid,
       '{"event_id":' || event_id || ',"k":' || json_extract_string(props, '$.k') || '}' AS response
FROM events""", ops=("A8", "I-json"))
def event_props_json(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long").alias("body"))
    return e.select("event_id", F.col("body.k").alias("k"), F.col("body.k").isNotNull().alias("valid"),
                    F.to_json(F.struct("event_id", F.col("body.k").alias("k"))).alias("response"))


@register("nan_filled_minmax", f"""
WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 0.0 WHEN event_id % 11 = 0 THEN 0.0 ELSE value END AS v FROM events)
SELECT event_id, round((v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()), {R6}) AS v FROM e""", ops=("B8", "J4"))
def nan_filled_minmax(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).when(F.col("event_id") % 11 == 0, F.lit(None))
                     .otherwise(F.col("value")).alias("v"))
    e = io.cached(e)                       # A7: read by the fit and by the transform
    t = scale.minmax_transform(e, scale.minmax_fit(e, ["v"]), ["v"])
    return t.select("event_id", F.round("v", R6).alias("v"))


@register("kpi_labels", f"""
WITH g AS (SELECT hour(ts) AS h, count(*) AS n, sum(value) AS s FROM events GROUP BY 1)
SELECT printf('%02d:00', h) AS label, '$' || format('{{:,.0f}}', round(s)) AS revenue,
       format('{{:,.1f}}', n * 100.0 / sum(n) OVER ()) || '%' AS share,
       (SELECT count(DISTINCT lower(replace(event_type, 'sign', 'SIGN-'))) FROM events) AS kinds FROM g""",
          ops=("I-format", "I lower, replace"))
def kpi_labels(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    g = e.groupBy(F.hour("ts").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"))
    tot = e.agg(F.count(F.lit(1)).alias("all"),
                F.countDistinct(F.lower(F.replace(F.col("event_type"), F.lit("sign"), F.lit("SIGN-")))).alias("kinds"))
    return g.crossJoin(F.broadcast(tot)).select(hour_label("h").alias("label"), money(F.round("s")).alias("revenue"),
                                                percent(F.col("n") / F.col("all")).alias("share"), "kinds")


@register("rating_matrix_cells", with_(interactions_cte(False)) + """
SELECT customer_id, driver_id, CAST(sum(explicit_rating) AS DOUBLE) AS value FROM interactions
WHERE customer_id IS NOT NULL AND driver_id IS NOT NULL GROUP BY ALL""", ops=("E28",))
def rating_matrix_cells(spark, sf_dir):
    return matching.rating_matrix(B.interactions(spark, sf_dir, with_compatibility=False))


@register("event_value_auc", f"""
WITH s AS (SELECT value + event_id / 1e7 AS score, event_type = 'purchase' AS y FROM events),
g AS (SELECT score, count(*) FILTER (y) AS pos, count(*) FILTER (NOT y) AS neg FROM s GROUP BY score),
c AS (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM g)
SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)), {R6}) AS auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives FROM c""", ops=("J23", "F1b"))
def event_value_auc(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select(
        (F.col("value") + F.col("event_id") / F.lit(1e7)).alias("score"), (F.col("event_type") == "purchase").cast("int").alias("y"),
        "event_type", "props")
    a = evaluate.roc_auc(e, "y", "score")
    return a.select(F.round("auc", R6).alias("auc"), F.col("positives").cast("long").alias("positives"),
                    F.col("negatives").cast("long").alias("negatives"))
