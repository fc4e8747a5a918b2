"""Streaming queries (K1-K4): run with availableNow over the table directory,
then read the sink; each has a batch twin in DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridewise import constants as K
from ridewise.operators import validate
from ridewise.plans.catalog import register
from ridewise.plans.q_rules import match_validation_sql, price_validation_sql
from ridewise.plans.sql_views import D, device, fraud_trips_cte, pm, rhu, rides_cte, trips_cte, with_
from ridewise.session import cut_lineage, scratch_path
from ridewise.sources import bindings as B
from ridewise.sources.tables import read_table
from ridewise.streaming import jobs

R6 = 6


def _last(spark, sf_dir):
    return read_table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]


@register("stream_zone_window_demand", with_(trips_cte()) + f"""
, w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, neighborhood, count(*) AS requests,
               count(DISTINCT {pm('trip_id * 29', 211)} + 1) AS active_drivers,
               sum(completed) AS completed, round(sum(fare_usd), {R6}) AS fares
        FROM trips GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, neighborhood, requests, active_drivers,
       CAST(completed AS BIGINT) AS completed, fares, {rhu('requests / (active_drivers + 1)', 2)} AS demand_supply_ratio
FROM w""", ops=("K1", "E5"))
def stream_zone_window_demand(spark, sf_dir):
    out, _ = jobs.run_to_end(jobs.event_stream(spark, sf_dir), _last(spark, sf_dir),
                             lambda e: jobs.zone_window_demand(B.trips_from_events(e)), "k1")
    return out.select("window_start", "window_end", "neighborhood", "requests", "active_drivers",
                      F.col("completed").cast("bigint").alias("completed"), F.round("fares", R6).alias("fares"),
                      "demand_supply_ratio")


def _k2_sql():
    p = rhu(f"greatest(price_usd, {D(K.SURGE_PRICE_FLOOR)})", 2)
    base = f"({D(K.SURGE_BASE_FARE)} + distance_km * {D(K.SURGE_PER_KM)})"
    return with_(trips_cte(), rides_cte()) + f"""
SELECT trip_id, {p} AS estimated_price_usd, {p} > {base} * {D(K.SURGE_FACTOR)} AS surge_active,
       CASE WHEN distance_km < {D(K.SURGE_HIGH_CONFIDENCE_KM)} THEN 'high' ELSE 'medium' END AS confidence
FROM rides"""


@register("stream_price_scoring", _k2_sql(), ops=("K2", "C1", "C6"))
def stream_price_scoring(spark, sf_dir):
    static_t = B.trips(spark, sf_dir)
    boosts = cut_lineage(B.pricing_boost_by_date(spark, static_t.select("date")))   # static, one row per day
    t = B.trips_from_events(jobs.event_stream(spark, sf_dir))
    out = jobs.run_available_now(jobs.price_scoring(spark, t, boosts), "k2")
    return out.select("trip_id", "estimated_price_usd", "surge_active", "confidence")


@register("stream_fraud_scoring", with_(trips_cte(), fraud_trips_cte()) + """
, b AS (SELECT quantile_cont(fare_distance_ratio, 0.25) AS q1, quantile_cont(fare_distance_ratio, 0.75) AS q3 FROM fraud_trips)
SELECT trip_id, is_fraud, fraud_type,
       concat_ws(',',
         CASE WHEN speed_kmh > 90.0 AND location_jump_km > 15.0 THEN 'gps_spoofing' END,
         CASE WHEN fare_distance_ratio > b.q3 + 1.5 * (b.q3 - b.q1) THEN 'fare_manipulation' END,
         CASE WHEN duration_min <= 3.0 AND speed_kmh > 90.0 THEN 'fake_completion' END,
         CASE WHEN new_device = 1 AND location_jump_km > 15.0 THEN 'account_takeover' END,
         CASE WHEN trip_count_today >= 15 AND cancellations_today >= 3 THEN 'promo_abuse' END) AS patterns
FROM fraud_trips, b""", ops=("K3", "C7"))
def stream_fraud_scoring(spark, sf_dir):
    # Batch side: materialise the scored trip table and freeze the bound.
    ft = B.fraud_trips(spark, sf_dir)
    path = scratch_path(spark, "fraud-trips")
    ft.write.parquet(path)
    table = spark.read.parquet(path)
    from ridewise.operators.stats import percentile
    q = percentile(table, "fare_distance_ratio", [0.25, 0.75], name="q").first()["q"]
    bound = q[1] + 1.5 * (q[1] - q[0])
    stream = spark.readStream.schema(table.schema).parquet(path)
    return jobs.run_available_now(jobs.fraud_scoring(stream, bound), "k3")


@register("stream_rider_day_state", with_(trips_cte()) + f"""
, o AS (SELECT *, row_number() OVER w AS rn, lag(pickup_lat) OVER w AS plat, lag(pickup_lon) OVER w AS plon,
               sum(CAST(trip_type = 'error' AS INTEGER)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c,
               row_number() OVER (PARTITION BY customer_id ORDER BY ts, trip_id) AS nth,
               row_number() OVER (PARTITION BY customer_id, {device('trip_id')} ORDER BY ts, trip_id) AS nth_device
        FROM trips WINDOW w AS (PARTITION BY customer_id, date ORDER BY ts, trip_id))
SELECT trip_id, customer_id, date, CAST(rn AS INTEGER) AS trips_so_far, CAST(c AS INTEGER) AS cancellations_so_far,
       coalesce({rhu(f'sqrt((pickup_lat - plat) * (pickup_lat - plat) + (pickup_lon - plon) * (pickup_lon - plon)) * {D(111.0)}', 2)}, 0.0) AS location_jump_km,
       CAST(nth_device = 1 AND nth > 1 AS INTEGER) AS new_device
FROM o""", ops=("K4",))
def stream_rider_day_state(spark, sf_dir):
    out, _ = jobs.run_to_end(jobs.event_stream(spark, sf_dir), _last(spark, sf_dir),
                             lambda e: jobs.rider_running(B.trips_from_events(e)), "k4", conf=jobs.ROCKSDB)
    return out


# --------------------------------------------------------------------------- A8: request bodies

PRICE_BODY = ("hour int, day_of_week int, month int, distance_km double, weather string, pickup_neighborhood string, "
              "dropoff_neighborhood string, driver_supply_ratio double, event_demand_multiplier double, active_drivers int, "
              "pending_requests int")
MATCH_BODY = "preferred_car_type string, " + ", ".join(f"{f} int" for f in validate.MATCH_FLAGS) + ", price_sensitivity double, top_k int"


def _bodies(requests, drop: str):
    """Requests as JSON texts; every 79th lacks ``drop``, every 83rd breaks off."""
    k = F.col("request_id")
    cols = [c for c in requests.columns if c != "request_id"]
    held = [F.when(F.pmod(k, F.lit(79)) != 0, F.col(c)).alias(c) if c == drop else F.col(c) for c in cols]
    text = requests.select(k.cast("long").alias("request_id"), F.to_json(F.struct(*held)).alias("body"))
    return text.withColumn("body", F.when(F.pmod(k, F.lit(83)) == 0, F.expr("substring(body, 1, length(body) - 3)")).otherwise(F.col("body")))


def _answers(spark, requests, drop, schema, rules, name, fill=None):
    path = scratch_path(spark, f"{name}-bodies")
    _bodies(requests, drop).write.parquet(path)
    stream = spark.readStream.schema("request_id long, body string").parquet(path)
    valid, rejected = jobs.request_stream(stream, schema, rules, name, fill)
    cols = [c for c in valid.columns if c != "request_id"]
    return valid.select("request_id", F.lit("").alias("errors"), F.lit(True).alias("is_valid"), *cols) \
                .unionByName(rejected.select("request_id", "errors", F.lit(False).alias("is_valid")), allowMissingColumns=True)


def _answers_sql(checked: str, table: str, drop: str, where: str, cols: list[str]) -> str:
    """The validation twin over bodies that lack ``drop`` or break off."""
    a = checked.index("v AS (SELECT")
    sql = checked[:a].replace(f"FROM {where})", f"FROM {where}), {table}b AS (SELECT * REPLACE (CASE WHEN request_id % 79 <> 0 THEN {drop} END "
                              f"AS {drop}) FROM {table})")
    tail = checked[a:].replace(f"FROM {table})", f"FROM {table}b)").split("\nSELECT", 1)[0]
    tail = tail.replace("v AS (SELECT request_id,", "v AS (SELECT *,")
    shown = ", ".join(f"CASE WHEN ok THEN {c} END AS {c}" for c in cols)
    return f"""{sql}{tail},
j AS (SELECT * REPLACE (CASE WHEN request_id % 83 = 0 THEN 'malformed body' ELSE errors END AS errors) FROM v),
k AS (SELECT *, errors = '' AS ok FROM j)
SELECT request_id, errors, ok AS is_valid, {shown} FROM k"""


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


@register("stream_price_requests", _answers_sql(price_validation_sql(), "pr", "weather", "rides", _names(PRICE_BODY)), ops=("A8", "B4"))
def stream_price_requests(spark, sf_dir):
    return _answers(spark, B.price_requests(spark, sf_dir), "weather", PRICE_BODY, validate.price_request_rules(), "price-requests")


@register("stream_match_requests", _answers_sql(match_validation_sql(), "mr", "preferred_car_type", "customers", _names(MATCH_BODY)),
          ops=("A8", "B5"))
def stream_match_requests(spark, sf_dir):
    return _answers(spark, B.match_requests(spark, sf_dir), "preferred_car_type", MATCH_BODY, validate.match_request_rules(),
                    "match-requests", validate.match_request_defaults)
