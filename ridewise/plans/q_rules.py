"""Rule scoring, encoders, validation and lookup queries (B, C, D families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridewise import constants as K
from ridewise.functions.encode import apply_codes, fit_alphabetical, ordinal_code
from ridewise.functions.rules import fraud_patterns, rating_from_compatibility, rule_fare, surge_explanation
from ridewise.operators import lookup, validate
from ridewise.plans.catalog import register
from ridewise.plans.sql_views import (CARS, D, compatibility_sql, customers_cte, demand_factor_cte,
                                      drivers_cte, fraud_trips_cte, geo_trips_cte, interactions_cte,
                                      pricing_boost_cte, rhu, rides_cte, trips_cte, with_)
from ridewise.session import cut_lineage
from ridewise.sources import bindings as B

# ---------------------------------------------------------------- C1 + B11 B17 B27 C3

@register("rule_fares", with_(trips_cte(), rides_cte()) + """
SELECT trip_id, weather, weather_encoded, active_drivers, demand_supply_ratio,
       event_demand_multiplier, price_usd
FROM rides""", ops=("C1", "C3", "B11", "B17", "B27"))
def rule_fares(spark, sf_dir):
    r = B.rides(spark, sf_dir)
    return r.select("trip_id", "weather", "weather_encoded", "active_drivers", "demand_supply_ratio",
                    "event_demand_multiplier", "price_usd")


# ---------------------------------------------------------------- C3 event calendar

@register("event_calendar", with_(trips_cte(), pricing_boost_cte("trips"), demand_factor_cte("trips")) + """
SELECT p.date, z.zone, p.event_demand_multiplier AS pricing_boost,
       round(coalesce(f.event_factor, 1.0), 6) AS demand_factor
FROM pboost p CROSS JOIN (SELECT DISTINCT zone FROM devents) z
LEFT JOIN dfactor f ON f.date = p.date AND f.zone = z.zone""", ops=("C3",))
def event_calendar(spark, sf_dir):
    dates = B.trips(spark, sf_dir).select("date")
    p = B.pricing_boost_by_date(spark, dates)
    zones = spark.createDataFrame([(z,) for z in sorted({z for _, _, zs, _ in K.DEMAND_EVENTS for z in zs})],
                                  "zone string")
    f = B.demand_factor_by_date_zone(spark, dates)
    out = p.crossJoin(F.broadcast(zones)).join(f, ["date", "zone"], "left")
    return out.select("date", "zone", F.col("event_demand_multiplier").alias("pricing_boost"),
                      F.round(F.coalesce("event_factor", F.lit(1.0)), 6).alias("demand_factor"))


# ---------------------------------------------------------------- C2 demand score

@register("zone_demand_scores", with_(trips_cte(), geo_trips_cte()) + """
SELECT trip_id, neighborhood, hour, day_of_week, month, demand_score FROM geo_trips""", ops=("C2", "C3", "D6"))
def zone_demand_scores(spark, sf_dir):
    g = B.geo_trips(spark, sf_dir)
    return g.select("trip_id", "neighborhood", "hour", "day_of_week", "month", "demand_score")


# ---------------------------------------------------------------- C4 C5 D3

@register("compatibility_scores", with_(interactions_cte(True)) + """
SELECT order_id, line_no, customer_id, driver_id, compatibility,
       CAST(least(greatest(round_even(1 + 4 * compatibility, 0), 1), 5) AS INTEGER) AS implied_rating
FROM interactions""", ops=("C4", "C5", "D3"))
def compatibility_scores(spark, sf_dir):
    i = B.interactions(spark, sf_dir, with_compatibility=True)
    return i.select("order_id", "line_no", "customer_id", "driver_id", "compatibility",
                    rating_from_compatibility("compatibility").alias("implied_rating"))


# ---------------------------------------------------------------- C6 surge explanation

def _surge_sql():
    price = "price_usd"
    p = rhu(f"greatest({price}, {D(K.SURGE_PRICE_FLOOR)})", 2)
    base = f"({D(K.SURGE_BASE_FARE)} + distance_km * {D(K.SURGE_PER_KM)})"
    night = "(hour >= 22 OR hour <= 5)"
    reasons = (f"concat_ws(', ', CASE WHEN {night} THEN 'late night' END, "
               f"CASE WHEN weather IN ('rainy', 'stormy') THEN weather || ' weather' END, "
               f"CASE WHEN event_demand_multiplier > {D(K.SURGE_EVENT_THRESHOLD)} THEN 'local event' END, "
               f"CASE WHEN driver_supply_ratio < {D(K.SURGE_LOW_SUPPLY)} THEN 'low driver supply' END, "
               f"CASE WHEN day_of_week >= 5 THEN 'weekend' END)")
    return with_(trips_cte(), rides_cte()) + f""", s AS (SELECT trip_id, {p} AS p, {base} AS base_est, {reasons} AS reasons,
             distance_km, weather, day_of_week, {night} AS is_night FROM rides)
SELECT trip_id, p AS estimated_price_usd, p > base_est * {D(K.SURGE_FACTOR)} AS surge_active,
       CASE WHEN reasons = '' THEN 'none' ELSE reasons END AS surge_reason,
       CASE WHEN distance_km < {D(K.SURGE_HIGH_CONFIDENCE_KM)} THEN 'high' ELSE 'medium' END AS confidence,
       {D(K.SURGE_BASE_FARE)} AS base_fare, {rhu(f'distance_km * {D(K.SURGE_PER_KM)}', 2)} AS distance_component,
       {rhu('p / base_est', 2)} AS surge_multiplier, weather AS breakdown_weather,
       day_of_week >= 5 AS is_weekend, is_night
FROM s"""


@register("surge_explanations", _surge_sql(), ops=("C6", "C1", "I-json"))
def surge_explanations(spark, sf_dir):
    r = B.rides(spark, sf_dir)
    s = r.select("trip_id", surge_explanation(price="price_usd").alias("resp"))
    return s.select("trip_id", "resp.estimated_price_usd", "resp.surge_active", "resp.surge_reason",
                    "resp.confidence", "resp.breakdown.base_fare", "resp.breakdown.distance_component",
                    "resp.breakdown.surge_multiplier", F.col("resp.breakdown.weather").alias("breakdown_weather"),
                    "resp.breakdown.is_weekend", "resp.breakdown.is_night")


# ---------------------------------------------------------------- C7 fraud flags (+ K4 batch features, H1)

@register("fraud_pattern_flags", with_(trips_cte(), fraud_trips_cte()) + """
, b AS (SELECT quantile_cont(fare_distance_ratio, 0.25) AS q1, quantile_cont(fare_distance_ratio, 0.75) AS q3 FROM fraud_trips)
SELECT trip_id, is_fraud, fraud_type, trip_count_today, cancellations_today, location_jump_km, duration_min,
       fare_distance_ratio,
       concat_ws(',',
         CASE WHEN speed_kmh > 90.0 AND location_jump_km > 15.0 THEN 'gps_spoofing' END,
         CASE WHEN fare_distance_ratio > b.q3 + 1.5 * (b.q3 - b.q1) THEN 'fare_manipulation' END,
         CASE WHEN duration_min <= 3.0 AND speed_kmh > 90.0 THEN 'fake_completion' END,
         CASE WHEN new_device = 1 AND location_jump_km > 15.0 THEN 'account_takeover' END,
         CASE WHEN trip_count_today >= 15 AND cancellations_today >= 3 THEN 'promo_abuse' END) AS patterns
FROM fraud_trips, b""", ops=("C7", "K4", "B18", "B19", "B23"))
def fraud_pattern_flags(spark, sf_dir):
    from ridewise.operators.stats import percentile
    ft = cut_lineage(B.fraud_trips(spark, sf_dir), "fraud-trips")       # read for the bound and for the flags
    q = percentile(ft, "fare_distance_ratio", [0.25, 0.75], name="q")
    bound = q.select((F.col("q")[1] + 1.5 * (F.col("q")[1] - F.col("q")[0])).alias("bound"))
    j = ft.crossJoin(F.broadcast(bound))
    return j.select("trip_id", "is_fraud", "fraud_type", "trip_count_today", "cancellations_today",
                    "location_jump_km", "duration_min", "fare_distance_ratio",
                    F.array_join(fraud_patterns(F.col("bound")), ",").alias("patterns"))


# ---------------------------------------------------------------- B4 price-request validation

def price_validation_sql():
    zones = ", ".join(repr(z) for z in K.ZONE_NAMES)
    checks = [
        ("hour", "hour BETWEEN 0 AND 23", "hour must be in [0, 23]"),
        ("day_of_week", "day_of_week BETWEEN 0 AND 6", "day_of_week must be in [0, 6]"),
        ("month", "month BETWEEN 1 AND 12", "month must be in [1, 12]"),
        ("distance_km", "distance_km > 0", "distance_km must be > 0"),
        ("weather", "weather IN ('sunny', 'cloudy', 'rainy', 'stormy')",
         "weather must be one of sunny, cloudy, rainy, stormy"),
        ("pickup_neighborhood", f"pickup_neighborhood IN ({zones})", "unknown pickup neighborhood"),
        ("dropoff_neighborhood", f"dropoff_neighborhood IN ({zones})", "unknown dropoff neighborhood"),
        ("driver_supply_ratio", "driver_supply_ratio BETWEEN 0 AND 1", "driver_supply_ratio must be in [0, 1]"),
        ("event_demand_multiplier", "event_demand_multiplier >= 1", "event_demand_multiplier must be >= 1"),
        ("active_drivers", "active_drivers >= 0", "active_drivers must be >= 0"),
        ("pending_requests", "pending_requests >= 0", "pending_requests must be >= 0"),
    ]
    parts = []
    for c, ok, msg in checks:
        parts.append(f"CASE WHEN {c} IS NULL THEN '{c} is required' END")
        parts.append(f"CASE WHEN {c} IS NOT NULL AND NOT ({ok}) THEN '{msg}' END")
    return with_(trips_cte(), rides_cte()) + f""", pr AS (
  SELECT trip_id AS request_id, hour, day_of_week, month,
         CASE WHEN trip_id % 89 = 0 THEN -1.0 ELSE distance_km END AS distance_km, weather,
         CASE WHEN trip_id % 97 = 0 THEN 'Atlantis' ELSE pickup_neighborhood END AS pickup_neighborhood,
         dropoff_neighborhood, driver_supply_ratio, event_demand_multiplier, active_drivers, pending_requests
  FROM rides), v AS (SELECT request_id, concat_ws('; ', {', '.join(parts)}) AS errors FROM pr)
SELECT request_id, errors = '' AS is_valid, errors FROM v"""


@register("price_request_validation", price_validation_sql(), ops=("B4", "A8"))
def price_request_validation(spark, sf_dir):
    v = validate.validate(B.price_requests(spark, sf_dir), validate.price_request_rules())
    return v.select("request_id", "is_valid", F.array_join("errors", "; ").alias("errors"))


# ---------------------------------------------------------------- B5 match-request validation

def match_requests_cte() -> str:
    """Tables ``mr`` (requests with their defaults) and ``v`` (with their errors)."""
    flags = validate.MATCH_FLAGS
    parts = ["CASE WHEN preferred_car_type IS NULL THEN 'preferred_car_type is required' END",
             f"CASE WHEN preferred_car_type IS NOT NULL AND NOT (preferred_car_type IN ({', '.join(repr(c) for c in K.CAR_TYPES)})) "
             f"THEN 'preferred_car_type must be one of {', '.join(K.CAR_TYPES)}' END"]
    for f in flags:
        parts.append(f"CASE WHEN {f} IS NOT NULL AND NOT ({f} IN (0, 1)) THEN '{f} must be 0 or 1' END")
    parts.append("CASE WHEN price_sensitivity IS NOT NULL AND NOT (price_sensitivity BETWEEN 0 AND 1) "
                 "THEN 'price_sensitivity must be in [0, 1]' END")
    parts.append(f"CASE WHEN top_k IS NOT NULL AND NOT (top_k BETWEEN 1 AND {K.MATCH_MAX_TOP_K}) "
                 f"THEN 'top_k must be in [1, {K.MATCH_MAX_TOP_K}]' END")
    flag_sel = ", ".join(
        (f"CAST(coalesce(CASE WHEN customer_id % 11 = 0 THEN NULL ELSE {f} END, 0) AS INTEGER) AS {f}"
         if f == "is_nightlife_user" else f"CAST(coalesce({f}, 0) AS INTEGER) AS {f}") for f in flags)
    return f"""mr AS (
  SELECT customer_id AS request_id, preferred_car_type, {flag_sel},
         coalesce(CASE WHEN customer_id % 13 = 0 THEN NULL ELSE price_sensitivity END, 0.5) AS price_sensitivity,
         CAST(coalesce(CASE WHEN customer_id % 17 = 0 THEN 25 WHEN customer_id % 19 = 0 THEN NULL
                            ELSE customer_id % 10 + 1 END, 5) AS INTEGER) AS top_k
  FROM customers), v AS (SELECT *, concat_ws('; ', {', '.join(parts)}) AS errors FROM mr)"""


def match_validation_sql():
    return with_(customers_cte(), match_requests_cte()) + f"""
SELECT request_id, preferred_car_type, {', '.join(validate.MATCH_FLAGS)}, price_sensitivity, top_k,
       errors = '' AS is_valid, errors FROM v"""


@register("match_request_validation", match_validation_sql(), ops=("B5", "A8", "B8"))
def match_request_validation(spark, sf_dir):
    m = validate.match_request_defaults(B.match_requests(spark, sf_dir))
    v = validate.validate(m, validate.match_request_rules())
    return v.select("request_id", "preferred_car_type", *validate.MATCH_FLAGS, "price_sensitivity", "top_k",
                    "is_valid", F.array_join("errors", "; ").alias("errors"))


# ---------------------------------------------------------------- B9 alphabetical encoder

@register("zone_label_codes", with_(trips_cte()) + """
, v AS (SELECT neighborhood AS value FROM trips WHERE neighborhood IS NOT NULL
        UNION SELECT dropoff_neighborhood FROM trips WHERE dropoff_neighborhood IS NOT NULL)
SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS INTEGER) AS code FROM v""", ops=("B9", "Q2"))
def zone_label_codes(spark, sf_dir):
    t = B.trips(spark, sf_dir)
    return fit_alphabetical(t, ["neighborhood", "dropoff_neighborhood"], "code")


@register("encoded_rides", with_(trips_cte(), rides_cte()) + """
, v AS (SELECT pickup_neighborhood AS value FROM rides WHERE pickup_neighborhood IS NOT NULL
        UNION SELECT dropoff_neighborhood FROM rides WHERE dropoff_neighborhood IS NOT NULL),
c AS (SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS INTEGER) AS code FROM v)
SELECT r.trip_id, p.code AS pickup_enc, d.code AS dropoff_enc
FROM rides r LEFT JOIN c p ON r.pickup_neighborhood = p.value LEFT JOIN c d ON r.dropoff_neighborhood = d.value""",
          ops=("B9",))
def encoded_rides(spark, sf_dir):
    r = B.rides(spark, sf_dir).select("trip_id", "pickup_neighborhood", "dropoff_neighborhood")
    codes = fit_alphabetical(r, ["pickup_neighborhood", "dropoff_neighborhood"], "code")
    r = apply_codes(r, codes, "pickup_neighborhood", "pickup_enc", handle_invalid="error")
    r = apply_codes(r, codes, "dropoff_neighborhood", "dropoff_enc", handle_invalid="error")
    return r.select("trip_id", "pickup_enc", "dropoff_enc")


# ---------------------------------------------------------------- B10 B24 ordinal codes and flags

@register("customer_profile_codes", with_(customers_cte()) + """
SELECT customer_id, preferred_car_type, preferred_car_enc, is_nightlife_user, is_airport_user, is_event_user
FROM customers""", ops=("B10", "B24"))
def customer_profile_codes(spark, sf_dir):
    c = B.customers(spark, sf_dir)
    return c.select("customer_id", "preferred_car_type",
                    ordinal_code("preferred_car_type", K.CAR_TYPES).alias("preferred_car_enc"),
                    "is_nightlife_user", "is_airport_user", "is_event_user")


@register("driver_profile_flags", with_(drivers_cte()) + """
SELECT driver_id, car_type_enc, specialties, is_nightlife_spec, is_airport_spec, is_event_spec, is_wedding_spec,
       speaks_spanish, speaks_english
FROM drivers""", ops=("B10", "B24"))
def driver_profile_flags(spark, sf_dir):
    d = B.drivers(spark, sf_dir)
    return d.select("driver_id", ordinal_code("car_type", K.CAR_TYPES).alias("car_type_enc"), "specialties",
                    "is_nightlife_spec", "is_airport_spec", "is_event_spec", "is_wedding_spec",
                    "speaks_spanish", "speaks_english")


# ---------------------------------------------------------------- D1 D2 strict / skipping lookup

@register("interaction_driver_lookup", with_(drivers_cte(), interactions_cte(False)) + """
SELECT i.order_id, i.line_no, i.driver_id, d.rating, d.car_type
FROM interactions i JOIN drivers d ON i.driver_id = d.driver_id""", ops=("D1", "D2"))
def interaction_driver_lookup(spark, sf_dir):
    i = B.interactions(spark, sf_dir, with_compatibility=False).select("order_id", "line_no", "driver_id")
    d = B.drivers(spark, sf_dir).select("driver_id", "rating", "car_type")
    return lookup.lookup(i, d, "driver_id")


@register("interaction_missing_drivers", with_(drivers_cte(), interactions_cte(False)) + """
SELECT DISTINCT i.driver_id FROM interactions i
WHERE i.driver_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM drivers d WHERE d.driver_id = i.driver_id)""",
          ops=("D1",))
def interaction_missing_drivers(spark, sf_dir):
    i = B.interactions(spark, sf_dir, with_compatibility=False)
    return lookup.missing_keys(i, B.drivers(spark, sf_dir), "driver_id")


# ---------------------------------------------------------------- D4 score lookup with default

@register("driver_score_default", with_(drivers_cte(), interactions_cte(False)) + """
, s AS (SELECT driver_id, avg(explicit_rating) AS score FROM interactions GROUP BY driver_id)
SELECT d.driver_id, round(coalesce(s.score, 0.0), 6) AS score
FROM drivers d LEFT JOIN s ON d.driver_id = s.driver_id""", ops=("D4",))
def driver_score_default(spark, sf_dir):
    i = B.interactions(spark, sf_dir, with_compatibility=False)
    s = i.groupBy("driver_id").agg(F.avg("explicit_rating").alias("score"))
    d = B.drivers(spark, sf_dir).select("driver_id")
    out = lookup.lookup_with_default(d, s, ["driver_id"], "score", 0.0)
    return out.select("driver_id", F.round("score", 6).alias("score"))


# ---------------------------------------------------------------- D5 point lookup

@register("driver_point_lookup", with_(drivers_cte()) + """
, ids AS (SELECT CAST(n_nationkey * 7 AS BIGINT) AS driver_id FROM nation)
SELECT ids.driver_id, d.rating, d.car_type, d.driver_id IS NOT NULL AS found
FROM ids LEFT JOIN drivers d ON ids.driver_id = d.driver_id""", ops=("D5",))
def driver_point_lookup(spark, sf_dir):
    from ridewise.sources.tables import read_table
    ids = read_table(spark, sf_dir, "nation").select((F.col("n_nationkey") * 7).cast("bigint").alias("driver_id"))
    d = B.drivers(spark, sf_dir).select("driver_id", "rating", "car_type")
    return lookup.point_lookup(ids, d, "driver_id").select("driver_id", "rating", "car_type", "found")


# ---------------------------------------------------------------- D11 dense index

@register("customer_dense_index", with_(interactions_cte(False)) + """
, c AS (SELECT DISTINCT customer_id FROM interactions WHERE customer_id IS NOT NULL)
SELECT customer_id, CAST(row_number() OVER (ORDER BY customer_id) - 1 AS BIGINT) AS idx FROM c""", ops=("D11",))
def customer_dense_index(spark, sf_dir):
    i = B.interactions(spark, sf_dir, with_compatibility=False)
    return lookup.dense_index(i, "customer_id", "idx")
