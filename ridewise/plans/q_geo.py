"""Geo and demand-map queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridewise import constants as K
from ridewise.functions import calendar as cal
from ridewise.functions.encode import apply_codes, fit_alphabetical
from ridewise.operators import geo, kpi
from ridewise.plans.catalog import register
from ridewise.plans.sql_views import (D, ZNL, ZTR, demand_factor_cte, demand_score_sql, geo_trips_cte, pick, rhu, trips_cte,
                                      with_, zones_cte)
from ridewise.sources import bindings as B

R6 = 6

_NEAREST_SQL = with_(trips_cte(), zones_cte()) + f"""
, c AS (SELECT t.trip_id, z.zone, z.zone_idx,
               sqrt((t.pickup_lat - z.lat) * (t.pickup_lat - z.lat) + (t.pickup_lon - z.lon) * (t.pickup_lon - z.lon)) AS dist
        FROM trips t CROSS JOIN zones z),
r AS (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY dist, zone_idx) AS rn FROM c)
SELECT trip_id, zone AS nearest_zone, round(dist, 9) AS nearest_dist FROM r
WHERE rn = 1 AND dist <= {D(K.GRID_MAX_DIST)}"""


@register("trip_nearest_zone", _NEAREST_SQL, ops=("D7",))
def trip_nearest_zone(spark, sf_dir):
    t = B.trips(spark, sf_dir).select("trip_id", "pickup_lat", "pickup_lon")
    a = geo.assign_zone(t, "pickup_lat", "pickup_lon", K.GRID_MAX_DIST)
    return a.select("trip_id", "nearest_zone", F.round("nearest_dist", 9).alias("nearest_dist"))


@register("trip_nearest_zone_cells", _NEAREST_SQL, ops=("D7",))
def trip_nearest_zone_cells(spark, sf_dir):
    t = B.trips(spark, sf_dir).select("trip_id", "pickup_lat", "pickup_lon")
    z = B.zones(spark).select("zone_idx", "lat", "lon")
    j = geo.nearest_centroid_join(t, z, "trip_id", "pickup_lat", "pickup_lon", K.GRID_MAX_DIST)
    names = F.array(*[F.lit(n) for n in K.ZONE_NAMES])
    return j.select("trip_id", F.element_at(names, F.col("nearest_zone") + 1).alias("nearest_zone"),
                    F.round("nearest_dist", 9).alias("nearest_dist"))


def _grid_sql():
    n_lat = geo.grid_axis_size(K.GRID_LAT_START, K.GRID_LAT_STOP, K.GRID_RESOLUTION)
    n_lon = geo.grid_axis_size(K.GRID_LON_START, K.GRID_LON_STOP, K.GRID_RESOLUTION)
    hours = ", ".join(f"({h})" for h in K.GRID_HOURS)
    ds = demand_score_sql("g.hour", "(isodow(g.date) - 1)", str(K.GRID_SCENARIO_MONTH),
                          pick(ZNL, "g.zone_idx"), pick(ZTR, "g.zone_idx"), "f.event_factor")
    return with_(trips_cte(), zones_cte(), demand_factor_cte("trips")) + f"""
, days AS (SELECT DISTINCT date FROM trips WHERE isodow(date) - 1 = {K.GRID_SCENARIO_DOW}),
pts AS (SELECT {D(K.GRID_LAT_START)} + a.i * {D(K.GRID_RESOLUTION)} AS lat, {D(K.GRID_LON_START)} + b.j * {D(K.GRID_RESOLUTION)} AS lon,
                 CAST(h.hour AS INTEGER) AS hour
          FROM (SELECT range AS i FROM range({n_lat})) a, (SELECT range AS j FROM range({n_lon})) b, (VALUES {hours}) h(hour)),
c AS (SELECT p.*, z.zone, z.zone_idx,
             sqrt((p.lat - z.lat) * (p.lat - z.lat) + (p.lon - z.lon) * (p.lon - z.lon)) AS dist FROM pts p CROSS JOIN zones z),
g0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lat, lon, hour ORDER BY dist, zone_idx) AS rn FROM c)
      WHERE rn = 1 AND dist <= {D(K.GRID_MAX_DIST)}),
g AS (SELECT g0.*, d.date FROM g0 CROSS JOIN days d)
SELECT g.date, {rhu('g.lat', 4)} AS lat, {rhu('g.lon', 4)} AS lon, g.hour,
       {rhu(f'{ds} * greatest({D(0.0)}, {D(1.0)} - g.dist / {D(K.GRID_DECAY_DIST)})', 3)} AS demand,
       g.zone AS neighborhood
FROM g LEFT JOIN dfactor f ON f.date = g.date AND f.zone = g.zone"""


def _scenario_days(spark, sf_dir):
    t = B.trips(spark, sf_dir).select("date")
    days = t.where(F.weekday("date") == K.GRID_SCENARIO_DOW).distinct()
    return days, B.demand_factor_by_date_zone(spark, t)


@register("grid_demand", _grid_sql(), ops=("J28", "D8", "D7", "C2", "C3"))
def grid_demand(spark, sf_dir):
    days, factors = _scenario_days(spark, sf_dir)
    return geo.grid_demand(spark, days, factors)


def _pivot_sql():
    cols = ", ".join(f'round(avg(demand_score) FILTER (WHERE hour = {h}), {R6}) AS "{h}"' for h in range(24))
    return with_(trips_cte(), geo_trips_cte()) + f"""
SELECT neighborhood, {cols} FROM geo_trips WHERE neighborhood IS NOT NULL GROUP BY neighborhood"""


@register("zone_hour_demand_pivot", _pivot_sql(), ops=("E10",))
def zone_hour_demand_pivot(spark, sf_dir):
    p = kpi.pivot_mean(B.geo_trips(spark, sf_dir), "neighborhood", "hour", "demand_score", list(range(24)))
    return p.select("neighborhood", *[F.round(F.col(str(h)), R6).alias(str(h)) for h in range(24)])


@register("zone_bubbles", with_(trips_cte(), geo_trips_cte()) + f"""
, s AS (SELECT neighborhood, count(*) AS trips, avg(demand_score) AS avg_demand FROM geo_trips
        WHERE neighborhood IS NOT NULL GROUP BY neighborhood)
SELECT neighborhood, trips, round(avg_demand, {R6}) AS avg_demand,
       round(10.0 + 35.0 * trips / (SELECT max(trips) FROM s), {R6}) AS radius
FROM s""", ops=("E18",))
def zone_bubbles(spark, sf_dir):
    v = geo.zone_volume(B.geo_trips(spark, sf_dir), "neighborhood", "demand_score")
    return v.select("neighborhood", "trips", F.round("avg_value", R6).alias("avg_demand"),
                    F.round("radius", R6).alias("radius"))


@register("zone_mean_demand", with_(trips_cte(), geo_trips_cte(), zones_cte()) + f"""
, s AS (SELECT neighborhood, avg(demand_score) AS m FROM geo_trips WHERE neighborhood IS NOT NULL GROUP BY neighborhood)
SELECT z.zone AS neighborhood, round(s.m, {R6}) AS avg_demand FROM zones z LEFT JOIN s ON z.zone = s.neighborhood""",
          ops=("E19", "B3"))
def zone_mean_demand(spark, sf_dir):
    g = B.geo_trips(spark, sf_dir)
    z = B.zones(spark).select(F.col("zone").alias("neighborhood"))
    m = geo.zone_means(g, z, "neighborhood", "demand_score")
    return m.select("neighborhood", F.round("avg_value", R6).alias("avg_demand"))


def _frames_sql_v2():
    base = _grid_sql()
    return f"""WITH grid AS ({base})
SELECT date, hour, printf('%02d:00', hour) AS label,
       count(*) FILTER (WHERE demand > {D(0.05)}) AS n_points,
       coalesce(string_agg(printf('%.4f,%.4f,%.3f', lat, lon, demand), ';' ORDER BY lat, lon, demand)
                FILTER (WHERE demand > {D(0.05)}), '') AS frame
FROM grid GROUP BY date, hour"""


@register("demand_map_frames", _frames_sql_v2(), ops=("E20", "B2", "I-format"))
def demand_map_frames(spark, sf_dir):
    days, factors = _scenario_days(spark, sf_dir)
    f = geo.map_frames(geo.grid_demand(spark, days, factors), "hour", "demand", 0.05)
    txt = F.transform("points", lambda p: F.format_string("%.4f,%.4f,%.3f", p["lat"], p["lon"], p["weight"]))
    return f.select("date", "hour", "label", F.size("points").cast("bigint").alias("n_points"),
                    F.array_join(txt, ";").alias("frame"))


@register("pickup_heat_cells", with_(trips_cte(), geo_trips_cte()) + f"""
SELECT CAST(floor(pickup_lat / {D(K.GRID_RESOLUTION)}) AS BIGINT) AS cell_x,
       CAST(floor(pickup_lon / {D(K.GRID_RESOLUTION)}) AS BIGINT) AS cell_y,
       count(*) AS points, round(sum(demand_score), {R6}) AS weight
FROM geo_trips WHERE pickup_lat IS NOT NULL AND pickup_lon IS NOT NULL GROUP BY 1, 2""", ops=("E21",))
def pickup_heat_cells(spark, sf_dir):
    h = geo.heat_cells(B.geo_trips(spark, sf_dir), "pickup_lat", "pickup_lon", "demand_score")
    return h.select("cell_x", "cell_y", "points", F.round("weight", R6).alias("weight"))


@register("trip_zone_centroids", with_(trips_cte(), zones_cte()) + """
SELECT t.trip_id, t.neighborhood, z.lat AS zone_lat, z.lon AS zone_lon
FROM trips t JOIN zones z ON t.neighborhood = z.zone""", ops=("D6",))
def trip_zone_centroids(spark, sf_dir):
    t = B.trips(spark, sf_dir).select("trip_id", "neighborhood")
    z = B.zones(spark).select(F.col("zone").alias("neighborhood"), F.col("lat").alias("zone_lat"),
                              F.col("lon").alias("zone_lon"))
    return t.join(F.broadcast(z), "neighborhood").select("trip_id", "neighborhood", "zone_lat", "zone_lon")


def _scenario_sql():
    zl = ", ".join(f"('{z}')" for z in K.SCENARIO_ZONES)
    return with_(trips_cte()) + f"""
, v AS (SELECT neighborhood AS value FROM trips WHERE neighborhood IS NOT NULL),
codes AS (SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT value FROM v)),
s AS (SELECT CAST(h.range AS INTEGER) AS hour, z.neighborhood FROM range(24) h, (VALUES {zl}) z(neighborhood))
SELECT s.hour, s.neighborhood, round(sin(2 * pi() * s.hour / 24), {R6}) AS hour_sin,
       round(cos(2 * pi() * s.hour / 24), {R6}) AS hour_cos,
       round(sin(2 * pi() * {K.GRID_SCENARIO_DOW} / 7), {R6}) AS dow_sin, round(cos(2 * pi() * {K.GRID_SCENARIO_DOW} / 7), {R6}) AS dow_cos,
       round(sin(2 * pi() * {K.GRID_SCENARIO_MONTH} / 12), {R6}) AS month_sin, round(cos(2 * pi() * {K.GRID_SCENARIO_MONTH} / 12), {R6}) AS month_cos,
       1 AS is_weekend, c.code AS neighborhood_enc
FROM s LEFT JOIN codes c ON s.neighborhood = c.value"""


@register("scenario_features", _scenario_sql(), ops=("D9", "B16", "B9"))
def scenario_features(spark, sf_dir):
    codes = fit_alphabetical(B.trips(spark, sf_dir), ["neighborhood"], "code")
    s = geo.scenario_grid(spark, K.SCENARIO_ZONES, K.GRID_SCENARIO_DOW, K.GRID_SCENARIO_MONTH)
    s = cal.add_cyclical(s, {"hour": ("hour", 24), "dow": ("day_of_week", 7), "month": ("month", 12)})
    s = apply_codes(s, codes, "neighborhood", "neighborhood_enc")
    cyc = [F.round(f"{n}_{f}", R6).alias(f"{n}_{f}") for n in ("hour", "dow", "month") for f in ("sin", "cos")]
    return s.select("hour", "neighborhood", *cyc, "is_weekend", "neighborhood_enc")
