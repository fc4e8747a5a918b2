"""KPI dashboard queries (E, F, G and B families) with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridewise import constants as K
from ridewise.functions import calendar as cal
from ridewise.functions.exprs import format_id, value_map
from ridewise.operators import kpi, sketch, stats, window
from ridewise.plans.catalog import register
from ridewise.session import cut_lineage
from ridewise.plans.sql_views import (D, daily_kpis_cte, drivers_cte, trips_cte, with_)
from ridewise.sources import bindings as B

R6 = 6   # digits kept on averages and other non-cent values

# ---------------------------------------------------------------- E7 (flagship)

WEEKLY_SQL = with_(daily_kpis_cte()) + """,
wk AS (SELECT CAST(date + CAST(7 - isodow(date) AS INTEGER) AS DATE) AS week, sum(total_revenue) AS rev, sum(total_trips) AS trips
       FROM daily_kpis WHERE date IS NOT NULL GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM wk)
SELECT s.week, round(coalesce(w.rev, 0), 4) AS total_revenue, CAST(coalesce(w.trips, 0) AS BIGINT) AS total_trips
FROM spine s LEFT JOIN wk w ON s.week = w.week"""


@register("weekly_revenue", WEEKLY_SQL, ops=("E7",))
def weekly_revenue(spark, sf_dir):
    d = B.daily_kpis(spark, sf_dir)
    w = kpi.weekly_resample(d, "date", {"total_revenue": "total_revenue", "total_trips": "total_trips"})
    return w.select("week", F.round("total_revenue", 4).alias("total_revenue"),
                    F.col("total_trips").cast("bigint").alias("total_trips"))


# ---------------------------------------------------------------- E1 KPI cards

@register("kpi_cards", with_(daily_kpis_cte()) + f"""
SELECT round(sum(total_revenue), 4) AS total_revenue, CAST(sum(total_trips) AS BIGINT) AS total_trips,
       round(avg(avg_fare), {R6}) AS avg_fare, round(avg(avg_rating), {R6}) AS avg_rating,
       round(avg(driver_utilization), {R6}) AS avg_utilization
FROM daily_kpis""", ops=("E1", "B20"))
def kpi_cards(spark, sf_dir):
    d = B.daily_kpis(spark, sf_dir)
    c = kpi.kpi_cards(d, sums={"total_revenue": "total_revenue", "total_trips": "total_trips"},
                      means={"avg_fare": "avg_fare", "avg_rating": "avg_rating",
                             "avg_utilization": "driver_utilization"})
    return c.select(F.round("total_revenue", 4).alias("total_revenue"),
                    F.col("total_trips").cast("bigint").alias("total_trips"),
                    *[F.round(x, R6).alias(x) for x in ["avg_fare", "avg_rating", "avg_utilization"]])


# ---------------------------------------------------------------- E4 + B1

MONTHS_SELECTED = [1, 2, 3]


@register("revenue_kpis_months", with_(daily_kpis_cte()) + f"""
SELECT round(sum(total_revenue), 4) AS total_revenue, round(max(total_revenue), 4) AS best_day,
       round(avg(total_revenue), {R6}) AS avg_daily_revenue, count(*) AS days
FROM daily_kpis WHERE month IN (1, 2, 3)""", ops=("E4", "B1"))
def revenue_kpis_months(spark, sf_dir):
    d = B.daily_kpis(spark, sf_dir).where(F.col("month").isin(MONTHS_SELECTED))
    return d.agg(F.round(F.sum("total_revenue"), 4).alias("total_revenue"),
                 F.round(F.max("total_revenue"), 4).alias("best_day"),
                 F.round(F.avg("total_revenue"), R6).alias("avg_daily_revenue"),
                 F.count(F.lit(1)).alias("days"))


# ---------------------------------------------------------------- E2 trip KPIs

@register("trip_kpis", with_(trips_cte()) + f"""
SELECT round(avg(fare_usd), {R6}) AS avg_fare, round(avg(completed), {R6}) AS completion_rate,
       round(avg(distance_km), {R6}) AS avg_distance, count(*) AS trips
FROM trips""", ops=("E2",))
def trip_kpis(spark, sf_dir):
    t = B.trips(spark, sf_dir)
    return t.agg(F.round(F.avg("fare_usd"), R6).alias("avg_fare"),
                 F.round(F.avg("completed"), R6).alias("completion_rate"),
                 F.round(F.avg("distance_km"), R6).alias("avg_distance"),
                 F.count(F.lit(1)).alias("trips"))


# ---------------------------------------------------------------- E3 driver KPIs

@register("driver_kpis", with_(drivers_cte()) + f"""
SELECT count(*) AS active_drivers, round(avg(weekly_trips), {R6}) AS avg_weekly_trips,
       round(avg(rating), {R6}) AS avg_rating, round(avg(on_time_rate), {R6}) AS avg_on_time
FROM drivers""", ops=("E3",))
def driver_kpis(spark, sf_dir):
    d = B.drivers(spark, sf_dir)
    return d.agg(F.count(F.lit(1)).alias("active_drivers"),
                 F.round(F.avg("weekly_trips"), R6).alias("avg_weekly_trips"),
                 F.round(F.avg("rating"), R6).alias("avg_rating"),
                 F.round(F.avg("on_time_rate"), R6).alias("avg_on_time"))


# ---------------------------------------------------------------- E5 value counts

@register("zone_trip_counts", with_(trips_cte()) + """
SELECT neighborhood, count(*) AS trips FROM trips WHERE neighborhood IS NOT NULL GROUP BY neighborhood""",
          ops=("E5", "B7"))
def zone_trip_counts(spark, sf_dir):
    return kpi.frequency(B.trips(spark, sf_dir), "neighborhood", "trips")


@register("driver_car_counts", with_(drivers_cte()) + """
SELECT car_type, count(*) AS drivers FROM drivers WHERE car_type IS NOT NULL GROUP BY car_type""",
          ops=("E5",))
def driver_car_counts(spark, sf_dir):
    return kpi.frequency(B.drivers(spark, sf_dir), "car_type", "drivers")


# ---------------------------------------------------------------- E6 group mean + count

@register("fare_by_trip_type", with_(trips_cte()) + f"""
SELECT trip_type, round(avg(fare_usd), {R6}) AS avg_fare, count(fare_usd) AS count
FROM trips WHERE trip_type IS NOT NULL GROUP BY trip_type""", ops=("E6", "G4"))
def fare_by_trip_type(spark, sf_dir):
    g = kpi.group_mean_count(B.trips(spark, sf_dir), "trip_type", "fare_usd", "avg_fare", "count")
    return g.select("trip_type", F.round("avg_fare", R6).alias("avg_fare"), "count")


# ---------------------------------------------------------------- E8 + B21

@register("monthly_revenue", with_(daily_kpis_cte()) + """
SELECT month, CASE month WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Apr'
                         WHEN 5 THEN 'May' WHEN 6 THEN 'Jun' END AS month_label,
       round(sum(total_revenue), 4) AS total_revenue
FROM daily_kpis WHERE month IS NOT NULL GROUP BY month""", ops=("E8", "B21"))
def monthly_revenue(spark, sf_dir):
    g = kpi.group_sum(B.daily_kpis(spark, sf_dir), "month", {"total_revenue": "total_revenue"})
    return g.select("month", value_map("month", K.MONTH_LABELS).alias("month_label"),
                    F.round("total_revenue", 4).alias("total_revenue"))


# ---------------------------------------------------------------- E9 + B21

@register("weekend_revenue_split", with_(daily_kpis_cte()) + f"""
, g AS (SELECT is_weekend, sum(total_revenue) AS rev FROM daily_kpis WHERE is_weekend IS NOT NULL GROUP BY is_weekend)
SELECT CASE is_weekend WHEN 0 THEN 'Weekday' WHEN 1 THEN 'Weekend' END AS day_type,
       round(rev, 4) AS total_revenue, round(rev / (SELECT sum(rev) FROM g), {R6}) AS share
FROM g""", ops=("E9", "B21"))
def weekend_revenue_split(spark, sf_dir):
    g = kpi.group_sum(B.daily_kpis(spark, sf_dir), "is_weekend", {"rev": "total_revenue"})
    g = kpi.with_share(g, "rev", "share")
    return g.select(value_map("is_weekend", K.DAY_TYPE_LABELS).alias("day_type"),
                    F.round("rev", 4).alias("total_revenue"), F.round("share", R6).alias("share"))


# ---------------------------------------------------------------- E11 pivot

def _pivot_sql():
    cols = ",\n  ".join(
        f"CASE WHEN count(*) FILTER (WHERE dayname(date) = '{d}') = 0 THEN NULL "
        f"ELSE count(*) FILTER (WHERE dayname(date) = '{d}') END AS {d}" for d in K.WEEKDAY_NAMES)
    return with_(trips_cte()) + f"SELECT hour,\n  {cols}\nFROM trips WHERE hour IS NOT NULL AND date IS NOT NULL GROUP BY hour"


@register("hour_weekday_pivot", _pivot_sql(), ops=("E11", "B22"))
def hour_weekday_pivot(spark, sf_dir):
    return kpi.pivot_count_ordered(B.trips(spark, sf_dir), "hour", "date", K.WEEKDAY_NAMES)


# ---------------------------------------------------------------- E12 percentile

@register("fare_p95_by_type", with_(trips_cte()) + f"""
SELECT trip_type, round(quantile_cont(fare_usd, 0.95), {R6}) AS p95_fare, round(median(fare_usd), {R6}) AS median_fare
FROM trips WHERE trip_type IS NOT NULL AND fare_usd IS NOT NULL GROUP BY trip_type""", ops=("E12", "E13"))
def fare_p95_by_type(spark, sf_dir):
    t = B.trips(spark, sf_dir).where(F.col("trip_type").isNotNull() & F.col("fare_usd").isNotNull())
    q = stats.percentile(t, "fare_usd", [0.95, 0.5], group="trip_type", name="q")
    return q.select("trip_type", F.round(F.col("q")[0], R6).alias("p95_fare"),
                    F.round(F.col("q")[1], R6).alias("median_fare"))


SKETCH_PS = [0.05, 0.25, 0.5, 0.75, 0.95]


@register("fare_sketch_ranks", with_(trips_cte()) + f"""
SELECT trip_type, unnest(CAST({SKETCH_PS} AS DOUBLE[])) AS p, count(*) AS n, true AS within_bound
FROM trips WHERE trip_type IS NOT NULL AND fare_usd IS NOT NULL GROUP BY trip_type""", ops=("E12", "E13"))
def fare_sketch_ranks(spark, sf_dir):
    """Quantiles from stored sketches of single days, merged by trip type: their
    exact rank in the table lies within the sketch's bound."""
    t = B.trips(spark, sf_dir).where(F.col("trip_type").isNotNull() & F.col("fare_usd").isNotNull()).select("trip_type", "date", "fare_usd")
    days = cut_lineage(sketch.sketch(t, "fare_usd", ["trip_type", "date"]), "fare-sketches")
    q = sketch.quantiles(sketch.merge(days, ["trip_type"]), SKETCH_PS)
    q = q.select("trip_type", "n", F.posexplode("quantiles").alias("i", "value")).withColumn("p", F.element_at(F.array(*map(F.lit, SKETCH_PS)), F.col("i") + 1))
    at = (t.join(F.broadcast(q), "trip_type").groupBy("trip_type", "p", "n")          # five quantiles a trip type
           .agg(F.sum((F.col("fare_usd") < F.col("value")).cast("long")).alias("below"),
                F.sum((F.col("fare_usd") <= F.col("value")).cast("long")).alias("upto")))
    e = sketch.rank_error()
    return at.select("trip_type", "p", "n", ((F.col("below") / F.col("n") <= F.col("p") + e) & (F.col("upto") / F.col("n") >= F.col("p") - e))
                     .alias("within_bound"))


# ---------------------------------------------------------------- E13 / E14 / B25

@register("driver_quadrants", with_(drivers_cte()) + f"""
, m AS (SELECT median(weekly_trips) AS mx, median(rating) AS my FROM drivers)
SELECT driver_id, weekly_trips, rating, round(weekly_revenue / 10, 4) AS revenue_size,
       mx AS median_x, my AS median_y,
       CASE WHEN weekly_trips >= mx AND rating >= my THEN 'high volume, high rating'
            WHEN weekly_trips >= mx THEN 'high volume, low rating'
            WHEN rating >= my THEN 'low volume, high rating'
            ELSE 'low volume, low rating' END AS quadrant
FROM drivers, m""", ops=("E13", "E14", "B25"))
def driver_quadrants(spark, sf_dir):
    d = B.drivers(spark, sf_dir).select("driver_id", "weekly_trips", "rating", "weekly_revenue")
    q = stats.quadrant_labels(d, "weekly_trips", "rating")
    return q.select("driver_id", "weekly_trips", "rating",
                    F.round(F.col("weekly_revenue") / 10, 4).alias("revenue_size"),
                    F.col("median_x").cast("double").alias("median_x"),
                    F.col("median_y").cast("double").alias("median_y"), "quadrant")


# ---------------------------------------------------------------- E15 box summary

@register("daily_trips_box", with_(daily_kpis_cte()) + f"""
, src AS (SELECT CASE is_weekend WHEN 0 THEN 'Weekday' WHEN 1 THEN 'Weekend' END AS day_type, total_trips
          FROM daily_kpis WHERE is_weekend IS NOT NULL),
q AS (SELECT day_type, count(*) AS n, min(total_trips) AS mn, quantile_cont(total_trips, 0.25) AS q1,
             quantile_cont(total_trips, 0.5) AS med, quantile_cont(total_trips, 0.75) AS q3, max(total_trips) AS mx
      FROM src GROUP BY day_type),
w AS (SELECT s.day_type,
             min(CASE WHEN s.total_trips >= q.q1 - 1.5 * (q.q3 - q.q1) AND s.total_trips <= q.q3 + 1.5 * (q.q3 - q.q1) THEN s.total_trips END) AS lw,
             max(CASE WHEN s.total_trips >= q.q1 - 1.5 * (q.q3 - q.q1) AND s.total_trips <= q.q3 + 1.5 * (q.q3 - q.q1) THEN s.total_trips END) AS uw,
             sum(CASE WHEN s.total_trips >= q.q1 - 1.5 * (q.q3 - q.q1) AND s.total_trips <= q.q3 + 1.5 * (q.q3 - q.q1) THEN 0 ELSE 1 END) AS n_out
      FROM src s JOIN q ON s.day_type = q.day_type GROUP BY s.day_type)
SELECT q.day_type, q.n, CAST(q.mn AS DOUBLE) AS min, round(q.q1, {R6}) AS q1, round(q.med, {R6}) AS median,
       round(q.q3, {R6}) AS q3, CAST(q.mx AS DOUBLE) AS max, CAST(w.lw AS DOUBLE) AS lower_whisker,
       CAST(w.uw AS DOUBLE) AS upper_whisker, CAST(w.n_out AS BIGINT) AS n_outliers
FROM q JOIN w ON q.day_type = w.day_type""", ops=("E15", "B21"))
def daily_trips_box(spark, sf_dir):
    d = B.daily_kpis(spark, sf_dir).where(F.col("is_weekend").isNotNull()) \
        .select(value_map("is_weekend", K.DAY_TYPE_LABELS).alias("day_type"),
                F.col("total_trips").cast("double").alias("total_trips"))
    b = stats.box_summary(d, "day_type", "total_trips")
    return b.select("day_type", "n", "min", F.round("q1", R6).alias("q1"), F.round("median", R6).alias("median"),
                    F.round("q3", R6).alias("q3"), "max", "lower_whisker", "upper_whisker",
                    F.col("n_outliers").cast("bigint").alias("n_outliers"))


# ---------------------------------------------------------------- E16 violin

@register("fare_violin_by_car", with_(trips_cte()) + f"""
, src AS (SELECT car_type, fare_usd FROM trips WHERE car_type IS NOT NULL AND fare_usd IS NOT NULL),
rng AS (SELECT car_type, min(fare_usd) AS lo, max(fare_usd) AS hi, count(*) AS n,
               CASE WHEN (max(fare_usd) - min(fare_usd)) / 20 > 0 THEN (max(fare_usd) - min(fare_usd)) / 20 ELSE 1.0 END AS width,
               quantile_cont(fare_usd, 0.25) AS q1, quantile_cont(fare_usd, 0.5) AS med, quantile_cont(fare_usd, 0.75) AS q3
        FROM src GROUP BY car_type),
b AS (SELECT s.car_type, CAST(least(floor((s.fare_usd - r.lo) / r.width), 19) AS INTEGER) AS bin, count(*) AS cnt
      FROM src s JOIN rng r ON s.car_type = r.car_type GROUP BY 1, 2),
spine AS (SELECT car_type, lo, width, n, q1, med, q3, CAST(unnest(range(0, 20)) AS INTEGER) AS bin FROM rng)
SELECT s.car_type, s.bin, round(s.lo + s.bin * s.width, {R6}) AS bin_lo,
       CAST(coalesce(b.cnt, 0) AS BIGINT) AS count,
       round(coalesce(b.cnt, 0) / (s.n * s.width), {R6}) AS density,
       round(s.q1, {R6}) AS q1, round(s.med, {R6}) AS median, round(s.q3, {R6}) AS q3
FROM spine s LEFT JOIN b ON s.car_type = b.car_type AND s.bin = b.bin""", ops=("E16", "E17"))
def fare_violin_by_car(spark, sf_dir):
    t = B.trips(spark, sf_dir).select("car_type", "fare_usd")
    v = stats.violin_summary(t, "car_type", "fare_usd", bins=20)
    return v.select("car_type", "bin", F.round("bin_lo", R6).alias("bin_lo"), "count",
                    F.round("density", R6).alias("density"), F.round("q1", R6).alias("q1"),
                    F.round("median", R6).alias("median"), F.round("q3", R6).alias("q3"))


# ---------------------------------------------------------------- E17 histogram

@register("driver_rating_histogram", with_(drivers_cte()) + f"""
, rng AS (SELECT min(rating) AS lo, max(rating) AS hi, count(*) AS n,
                 CASE WHEN (max(rating) - min(rating)) / 20 > 0 THEN (max(rating) - min(rating)) / 20 ELSE 1.0 END AS width
          FROM drivers WHERE rating IS NOT NULL),
b AS (SELECT CAST(least(floor((d.rating - r.lo) / r.width), 19) AS INTEGER) AS bin, count(*) AS cnt
      FROM drivers d, rng r WHERE d.rating IS NOT NULL GROUP BY 1),
spine AS (SELECT lo, width, CAST(unnest(range(0, 20)) AS INTEGER) AS bin FROM rng)
SELECT s.bin, round(s.lo + s.bin * s.width, {R6}) AS bin_lo, round(s.lo + (s.bin + 1) * s.width, {R6}) AS bin_hi,
       CAST(coalesce(b.cnt, 0) AS BIGINT) AS count
FROM spine s LEFT JOIN b ON s.bin = b.bin""", ops=("E17",))
def driver_rating_histogram(spark, sf_dir):
    h = stats.histogram(B.drivers(spark, sf_dir), "rating", 20)
    return h.select("bin", F.round("bin_lo", R6).alias("bin_lo"), F.round("bin_hi", R6).alias("bin_hi"), "count")


# ---------------------------------------------------------------- E22 / E23 trend

@register("revenue_cancellation_trend", with_(daily_kpis_cte()) + f"""
SELECT round(regr_slope(total_revenue, cancellation_rate), 4) AS slope,
       round(regr_intercept(total_revenue, cancellation_rate), 4) AS intercept,
       round(regr_r2(total_revenue, cancellation_rate), {R6}) AS r2,
       round(corr(total_revenue, cancellation_rate), {R6}) AS r,
       regr_count(total_revenue, cancellation_rate) AS n
FROM daily_kpis""", ops=("E22", "E23"))
def revenue_cancellation_trend(spark, sf_dir):
    t = stats.trend_line(B.daily_kpis(spark, sf_dir), "total_revenue", "cancellation_rate")
    return t.select(F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
                    F.round("r2", R6).alias("r2"), F.round("r", R6).alias("r"), "n")


# ---------------------------------------------------------------- F1 cumulative

@register("cumulative_kpis", with_(daily_kpis_cte()) + """
SELECT date, round(sum(total_revenue) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS cumulative_revenue,
       CAST(sum(total_trips) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_trips
FROM daily_kpis""", ops=("F1", "F1b"))
def cumulative_kpis(spark, sf_dir):
    d = B.daily_kpis(spark, sf_dir).select("date", "total_revenue", "total_trips")
    c = window.cumulative(d, "date", {"cumulative_revenue": "total_revenue", "cumulative_trips": "total_trips"},
                          distributed=True)
    return c.select("date", F.round("cumulative_revenue", 4).alias("cumulative_revenue"),
                    F.col("cumulative_trips").cast("bigint").alias("cumulative_trips"))


# ---------------------------------------------------------------- F2 rolling mean

@register("rolling_avg_fare", with_(daily_kpis_cte()) + f"""
SELECT date, round(CASE WHEN count(avg_fare) OVER w = 7 THEN avg(avg_fare) OVER w END, {R6}) AS rolling_fare_7d
FROM daily_kpis WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", ops=("F2",))
def rolling_avg_fare(spark, sf_dir):
    d = B.daily_kpis(spark, sf_dir).select("date", "avg_fare")
    # per-day series: bounded by the calendar, so the direct window is both
    # cheap and numerically better than prefix-sum differences
    r = window.rolling_mean(d, "date", "avg_fare", 7, "rolling_fare_7d")
    return r.select("date", F.round("rolling_fare_7d", R6).alias("rolling_fare_7d"))


# ---------------------------------------------------------------- G1 top-10 + F3 + B7

@register("top10_drivers_by_revenue", with_(drivers_cte()) + """
SELECT CAST(row_number() OVER (ORDER BY weekly_revenue DESC, driver_id) AS INTEGER) AS rank,
       driver_id AS driver, car_type AS car, weekly_trips AS trips, round(weekly_revenue, 4) AS revenue,
       rating, round(on_time_rate, 6) AS on_time, round(cancellation_rate, 6) AS cancel_rate
FROM drivers ORDER BY weekly_revenue DESC, driver_id LIMIT 10""", ops=("G1", "F3", "B7"))
def top10_drivers_by_revenue(spark, sf_dir):
    d = B.drivers(spark, sf_dir)
    t = window.top_n(d, "weekly_revenue", 10, "driver_id")
    t = window.rank_within(t.withColumn("__all", F.lit(1)), "__all", "weekly_revenue", "driver_id", "rank")
    return t.select(F.col("rank").cast("int").alias("rank"), F.col("driver_id").alias("driver"),
                    F.col("car_type").alias("car"), F.col("weekly_trips").alias("trips"),
                    F.round("weekly_revenue", 4).alias("revenue"), "rating",
                    F.round("on_time_rate", 6).alias("on_time"), F.round("cancellation_rate", 6).alias("cancel_rate"))


# ---------------------------------------------------------------- E30 period change

@register("revenue_period_change", with_(daily_kpis_cte()) + f"""
, p AS (SELECT sum(CASE WHEN date BETWEEN DATE '1996-01-01' AND DATE '1996-01-31' THEN total_revenue END) AS a,
               sum(CASE WHEN date BETWEEN DATE '1996-06-01' AND DATE '1996-06-30' THEN total_revenue END) AS b
        FROM daily_kpis)
SELECT round(a, 4) AS first_total, round(b, 4) AS second_total, round((b - a) / a * 100, 4) AS pct_change FROM p""",
          ops=("E30",))
def revenue_period_change(spark, sf_dir):
    p = kpi.period_change(B.daily_kpis(spark, sf_dir), "date", "total_revenue",
                          ("1996-01-01", "1996-01-31"), ("1996-06-01", "1996-06-30"))
    return p.select(F.round("first_total", 4).alias("first_total"), F.round("second_total", 4).alias("second_total"),
                    F.round("pct_change", 4).alias("pct_change"))


# ---------------------------------------------------------------- E27 distinct

@register("distinct_trip_types", with_(trips_cte()) + """
SELECT DISTINCT trip_type FROM trips WHERE trip_type IS NOT NULL""", ops=("E27",))
def distinct_trip_types(spark, sf_dir):
    return B.trips(spark, sf_dir).select("trip_type").where(F.col("trip_type").isNotNull()).distinct().orderBy("trip_type")


# ---------------------------------------------------------------- B12-B16, B22, B26 trip features

@register("trip_time_features", with_(trips_cte()) + f"""
SELECT trip_id, printf('TR%05d', trip_id) AS trip_code, hour, day_of_week, month, is_weekend, is_night, is_rush_hour,
       round(sin(2 * pi() * hour / 24), {R6}) AS hour_sin, round(cos(2 * pi() * hour / 24), {R6}) AS hour_cos,
       round(sin(2 * pi() * day_of_week / 7), {R6}) AS dow_sin, round(cos(2 * pi() * day_of_week / 7), {R6}) AS dow_cos,
       round(sin(2 * pi() * month / 12), {R6}) AS month_sin, round(cos(2 * pi() * month / 12), {R6}) AS month_cos,
       dayname(date) AS day_name
FROM trips""", ops=("B12", "B13", "B14", "B15", "B16", "B22", "B26"))
def trip_time_features(spark, sf_dir):
    t = B.trips(spark, sf_dir)
    t = cal.add_cyclical(t, {"hour": ("hour", 24), "dow": ("day_of_week", 7), "month": ("month", 12)})
    cyc = [F.round(f"{n}_{f}", R6).alias(f"{n}_{f}") for n in ("hour", "dow", "month") for f in ("sin", "cos")]
    return t.select("trip_id", format_id("TR", 5, "trip_id").alias("trip_code"), "hour", "day_of_week", "month",
                    "is_weekend", "is_night", "is_rush_hour", *cyc, cal.day_name("date").alias("day_name"))
