"""Domain views derived from the driver's tables.

The driver's tables hold no trips, drivers or riders, so each domain table is
derived by deterministic column expressions (no randomness, no driver-side
data): a DuckDB twin of every view lives in ``ridewise.plans.sql_views``.
Operators never know these tables; they take column names.

Scale notes: every view is a projection of one fact table plus aggregations
with partial (map-side) combine. Dimension joins go through
``maybe_broadcast`` so a dimension that outgrows the limit falls back to a
shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridewise import constants as K
from ridewise.functions import calendar as cal
from ridewise.functions.exprs import (clip, demand_supply_ratio, fare_distance_ratio,
                                      list_flag, round_half_up, supply_count, driver_utilisation)
from ridewise.functions.encode import ordinal_code, weather_code
from ridewise.functions.rules import compatibility, rule_fare
from ridewise.sources.tables import maybe_broadcast, read_table


def pm(c, n: int) -> Column:
    """Non-negative modulo."""
    return F.pmod(c if isinstance(c, Column) else F.col(c), F.lit(n))


def pick(values: list, idx: Column) -> Column:
    """values[idx] for a 0-based index column (literal array lookup, no join)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def zones(spark: SparkSession) -> DataFrame:
    """Constant zone dimension (10 rows)."""
    rows = [(i, z, lat, lon, r, nl, tr) for i, (z, lat, lon, r, nl, tr) in enumerate(K.ZONES)]
    return spark.createDataFrame(
        rows, "zone_idx int, zone string, lat double, lon double, radius double, nightlife double, tourism double")


def pricing_events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(e, m, b) for e, m, b in K.PRICING_EVENTS],
                                 "event string, months array<int>, boost double")


def demand_events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(e, m, z, b) for e, m, z, b in K.DEMAND_EVENTS],
                                 "event string, months array<int>, zones array<string>, boost double")


# ----------------------------------------------------------------------------
# trips: one trip per event
# ----------------------------------------------------------------------------

def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(read_table(spark, sf_dir, "events"))


def trips_from_events(events: DataFrame) -> DataFrame:
    """Trip projection of an events frame (batch or streaming)."""
    e = events.select("event_id", "ts", "user_id", "event_type", "value")
    eid = F.col("event_id")
    zone_idx = pm(eid, 10).cast("int")
    lat = pick([z[1] for z in K.ZONES], zone_idx) + (pm(eid, 41) - 20) * F.lit(0.0005)
    lon = pick([z[2] for z in K.ZONES], zone_idx) + (pm(eid * 7, 41) - 20) * F.lit(0.0005)
    t = e.select(
        eid.alias("trip_id"),
        F.col("ts"),
        F.to_date("ts").alias("date"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("trip_type"),
        F.col("value").alias("fare_usd"),
        zone_idx.alias("zone_idx"),
        pick(K.ZONE_NAMES, zone_idx).alias("neighborhood"),
        pick(K.ZONE_NAMES, pm(eid * 3 + 1, 10)).alias("dropoff_neighborhood"),
        (F.col("event_type") != "error").cast("int").alias("completed"),
        (pm(eid * 37, 600) / 10 + 0.5).alias("distance_km"),
        pick(K.CAR_TYPES, pm("user_id", 5)).alias("car_type"),
        (pm(eid, 5) + 1).cast("int").alias("driver_rating"),
        lat.alias("pickup_lat"),
        lon.alias("pickup_lon"),
    )
    return cal.add_time_parts(t, "ts")


# ----------------------------------------------------------------------------
# event calendar (C3): deterministic firing per (event, date)
# ----------------------------------------------------------------------------

def fires(event: Column, date: Column, pct: int) -> Column:
    """Event fires on a date when an md5 bucket of (event, date) is below pct."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", event, date.cast("string"))), 1, 8), 16, 10).cast("bigint")
    return pm(h, 100) < pct


def pricing_boost_by_date(spark: SparkSession, dates: DataFrame) -> DataFrame:
    """(date, event_demand_multiplier): max boost of the firing events, else 1.0."""
    ev = pricing_events(spark).select("event", F.explode("months").alias("month"), "boost")
    d = dates.select("date").distinct().withColumn("month", F.month("date"))
    fired = (d.join(F.broadcast(ev), "month")
              .where(fires(F.col("event"), F.col("date"), K.PRICING_EVENT_FIRE_PCT))
              .groupBy("date").agg(F.max("boost").alias("boost")))
    return (d.join(fired, "date", "left")
             .select("date", F.coalesce("boost", F.lit(1.0)).alias("event_demand_multiplier")))


def demand_factor_by_date_zone(spark: SparkSession, dates: DataFrame) -> DataFrame:
    """(date, zone, event_factor): product of boost*0.5 over firing events of
    the zone; only (date, zone) pairs with a firing event are returned."""
    ev = (demand_events(spark)
          .select("event", F.explode("months").alias("month"), "zones", "boost")
          .select("event", "month", F.explode("zones").alias("zone"), "boost"))
    d = dates.select("date").distinct().withColumn("month", F.month("date"))
    return (d.join(F.broadcast(ev), "month")
             .where(fires(F.col("event"), F.col("date"), K.DEMAND_EVENT_FIRE_PCT))
             .groupBy("date", "zone")
             .agg(F.product(F.col("boost") * F.lit(K.DEMAND_EVENT_DAMPING)).alias("event_factor")))


# ----------------------------------------------------------------------------
# rides (pricing) and geo trips (demand)
# ----------------------------------------------------------------------------

def weather_of(eid: Column) -> Column:
    b = pm(eid * 7, 20)
    code = F.when(b < 11, 0).when(b < 16, 1).when(b < 19, 2).otherwise(3)
    return pick(K.WEATHER, code)


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trips(spark, sf_dir)
    return rides_from_trips(spark, t, pricing_boost_by_date(spark, t.select("date")))


def rides_from_trips(spark: SparkSession, t: DataFrame, boosts: DataFrame) -> DataFrame:
    """Pricing view of a trips frame (batch or streaming); ``boosts`` is the
    static per-day event multiplier table (one row per calendar day)."""
    eid = F.col("trip_id")
    r = t.select(
        "trip_id", "date", "hour", "day_of_week", "month", "is_weekend", "is_night", "is_rush_hour",
        "distance_km",
        F.col("neighborhood").alias("pickup_neighborhood"),
        "dropoff_neighborhood",
        weather_of(eid).alias("weather"),
        (pm(eid * 13, 101) / 100).alias("driver_supply_ratio"),
        (pm(eid * 11, 116) + 5).cast("int").alias("pending_requests"),
    )
    r = r.join(F.broadcast(boosts), "date", "left")   # one row per calendar day
    r = r.withColumns({"weather_encoded": weather_code("weather"),
                       "active_drivers": supply_count("driver_supply_ratio", 80)})
    r = r.withColumn("demand_supply_ratio", round_half_up(F.col("pending_requests") / (F.col("active_drivers") + 1), 2))
    return r.withColumn("price_usd", rule_fare())


def geo_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with pickup coordinates and the C2 demand score."""
    from ridewise.functions.rules import demand_score
    t = trips(spark, sf_dir)
    f = demand_factor_by_date_zone(spark, t.select("date"))
    g = (t.join(F.broadcast(f.withColumnRenamed("zone", "neighborhood")), ["date", "neighborhood"], "left")
          .withColumn("nightlife", pick([z[4] for z in K.ZONES], F.col("zone_idx")))
          .withColumn("tourism", pick([z[5] for z in K.ZONES], F.col("zone_idx"))))
    return g.withColumn("demand_score", demand_score())


# ----------------------------------------------------------------------------
# daily KPIs from orders x lineitem
# ----------------------------------------------------------------------------

def daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order date.

    Plan: lineitem is joined once to (orderkey, date), collapsed to
    (date, supplier) with partial aggregation, then to date. Order-level
    measures come from orders alone. No count-distinct expansion.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("date"))
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_r"),
        F.col("l_discount"))
    per_day_supp = (li.join(o.select("o_orderkey", "date"), li.l_orderkey == o.o_orderkey)
                      .groupBy("date", "l_suppkey")
                      .agg(F.sum("rev").alias("rev"), F.count(F.lit(1)).alias("n"),
                           F.sum("is_r").alias("nr"), F.sum("l_discount").alias("disc")))
    per_day = (per_day_supp.groupBy("date")
               .agg(F.count(F.lit(1)).alias("active_drivers"), F.sum("rev").alias("total_revenue"),
                    (F.sum("nr") / F.sum("n")).alias("cancellation_rate"),
                    (F.lit(5.0) - F.lit(10.0) * F.sum("disc") / F.sum("n")).alias("avg_rating")))
    orders_day = o.groupBy("date").agg(F.count(F.lit(1)).alias("total_trips"),
                                       F.avg("o_totalprice").alias("avg_fare"))
    first_order = (o.groupBy("o_custkey").agg(F.min("date").alias("date"))
                    .groupBy("date").agg(F.count(F.lit(1)).alias("new_customers")))
    d = (orders_day.join(per_day, "date")
                   .join(first_order, "date", "left")
                   .withColumn("new_customers", F.coalesce("new_customers", F.lit(0)).cast("bigint")))
    d = d.withColumns({"day_of_week": cal.weekday_of("date"), "month": cal.month_of("date"),
                       "driver_utilization": driver_utilisation("total_trips", "active_drivers")})
    return d.withColumn("is_weekend", cal.is_weekend("day_of_week"))


# ----------------------------------------------------------------------------
# drivers, customers, interactions (matching)
# ----------------------------------------------------------------------------

def _driver_specialties(k: Column) -> Column:
    return F.concat_ws(",",
                       F.when(pm(k, 2) == 0, F.lit("nightlife")),
                       F.when(pm(k, 3) == 0, F.lit("airport")),
                       F.when(pm(k, 4) == 1, F.lit("errand")),
                       F.when(pm(k, 5) == 0, F.lit("event")),
                       F.when(pm(k, 7) == 3, F.lit("long_distance")),
                       F.when(pm(k, 6) == 5, F.lit("wedding")))


def _customer_trip_types(k: Column) -> Column:
    return F.concat_ws(",",
                       F.when(pm(k, 3) == 0, F.lit("nightlife")),
                       F.when(pm(k, 4) == 1, F.lit("airport")),
                       F.when(pm(k, 5) == 2, F.lit("errand")),
                       F.when(pm(k, 6) == 0, F.lit("event")),
                       F.when(pm(k, 7) == 4, F.lit("long_distance")),
                       F.when(pm(k, 9) == 8, F.lit("wedding")))


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    li = read_table(spark, sf_dir, "lineitem")
    agg = (li.groupBy("l_suppkey")
             .agg(F.count(F.lit(1)).alias("weekly_trips"),
                  F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("weekly_revenue"),
                  (F.sum((F.col("l_returnflag") == "R").cast("int")) / F.count(F.lit(1))).alias("cancellation_rate"),
                  (F.sum((F.col("l_linestatus") == "F").cast("int")) / F.count(F.lit(1))).alias("on_time_rate")))
    k = F.col("s_suppkey")
    d = s.join(agg, s.s_suppkey == agg.l_suppkey, "left")
    car_enc = pm(k, 5).cast("int")
    zone_enc = pm(k * 3, 10).cast("int")
    d = d.select(
        k.alias("driver_id"),
        (F.lit(3.0) + pm(k * 7919, 201) / 100).alias("rating"),
        (F.lit(0.5) + pm(k * 37, 186) / 10).alias("experience_years"),
        F.coalesce("weekly_trips", F.lit(0)).cast("bigint").alias("weekly_trips"),
        F.coalesce("weekly_revenue", F.lit(0.0)).alias("weekly_revenue"),
        pick(K.CAR_TYPES, car_enc).alias("car_type"),
        car_enc.alias("car_type_enc"),
        pick(K.ZONE_NAMES, zone_enc).alias("home_zone"),
        zone_enc.alias("home_zone_enc"),
        _driver_specialties(k).alias("specialties"),
        F.concat_ws(",", F.when(pm(k, 4) != 3, F.lit("English")),
                    F.when((pm(k, 3) == 0) | (pm(k, 4) == 3), F.lit("Spanish"))).alias("languages"),
        (F.lit(0.4) + pm(k * 17, 61) / 100).alias("acceptance_rate"),
        F.coalesce("on_time_rate", F.lit(0.0)).alias("on_time_rate"),
        F.coalesce("cancellation_rate", F.lit(0.0)).alias("cancellation_rate"),
        (pm(k * 13, 120) + 10).cast("int").alias("avg_response_sec"),
        pick(K.MUSIC_PREFS, pm(k, 6)).alias("music_pref"),
        (pm(k, 10) < 3).cast("int").alias("allows_pets"),
        (pm(k * 7, 5) < 2).cast("int").alias("prefers_quiet"),
        (pm(k, 7) + 1).cast("int").alias("active_days"),
    )
    flags = {flag: list_flag("specialties", v) for flag, v in
             [("is_nightlife_spec", "nightlife"), ("is_airport_spec", "airport"),
              ("is_event_spec", "event"), ("is_wedding_spec", "wedding")]}
    flags["speaks_spanish"] = list_flag("languages", "Spanish")
    flags["speaks_english"] = list_flag("languages", "English")
    return d.withColumns(flags)


SEGMENT_TO_CAR = {"AUTOMOBILE": "Sedan", "BUILDING": "SUV", "FURNITURE": "Luxury",
                  "HOUSEHOLD": "Minivan", "MACHINERY": "Convertible"}


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    seg_map = F.create_map(*[x for kv in SEGMENT_TO_CAR.items() for x in map(F.lit, kv)])
    out = c.select(
        k.alias("customer_id"),
        F.try_element_at(seg_map, F.col("c_mktsegment")).alias("preferred_car_type"),
        _customer_trip_types(k).alias("preferred_trip_types"),
        (pm(k, 20) < 7).cast("int").alias("prefers_spanish"),
        (pm(k, 4) == 0).cast("int").alias("has_pet"),
        (pm(k * 3, 20) < 7).cast("int").alias("prefers_quiet"),
        (pm(k * 31, 101) / 100).alias("price_sensitivity"),
        pick(K.MUSIC_PREFS, pm(k * 5, 6)).alias("preferred_music"),
    )
    cols = {"preferred_car_enc": ordinal_code("preferred_car_type", K.CAR_TYPES)}
    for flag, v in [("is_nightlife_user", "nightlife"), ("is_airport_user", "airport"),
                    ("is_event_user", "event")]:
        cols[flag] = list_flag("preferred_trip_types", v)
    return out.withColumns(cols)


def interactions(spark: SparkSession, sf_dir: str, with_compatibility: bool = True) -> DataFrame:
    """One interaction per line item: (customer, driver, rating, compatibility).

    D3: two dimension lookups. Both go through the size check, so at scale
    (customers no longer small) they become shuffle joins under AQE.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_linestatus")
    it = (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                    F.col("o_custkey").alias("customer_id"), F.col("l_suppkey").alias("driver_id"),
                    F.least(F.lit(5), F.floor(F.col("l_quantity") / 10) + 1).cast("int").alias("explicit_rating"),
                    pick(K.TRIP_TYPES, pm("l_linenumber", 6)).alias("trip_type"),
                    (F.col("l_linestatus") == "F").cast("int").alias("completed")))
    if not with_compatibility:
        return it
    d = drivers(spark, sf_dir).alias("d")
    c = customers(spark, sf_dir).alias("c")
    j = (it.alias("i")
           .join(maybe_broadcast(d), F.col("i.driver_id") == F.col("d.driver_id"))
           .join(maybe_broadcast(c), F.col("i.customer_id") == F.col("c.customer_id")))
    return j.select("i.*", compatibility("d", "c").alias("compatibility"))


# ----------------------------------------------------------------------------
# labelled documents, vectors
# ----------------------------------------------------------------------------

def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lb = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lb, "doc_id")
    return j.select("doc_id", "n_chars", "quality", "toxic",
                    (F.col("n_chars") / (F.col("n_chars") + F.lit(5000.0))).alias("score"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"), "label")


# ----------------------------------------------------------------------------
# fraud trips: per-rider day features (K4 batch form)
# ----------------------------------------------------------------------------

KM_PER_DEGREE = 111.0


def rider_day_features(t: DataFrame, skew_safe: bool = True, bucket_minutes: int = 10) -> DataFrame:
    """trip_count_today, cancellations_today, location_jump_km and new_device.

    ``cancellations_today`` counts the rider's earlier cancellations of the day,
    not the trip itself. ``new_device`` is 1 for the first trip from a device the
    rider has not used before, the rider's first trip of all excepted.

    ``skew_safe`` (default): a rider-day may hold a large share of all rows,
    so no window or task is keyed by the rider-day alone.
      * day counts: partial aggregation per (rider, day), joined back (AQE
        splits a skewed join partition);
      * previous pickup: ``lag`` inside (rider, day, time bucket of
        ``bucket_minutes``); the first row of a bucket takes the last row of
        the rider-day's previous non-empty bucket, found by a window over the
        per-bucket last rows (at most 24*60/bucket_minutes rows per rider-day).
    All keys are deterministic, so any recomputation gives the same result.
    Without ``skew_safe`` both come from windows keyed by (rider, day).
    """
    keys = ["customer_id", "date"]
    order = ["ts", "trip_id"]
    is_err = (F.col("trip_type") == "error").cast("int")

    def jump_of(plat, plon):
        j = F.sqrt((F.col("pickup_lat") - plat) ** 2 + (F.col("pickup_lon") - plon) ** 2) * KM_PER_DEGREE
        return F.coalesce(round_half_up(j, 2), F.lit(0.0))

    if not skew_safe:
        w_day = Window.partitionBy(*keys)
        w_ord = w_day.orderBy(*order)
        return with_new_device(t).withColumns({
            "trip_count_today": F.count(F.lit(1)).over(w_day),
            "cancellations_today": F.coalesce(F.sum(is_err).over(w_ord.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "location_jump_km": jump_of(F.lag("pickup_lat").over(w_ord), F.lag("pickup_lon").over(w_ord))})
    counts = t.groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count_today"))
    bucket = ((F.hour("ts") * 60 + F.minute("ts")) / bucket_minutes).cast("int")
    r = t.withColumn("__b", bucket)
    wb = Window.partitionBy(*keys, "__b").orderBy(*order)
    r = with_new_device(r).withColumns({
        "__plat": F.lag("pickup_lat").over(wb), "__plon": F.lag("pickup_lon").over(wb),
        "__c": F.coalesce(F.sum(is_err).over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    lasts = (t.withColumn("__b", bucket).groupBy(*keys, "__b")
              .agg(F.max_by(F.struct("pickup_lat", "pickup_lon"), F.struct(*order)).alias("__l"), F.sum(is_err).alias("__e")))
    wp = Window.partitionBy(*keys).orderBy("__b")
    prev = lasts.select(*keys, "__b", F.lag("__l").over(wp).alias("__p"),
                        F.coalesce(F.sum("__e").over(wp.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    r = r.join(prev, keys + ["__b"], "left")
    first = F.col("__plat").isNull() & F.col("__p").isNotNull()
    plat = F.when(first, F.col("__p.pickup_lat")).otherwise(F.col("__plat"))
    plon = F.when(first, F.col("__p.pickup_lon")).otherwise(F.col("__plon"))
    r = r.withColumns({"location_jump_km": jump_of(plat, plon), "cancellations_today": F.col("__c") + F.col("__before")})
    return r.drop("__b", "__plat", "__plon", "__p", "__c", "__before").join(counts, keys)


def driver_of(trip_id: Column) -> Column:
    """The driver a trip was offered to."""
    return pm(trip_id * 29, 211) + 1


def device_of(trip_id: Column) -> Column:
    """The device a trip was booked from: mostly the rider's usual one (0), in
    one of twenty trips one of 50 others."""
    return F.when(pm(trip_id * 17, 20) == 0, pm(trip_id, 50) + 1).otherwise(F.lit(0)).cast("int")


def with_new_device(t: DataFrame) -> DataFrame:
    """Adds ``new_device``. First trips are grouped minima, joined back, so no
    task holds a rider."""
    t = t.withColumn("device_id", device_of(F.col("trip_id")))
    first = t.groupBy("customer_id", "device_id").agg(F.min(F.struct("ts", "trip_id")).alias("__f"))
    ever = first.groupBy("customer_id").agg(F.min("__f").alias("__ever"))
    first = first.join(ever, "customer_id").where(F.col("__f") != F.col("__ever")).select(F.col("__f.trip_id").alias("trip_id"),
                                                                                             F.lit(1).alias("new_device"))
    return t.join(first, "trip_id", "left").withColumn("new_device", F.coalesce("new_device", F.lit(0)))


def fraud_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trip with the rider's day features. The label is the given
    one (``event_type = 'error'``); a trip's values do not depend on its own
    label, only on those of the rider's earlier trips."""
    t = rider_day_features(trips(spark, sf_dir))
    eid = F.col("trip_id")
    fraud = F.coalesce(F.col("trip_type") == "error", F.lit(False))
    base = t.select(
        "trip_id", "customer_id", "date", "distance_km", "fare_usd",
        (pm(eid * 13, 120) + 20).cast("double").alias("speed_kmh"),
        "hour",
        (F.lit(3.0) + pm(eid * 7, 201) / 100).alias("driver_rating"),
        (F.lit(3.0) + pm(F.col("customer_id") * 11, 201) / 100).alias("customer_rating"),
        F.col("trip_count_today").cast("int").alias("trip_count_today"),
        "new_device",
        (pm(eid * 19, 25) < 2).cast("int").alias("new_payment_method"),
        "location_jump_km",
        pick([1.0, 1.0, 1.0, 1.0, 1.2, 1.2, 1.5, 2.0], pm(eid * 3, 8)).alias("surge_multiplier"),
        (pm(eid * 23, 25) < 3).cast("int").alias("promo_applied"),
        F.col("cancellations_today").cast("int").alias("cancellations_today"),
        fraud.cast("int").alias("is_fraud"),
        F.when(fraud, F.lit("error")).otherwise(F.lit("none")).alias("fraud_type"))
    duration = clip(round_half_up(F.col("distance_km") / F.greatest(F.col("speed_kmh"), F.lit(5.0)) * 60, 1), 1.0, 120.0)
    return base.withColumns({
        "duration_min": duration, "is_night": cal.is_night("hour"),
        "fare_distance_ratio": round_half_up(F.col("fare_usd") / F.greatest(F.col("distance_km"), F.lit(0.1)), 2)})


# ----------------------------------------------------------------------------
# request tables (A8): typed requests derived from rides / customers
# ----------------------------------------------------------------------------

def price_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rides(spark, sf_dir)
    rid = F.col("trip_id")
    return r.select(
        rid.alias("request_id"), "hour", "day_of_week", "month",
        F.when(pm(rid, 89) == 0, F.lit(-1.0)).otherwise(F.col("distance_km")).alias("distance_km"),
        "weather",
        F.when(pm(rid, 97) == 0, F.lit("Atlantis")).otherwise(F.col("pickup_neighborhood")).alias("pickup_neighborhood"),
        "dropoff_neighborhood", "driver_supply_ratio", "event_demand_multiplier",
        "active_drivers", "pending_requests")


def match_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customers(spark, sf_dir)
    k = F.col("customer_id")
    return c.select(
        k.alias("request_id"), "preferred_car_type",
        F.when(pm(k, 11) == 0, F.lit(None).cast("int")).otherwise(F.col("is_nightlife_user")).alias("is_nightlife_user"),
        "is_airport_user", "is_event_user", "prefers_spanish", "has_pet", "prefers_quiet",
        F.when(pm(k, 13) == 0, F.lit(None).cast("double")).otherwise(F.col("price_sensitivity")).alias("price_sensitivity"),
        F.when(pm(k, 17) == 0, F.lit(25)).when(pm(k, 19) == 0, F.lit(None).cast("int"))
         .otherwise((pm(k, 10) + 1).cast("int")).alias("top_k"))
