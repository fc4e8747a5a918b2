"""Rule-based scoring operators as column expressions.

Each rule is one expression tree: it stays inside whole-stage codegen and
needs no shuffle. Rules take column names so that any table can be scored.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridewise import constants as K
from ridewise.functions.exprs import round_half_up


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _mult(cond: Column, factor: float) -> Column:
    return F.when(cond, F.lit(factor)).otherwise(F.lit(1.0))


def hour_fare_multiplier(hour) -> Column:
    h = _c(hour)
    return (F.when(h.isin(K.FARE_LATE_NIGHT_HOURS), F.lit(K.FARE_LATE_NIGHT_MULT))
             .when(h.isin(K.FARE_EVENING_HOURS), F.lit(K.FARE_EVENING_MULT))
             .when(h.isin(K.FARE_MORNING_HOURS), F.lit(K.FARE_MORNING_MULT))
             .when(h.isin(K.FARE_DEAD_HOURS), F.lit(K.FARE_DEAD_MULT))
             .otherwise(F.lit(1.0)))


def rule_fare(distance_km="distance_km", hour="hour", day_of_week="day_of_week",
              weather="weather", event_mult="event_demand_multiplier",
              supply="driver_supply_ratio", pickup="pickup_neighborhood") -> Column:
    """Deterministic fare rule, floor 6.0, rounded to cents."""
    price = F.lit(K.FARE_BASE) + _c(distance_km) * F.lit(K.FARE_PER_KM)
    price = price * hour_fare_multiplier(hour)
    price = price * _mult(_c(day_of_week) >= 5, K.FARE_WEEKEND_MULT)
    price = price * (F.when(_c(weather) == "rainy", F.lit(K.FARE_RAINY_MULT))
                      .when(_c(weather) == "stormy", F.lit(K.FARE_STORMY_MULT))
                      .otherwise(F.lit(1.0)))
    price = price * (F.lit(1.0) + (_c(event_mult) - F.lit(1.0)) * F.lit(K.FARE_EVENT_DAMPING))
    price = price * (F.lit(1.0) + (F.lit(1.0) - _c(supply)) * F.lit(K.FARE_SUPPLY_WEIGHT))
    price = price * _mult(_c(pickup).isin(K.PREMIUM_ZONES), K.FARE_PREMIUM_MULT)
    return round_half_up(F.greatest(price, F.lit(K.FARE_FLOOR)), 2)


def demand_score(hour="hour", day_of_week="day_of_week", month="month",
                 nightlife="nightlife", tourism="tourism", event_factor="event_factor") -> Column:
    """Zone demand score in [0, 1], rounded to 3 decimals."""
    h = _c(hour)
    tod = (F.when(h.isin(K.DEMAND_NIGHT_HOURS), F.lit(K.DEMAND_NIGHT_W) * _c(nightlife))
            .when(h.isin(K.DEMAND_EVENING_HOURS), F.lit(K.DEMAND_EVENING_ADD))
            .when(h.isin(K.DEMAND_MORNING_HOURS), F.lit(K.DEMAND_MORNING_ADD))
            .when(h.isin(K.DEMAND_MIDDAY_HOURS), F.lit(K.DEMAND_MIDDAY_W) * _c(tourism))
            .otherwise(F.lit(K.DEMAND_OTHER_ADD)))
    base = F.lit(K.DEMAND_BASE) + tod
    base = base + F.when(_c(day_of_week) >= 5, F.lit(K.DEMAND_WEEKEND_W) * _c(nightlife)).otherwise(F.lit(0.0))
    base = base + F.when(_c(month).isin(K.DEMAND_SEASON_MONTHS), F.lit(K.DEMAND_SEASON_W) * _c(tourism)).otherwise(F.lit(0.0))
    base = base * F.coalesce(_c(event_factor), F.lit(1.0))
    return F.least(round_half_up(base, 3), F.lit(K.DEMAND_CAP))


def compatibility(d: str = "d", c: str = "c") -> Column:
    """C4: driver-customer compatibility in [0, 1], 3 decimals.

    ``d`` / ``c`` are the prefixes (struct or alias) of driver and customer columns.
    """
    D = lambda n: F.col(f"{d}.{n}")
    C = lambda n: F.col(f"{c}.{n}")
    add = lambda cond, v: F.when(cond, F.lit(v)).otherwise(F.lit(0.0))
    s = F.lit(K.COMPAT_BASE)
    s = s + add(D("car_type") == C("preferred_car_type"), K.COMPAT_CAR)
    s = s + add((C("prefers_spanish") == 1) & (D("speaks_spanish") == 1), K.COMPAT_SPANISH)
    s = s + (F.when((C("has_pet") == 1) & (D("allows_pets") == 1), F.lit(K.COMPAT_PET_OK))
              .when(C("has_pet") == 1, F.lit(K.COMPAT_PET_BAD)).otherwise(F.lit(0.0)))
    s = s + add((C("prefers_quiet") == 1) & (D("prefers_quiet") == 1), K.COMPAT_QUIET)
    s = s + add((D("music_pref") == C("preferred_music")) | (D("music_pref") == "none"), K.COMPAT_MUSIC)
    s = s + add((C("is_nightlife_user") == 1) & (D("is_nightlife_spec") == 1), K.COMPAT_NIGHTLIFE)
    s = s + add((C("is_airport_user") == 1) & (D("is_airport_spec") == 1), K.COMPAT_AIRPORT)
    s = s + add((C("is_event_user") == 1) & (D("is_event_spec") == 1), K.COMPAT_EVENT)
    s = s + (D("rating") - F.lit(K.COMPAT_RATING_PIVOT)) * F.lit(K.COMPAT_RATING_W)
    s = s + D("on_time_rate") * F.lit(K.COMPAT_ON_TIME_W)
    s = s - D("cancellation_rate") * F.lit(K.COMPAT_CANCEL_W)
    s = F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0))
    return round_half_up(s, 3)


def rating_from_compatibility(compat) -> Column:
    """clip(round_half_even(1 + 4*compat), 1, 5) as int."""
    r = F.bround(F.lit(1.0) + F.lit(4.0) * _c(compat), 0)
    return F.least(F.greatest(r, F.lit(1.0)), F.lit(5.0)).cast("int")


def surge_explanation(price="model_price", hour="hour", day_of_week="day_of_week",
                      distance_km="distance_km", weather="weather",
                      event_mult="event_demand_multiplier", supply="driver_supply_ratio") -> Column:
    """The serving response as one struct column."""
    is_night = (_c(hour) >= 22) | (_c(hour) <= 5)
    is_weekend = _c(day_of_week) >= 5
    p = round_half_up(F.greatest(_c(price), F.lit(K.SURGE_PRICE_FLOOR)), 2)
    base_est = F.lit(K.SURGE_BASE_FARE) + _c(distance_km) * F.lit(K.SURGE_PER_KM)
    reasons = F.concat_ws(
        ", ",
        F.when(is_night, F.lit("late night")),
        F.when(_c(weather).isin("rainy", "stormy"), F.concat(_c(weather), F.lit(" weather"))),
        F.when(_c(event_mult) > K.SURGE_EVENT_THRESHOLD, F.lit("local event")),
        F.when(_c(supply) < K.SURGE_LOW_SUPPLY, F.lit("low driver supply")),
        F.when(is_weekend, F.lit("weekend")),
    )
    return F.struct(
        p.alias("estimated_price_usd"),
        (p > base_est * F.lit(K.SURGE_FACTOR)).alias("surge_active"),
        F.when(reasons == "", F.lit("none")).otherwise(reasons).alias("surge_reason"),
        F.when(_c(distance_km) < K.SURGE_HIGH_CONFIDENCE_KM, F.lit("high")).otherwise(F.lit("medium")).alias("confidence"),
        F.struct(
            F.lit(K.SURGE_BASE_FARE).alias("base_fare"),
            round_half_up(_c(distance_km) * F.lit(K.SURGE_PER_KM), 2).alias("distance_component"),
            round_half_up(p / base_est, 2).alias("surge_multiplier"),
            _c(weather).alias("weather"),
            is_weekend.alias("is_weekend"),
            is_night.alias("is_night"),
        ).alias("breakdown"),
    )


def fraud_patterns(fare_ratio_bound, speed="speed_kmh", jump="location_jump_km",
                   new_device="new_device", trips_today="trip_count_today",
                   cancels_today="cancellations_today", duration="duration_min",
                   ratio="fare_distance_ratio", min_cancels: int = 3) -> Column:
    """Array of the fraud patterns a trip matches, in a fixed order."""
    bound = fare_ratio_bound if isinstance(fare_ratio_bound, Column) else F.lit(float(fare_ratio_bound))
    flags = [
        F.when((_c(speed) > K.FRAUD_GPS_SPEED) & (_c(jump) > K.FRAUD_GPS_JUMP), F.lit("gps_spoofing")),
        F.when(_c(ratio) > bound, F.lit("fare_manipulation")),
        F.when((_c(duration) <= K.FRAUD_FAKE_MAX_DURATION) & (_c(speed) > K.FRAUD_GPS_SPEED), F.lit("fake_completion")),
        F.when((_c(new_device) == 1) & (_c(jump) > K.FRAUD_GPS_JUMP), F.lit("account_takeover")),
        F.when((_c(trips_today) >= K.FRAUD_PROMO_TRIPS) & (_c(cancels_today) >= min_cancels), F.lit("promo_abuse")),
    ]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())
