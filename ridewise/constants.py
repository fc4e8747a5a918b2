"""Fixed values of the ride-hailing domain.

FIXED VALUES — these must equal the originals for results to match. They are
stated plainly, in their natural order, and in one place. Everything else in
the package derives from them.
"""

from __future__ import annotations

# FIXED VALUES: city zones with centroid (degrees), spread radius (degrees),
# nightlife and tourism weights. Order is the declared order; the zone index
# used by the bindings is the position in this list.
ZONES: list[tuple[str, float, float, float, float, float]] = [
    # zone,            lat,     lon,      radius, nightlife, tourism
    ("South Beach",    25.7907, -80.1300, 0.018, 0.95, 0.95),
    ("Brickell",       25.7589, -80.1918, 0.015, 0.75, 0.50),
    ("Wynwood",        25.8008, -80.1994, 0.012, 0.85, 0.80),
    ("Coral Gables",   25.7215, -80.2684, 0.020, 0.30, 0.40),
    ("Coconut Grove",  25.7310, -80.2380, 0.015, 0.60, 0.55),
    ("Little Havana",  25.7665, -80.2294, 0.013, 0.50, 0.60),
    ("Midtown",        25.8100, -80.1950, 0.010, 0.65, 0.40),
    ("Downtown",       25.7748, -80.1977, 0.014, 0.55, 0.65),
    ("Aventura",       25.9564, -80.1394, 0.018, 0.40, 0.50),
    ("Doral",          25.8195, -80.3556, 0.020, 0.20, 0.25),
]
ZONE_NAMES: list[str] = [z[0] for z in ZONES]

# FIXED VALUES: pricing events (event, months, boost). The pricing rule uses
# the boost of a firing event for the month.
PRICING_EVENTS: list[tuple[str, list[int], float]] = [
    ("Ultra Music Festival", [3], 2.8),
    ("Art Basel", [12], 2.5),
    ("Miami Grand Prix", [5], 2.2),
    ("Heat Game", [1, 2, 3, 4, 10, 11, 12], 1.6),
    ("Dolphins Game", [9, 10, 11, 12], 1.5),
]

# FIXED VALUES: demand events (event, months, zones, boost). A firing event
# multiplies the demand of its zones by boost * 0.5.
DEMAND_EVENTS: list[tuple[str, list[int], list[str], float]] = [
    ("Ultra Music Festival", [3], ["Brickell", "Downtown"], 3.0),
    ("Art Basel", [12], ["Wynwood", "South Beach"], 2.8),
    ("Miami Grand Prix", [5], ["Brickell", "Downtown"], 2.5),
    ("Heat Game", [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12], ["Brickell", "Downtown"], 1.7),
    ("Dolphins Game", [9, 10, 11, 12], ["Downtown"], 1.6),
]
PRICING_EVENT_FIRE_PCT = 15   # percent of eligible days an event fires (pricing)
DEMAND_EVENT_FIRE_PCT = 12    # percent of eligible days an event fires (demand)
DEMAND_EVENT_DAMPING = 0.5

# FIXED VALUES: categorical domains, in declared order (ordinal codes are the
# positions in these lists).
CAR_TYPES: list[str] = ["Sedan", "SUV", "Luxury", "Minivan", "Convertible"]
LANGUAGES: list[str] = ["English", "Spanish", "Portuguese", "French", "Creole"]
TRIP_TYPES: list[str] = ["nightlife", "airport", "errand", "event", "long_distance", "wedding"]
MUSIC_PREFS: list[str] = ["none", "pop", "latin", "hip_hop", "classical", "jazz"]
WEATHER: list[str] = ["sunny", "cloudy", "rainy", "stormy"]   # code = position
FRAUD_TYPES: list[str] = [
    "gps_spoofing", "fare_manipulation", "fake_completion", "account_takeover", "promo_abuse",
]
PREMIUM_ZONES: list[str] = ["South Beach", "Brickell", "Coral Gables"]
WEEKDAY_NAMES: list[str] = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_LABELS: dict[int, str] = {1: "Jan", 2: "Feb", 3: "Mar", 4: "Apr", 5: "May", 6: "Jun"}
DAY_TYPE_LABELS: dict[int, str] = {0: "Weekday", 1: "Weekend"}

# FIXED VALUES: rule fare (pricing generator rule, noise dropped).
FARE_BASE = 14.0
FARE_PER_KM = 1.5
FARE_LATE_NIGHT_HOURS = [22, 23, 0, 1, 2]
FARE_LATE_NIGHT_MULT = 1.5
FARE_EVENING_HOURS = [17, 18, 19]
FARE_EVENING_MULT = 1.2
FARE_MORNING_HOURS = [7, 8, 9]
FARE_MORNING_MULT = 1.15
FARE_DEAD_HOURS = [3, 4, 5]
FARE_DEAD_MULT = 0.85
FARE_WEEKEND_MULT = 1.1
FARE_RAINY_MULT = 1.2
FARE_STORMY_MULT = 1.4
FARE_EVENT_DAMPING = 0.4
FARE_SUPPLY_WEIGHT = 0.25
FARE_PREMIUM_MULT = 1.08
FARE_FLOOR = 6.0

# FIXED VALUES: surge explanation (serving rule).
SURGE_BASE_FARE = 15.0
SURGE_PER_KM = 2.2
SURGE_PRICE_FLOOR = 8.0
SURGE_FACTOR = 1.3
SURGE_EVENT_THRESHOLD = 1.3
SURGE_LOW_SUPPLY = 0.3
SURGE_HIGH_CONFIDENCE_KM = 40.0

# FIXED VALUES: demand score rule.
DEMAND_BASE = 0.3
DEMAND_NIGHT_HOURS = [22, 23, 0, 1, 2]
DEMAND_NIGHT_W = 0.4
DEMAND_EVENING_HOURS = [17, 18, 19]
DEMAND_EVENING_ADD = 0.25
DEMAND_MORNING_HOURS = [7, 8, 9]
DEMAND_MORNING_ADD = 0.20
DEMAND_MIDDAY_HOURS = [10, 11, 12, 13, 14, 15]
DEMAND_MIDDAY_W = 0.10
DEMAND_OTHER_ADD = 0.05
DEMAND_WEEKEND_W = 0.15
DEMAND_SEASON_MONTHS = [12, 1, 2, 3]
DEMAND_SEASON_W = 0.10
DEMAND_CAP = 1.0

# FIXED VALUES: geo grid.
GRID_LAT_START = 25.70
GRID_LAT_STOP = 25.97
GRID_LON_START = -80.37
GRID_LON_STOP = -80.11
GRID_RESOLUTION = 0.005
GRID_HOURS = [2, 8, 12, 18, 22]
GRID_MAX_DIST = 0.06
GRID_DECAY_DIST = 0.04
GRID_SCENARIO_DOW = 5      # Saturday
GRID_SCENARIO_MONTH = 12   # December
SCENARIO_ZONES = ["South Beach", "Brickell", "Wynwood", "Downtown", "Doral"]

# FIXED VALUES: compatibility rule (matching).
COMPAT_BASE = 0.5
COMPAT_CAR = 0.20
COMPAT_SPANISH = 0.12
COMPAT_PET_OK = 0.10
COMPAT_PET_BAD = -0.15
COMPAT_QUIET = 0.08
COMPAT_MUSIC = 0.05
COMPAT_NIGHTLIFE = 0.10
COMPAT_AIRPORT = 0.08
COMPAT_EVENT = 0.08
COMPAT_RATING_W = 0.10
COMPAT_RATING_PIVOT = 4.0
COMPAT_ON_TIME_W = 0.08
COMPAT_CANCEL_W = 0.20

# FIXED VALUES: feature lists, in order.
DRIVER_FEATURES: list[str] = [
    "rating", "experience_years", "car_type_enc",
    "is_nightlife_spec", "is_airport_spec", "is_event_spec", "is_wedding_spec",
    "speaks_spanish", "speaks_english",
    "acceptance_rate", "on_time_rate", "cancellation_rate",
    "allows_pets", "prefers_quiet",
]
# customer preference -> driver feature slot it fills (others stay 0);
# the rating slot takes 1 - price_sensitivity.
CUSTOMER_TO_DRIVER_SLOT: dict[str, str] = {
    "rating": "price_sensitivity",
    "car_type_enc": "preferred_car_enc",
    "is_nightlife_spec": "is_nightlife_user",
    "is_airport_spec": "is_airport_user",
    "is_event_spec": "is_event_user",
    "speaks_spanish": "prefers_spanish",
    "allows_pets": "has_pet",
    "prefers_quiet": "prefers_quiet",
}
RERANK_FEATURES: list[str] = [
    "cb_score", "cf_score", "rating", "on_time_rate",
    "cancellation_rate", "acceptance_rate", "experience_years",
]
PRICING_FEATURES: list[str] = [
    "hour", "day_of_week", "month", "is_weekend", "is_night",
    "is_rush_hour", "distance_km", "weather_encoded",
    "driver_supply_ratio", "event_demand_multiplier",
    "active_drivers", "pending_requests", "demand_supply_ratio",
    "pickup_enc", "dropoff_enc",
]
DEMAND_FEATURES: list[str] = [
    "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "month_sin", "month_cos", "is_weekend", "neighborhood_enc",
]
FRAUD_FEATURES: list[str] = [
    "distance_km", "fare_usd", "speed_kmh", "duration_min",
    "hour", "is_night", "driver_rating", "customer_rating",
    "trip_count_today", "new_device", "new_payment_method",
    "location_jump_km", "surge_multiplier", "promo_applied",
    "cancellations_today", "fare_distance_ratio",
]

# FIXED VALUES: match serving.
# fixed text of a match response
MATCH_STRATEGY = "content-based (cosine) → hybrid gradient boosting re-rank"
MATCH_POOL_SIZE = 40
MATCH_DEFAULT_TOP_K = 5
MATCH_MAX_TOP_K = 20
MATCH_SERVING_CF_DEFAULT = 0.5
SVD_COMPONENTS = 30

# FIXED VALUES: fraud pipeline.
AE_HIDDEN = 10
AE_LATENT = 5
AE_LR = 0.005
AE_EPOCHS = 60
AE_INIT_STD = 0.1
AE_THRESHOLD_PCT = 0.95
IFOREST_TREES = 300
IFOREST_SAMPLE = 256
FRAUD_THRESHOLD = 0.5
FRAUD_PROMO_TRIPS = 15
FRAUD_GPS_SPEED = 90.0
FRAUD_GPS_JUMP = 15.0
FRAUD_FAKE_MAX_DURATION = 3.0
