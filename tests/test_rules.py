"""Golden values for the rule operators (typed literals, no reference files)."""

from pyspark.sql import functions as F

from ridewise.functions.rules import (compatibility, demand_score, rating_from_compatibility, rule_fare,
                                      surge_explanation)


def test_surge_explanation_published_sample(spark):
    # model price 208.26, hour 23, Friday (4), 8.5 km, rainy, supply 0.3, event 2.5
    df = spark.createDataFrame([(208.26, 23, 4, 8.5, "rainy", 2.5, 0.3)],
                               "model_price double, hour int, day_of_week int, distance_km double, weather string, "
                               "event_demand_multiplier double, driver_supply_ratio double")
    r = df.select(surge_explanation().alias("r")).first()["r"]
    assert r["estimated_price_usd"] == 208.26
    assert r["surge_active"] is True
    assert r["surge_reason"] == "late night, rainy weather, local event"
    assert r["confidence"] == "high"
    b = r["breakdown"]
    assert (b["base_fare"], b["distance_component"], b["surge_multiplier"]) == (15.0, 18.7, 6.18)
    assert (b["weather"], b["is_weekend"], b["is_night"]) == ("rainy", False, True)


def test_surge_none_and_floor(spark):
    df = spark.createDataFrame([(3.0, 12, 2, 50.0, "sunny", 1.0, 0.9)],
                               "model_price double, hour int, day_of_week int, distance_km double, weather string, "
                               "event_demand_multiplier double, driver_supply_ratio double")
    r = df.select(surge_explanation().alias("r")).first()["r"]
    assert r["estimated_price_usd"] == 8.0
    assert r["surge_reason"] == "none"
    assert r["confidence"] == "medium"


def test_rule_fare(spark):
    rows = [(10.0, 12, 2, "sunny", 1.0, 1.0, "Doral"),          # 14 + 15 = 29
            (10.0, 23, 5, "stormy", 2.0, 0.0, "Brickell"),      # all multipliers
            (0.0, 4, 1, "sunny", 1.0, 1.0, "Doral")]             # 14 * 0.85 = 11.9
    df = spark.createDataFrame(rows, "distance_km double, hour int, day_of_week int, weather string, "
                                     "event_demand_multiplier double, driver_supply_ratio double, "
                                     "pickup_neighborhood string")
    got = [r[0] for r in df.select(rule_fare()).collect()]
    expect2 = round(29 * 1.5 * 1.1 * 1.4 * 1.4 * 1.25 * 1.08, 2)
    assert got[0] == 29.0
    assert abs(got[1] - expect2) < 0.011
    assert got[2] == 11.9


def test_demand_score_cap_and_event(spark):
    df = spark.createDataFrame([(23, 6, 12, 0.95, 0.95, 3.0), (12, 1, 6, 0.2, 0.25, None)],
                               "hour int, day_of_week int, month int, nightlife double, tourism double, event_factor double")
    got = [r[0] for r in df.select(demand_score()).collect()]
    assert got[0] == 1.0                       # capped
    assert got[1] == round(0.3 + 0.1 * 0.25, 3)


def test_compatibility_and_rating(spark):
    d = spark.createDataFrame([("SUV", 1, 1, 1, "none", 1, 0, 0, 4.5, 0.9, 0.1)],
                              "car_type string, speaks_spanish int, allows_pets int, prefers_quiet int, music_pref string, "
                              "is_nightlife_spec int, is_airport_spec int, is_event_spec int, rating double, "
                              "on_time_rate double, cancellation_rate double").alias("d")
    c = spark.createDataFrame([("SUV", 1, 1, 1, "pop", 1, 0, 0)],
                              "preferred_car_type string, prefers_spanish int, has_pet int, prefers_quiet int, "
                              "preferred_music string, is_nightlife_user int, is_airport_user int, is_event_user int").alias("c")
    v = d.crossJoin(c).select(compatibility("d", "c").alias("x")).first()["x"]
    # 0.5+.2+.12+.1+.08+.05+.1 +.05 +.072 -.02 = 1.252 -> clipped to 1
    assert v == 1.0
    df = spark.createDataFrame([(0.625,), (0.375,), (0.0,), (1.0,)], "x double")
    assert [r[0] for r in df.select(rating_from_compatibility("x")).collect()] == [4, 2, 1, 5]


def test_display_formats_and_json(spark):
    from ridewise.functions.exprs import hour_label, money, percent
    df = spark.createDataFrame([(764987.59, 0.918472, 7)], "rev double, util double, h int")
    r = df.select(money("rev").alias("m"), percent("util").alias("p"), hour_label("h").alias("l")).first()
    assert (r["m"], r["p"], r["l"]) == ("$764,988", "91.8%", "07:00")
    resp = spark.createDataFrame([(208.26, 23, 4, 8.5, "rainy", 2.5, 0.3)],
                                 "model_price double, hour int, day_of_week int, distance_km double, weather string, "
                                 "event_demand_multiplier double, driver_supply_ratio double")
    import json
    j = json.loads(resp.select(F.to_json(surge_explanation()).alias("j")).first()["j"])
    assert j["surge_reason"] == "late night, rainy weather, local event"
    assert j["breakdown"]["surge_multiplier"] == 6.18
