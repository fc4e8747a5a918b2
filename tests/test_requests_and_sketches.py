"""Dead-letter stream of request bodies; mergeable quantile sketches."""

import numpy as np
from pyspark.sql import functions as F

from ridewise.operators import sketch, validate
from ridewise.plans.q_stream import MATCH_BODY
from ridewise.session import scratch_path
from ridewise.streaming import jobs

GOOD = '{"preferred_car_type":"SUV","has_pet":1,"top_k":7,"other":[1]}'
BODIES = [(1, GOOD), (2, '{"preferred_car_type":"SUV"}'), (3, '{"preferred_car_type":"Boat","top_k":21}'), (4, '{"preferred_car_type":"SUV"'),
          (5, ""), (6, None), (7, "[1,2]"), (8, '{"preferred_car_type":"SUV","top_k":"many"}'), (9, "{}"),
          (10, '{"preferred_car_type":"SUV","price_sensitivity":1.5,"has_pet":2}')]


def test_every_body_is_in_the_right_sink(spark):
    path = scratch_path(spark, "bodies")
    spark.createDataFrame(BODIES, "request_id long, body string").repartition(4).write.parquet(path)
    stream = spark.readStream.schema("request_id long, body string").option("maxFilesPerTrigger", 1).parquet(path)
    valid, rejected = jobs.request_stream(stream, MATCH_BODY, validate.match_request_rules(), "bodies", validate.match_request_defaults)
    got = {r.request_id: (r.preferred_car_type, r.has_pet, r.price_sensitivity, r.top_k) for r in valid.collect()}
    assert got == {1: ("SUV", 1, 0.5, 7), 2: ("SUV", 0, 0.5, 5)}
    bad = {r.request_id: (r.errors, r.body) for r in rejected.collect()}
    assert set(bad) == {3, 4, 5, 6, 7, 8, 9, 10} and all(bad[i][1] == b for i, b in BODIES if i in bad)
    assert {i for i, (e, _) in bad.items() if e == "malformed body"} == {4, 5, 6, 7, 8}
    assert bad[9][0] == "preferred_car_type is required"
    assert bad[3][0].startswith("preferred_car_type must be one of") and "top_k must be in [1, 20]" in bad[3][0]
    assert bad[10][0] == "has_pet must be 0 or 1; price_sensitivity must be in [0, 1]"


def test_merged_sketches_stay_within_their_rank_error(spark):
    rng = np.random.default_rng(4)
    v = np.r_[rng.standard_cauchy(60_000), np.repeat(3.0, 20_000)]
    df = spark.createDataFrame([(int(i % 30), float(x)) for i, x in enumerate(v)], "day int, v double").repartition(6)
    ps = [0.01, 0.25, 0.5, 0.9, 0.99]
    days = sketch.sketch(df, "v", ["day"])
    path = scratch_path(spark, "sketches")
    days.write.parquet(path)
    got = sketch.quantiles(sketch.merge(spark.read.parquet(path).withColumn("all", F.lit(1)), ["all"]), ps).first()
    s, e = np.sort(v), sketch.rank_error()
    assert got["n"] == len(v)
    for p, x in zip(ps, got["quantiles"]):
        assert np.searchsorted(s, x, "left") / len(s) <= p + e and np.searchsorted(s, x, "right") / len(s) >= p - e


def test_sketch_cases(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), ("b", None)], "g string, v double")
    got = {r["g"]: (r["n"], list(r["quantiles"])) for r in sketch.quantiles(sketch.sketch(df, "v", ["g"]), [0.0, 1.0]).collect()}
    assert got == {"a": (2, [1.0, 3.0])}
    assert sketch.sketch(df.limit(0), "v", ["g"]).collect() == []
