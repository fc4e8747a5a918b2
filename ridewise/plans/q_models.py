"""Model queries: pricing and demand selection, fare prediction, scenario
forecast, and the fraud ensemble (J6-J10, J15, J17-J21, J26, J27).

Fitted outputs have no SQL twin; they get a rows-only check here and invariant
tests in ``tests/``. The models' own arithmetic is checked against SQL with given
numbers (``fixed_model_scores``) and for one tree (``boosted_first_tree``).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ridewise import constants as K
from ridewise.functions import calendar as cal
from ridewise.functions.exprs import round_half_up
from ridewise.functions.encode import apply_codes, fit_alphabetical
from ridewise.operators import anomaly, evaluate, forecast, geo, split, validate
from ridewise.operators import estimators as est
from ridewise.operators.boosting import HistogramBoosting, HistogramBoostingModel, Tree, model_arrays
from ridewise.plans.catalog import register
from ridewise.plans.sql_views import D, fraud_trips_cte, rides_cte, trips_cte, with_
from ridewise.session import cut_lineage, scratch_path
from ridewise.sources import bindings as B
from ridewise.sources import io
from ridewise.sources.models import fit_once
from ridewise.streaming import jobs


def by_importance():
    """The table of feature importances as one array, largest first, ties by name."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("importance")).alias("o"), "feature", "importance")))
    return F.transform(ordered, lambda x: F.struct(x["feature"].alias("feature"), x["importance"].alias("importance")))


def inputs(sf_dir: str, *tables: str) -> list[str]:
    return [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables]


def _encoded_rides(spark, sf_dir):
    r = B.rides(spark, sf_dir)
    codes = fit_alphabetical(r, ["pickup_neighborhood", "dropoff_neighborhood"], "code")
    r = apply_codes(r, codes, "pickup_neighborhood", "pickup_enc")
    r = apply_codes(r, codes, "dropoff_neighborhood", "dropoff_enc")
    return r, codes


def _selected(spark, train_test, label, candidates, codes, features, **kw):
    """J9 as a fit to store: metrics, zone codes, importances, all candidates, the best one's name."""
    s = cut_lineage(train_test, "train-test")            # read by every fit and the evaluation
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    metrics, best, models = forecast.evaluate_candidates(spark, train, test, label, candidates, **kw)
    importance = forecast.feature_importance(spark, models[best], features)
    return {"metrics": metrics, "codes": codes, "importance": importance}, models, {"best": best}


def _pricing(spark, sf_dir, rounds=400):
    """The stored pricing fit; the fit runs once per version of ``events``."""
    def fit():
        r, codes = _encoded_rides(spark, sf_dir)
        s = split.hash_split(r, "trip_id", 20).select("trip_id", "price_usd", "split", *K.PRICING_FEATURES)
        return _selected(spark, s, "price_usd", forecast.pricing_candidates(rounds), codes, K.PRICING_FEATURES, metric="mae")
    return fit_once(spark, "pricing", inputs(sf_dir, "events"), {"rounds": rounds}, fit)


@register("pricing_model_selection", None, ops=("J6", "J7", "J9", "J10", "J22", "B9", "J1"), heavy=True)
def pricing_model_selection(spark, sf_dir):
    found = _pricing(spark, sf_dir)
    return found.table("metrics").crossJoin(found.table("importance").groupBy().agg(by_importance().alias("best_feature_importance")))


def _geo_features(spark, sf_dir):
    g = B.geo_trips(spark, sf_dir)
    g = cal.add_cyclical(g, {"hour": ("hour", 24), "dow": ("day_of_week", 7), "month": ("month", 12)})
    codes = fit_alphabetical(g, ["neighborhood"], "code")
    return apply_codes(g, codes, "neighborhood", "neighborhood_enc"), codes


def _demand(spark, sf_dir, rounds=300, trees=300):
    """The stored demand fit; the fit runs once per version of ``events``."""
    def fit():
        g, codes = _geo_features(spark, sf_dir)
        s = split.hash_split(g, "trip_id", 20).select("trip_id", "demand_score", "split", *K.DEMAND_FEATURES)
        return _selected(spark, s, "demand_score", forecast.demand_candidates(rounds, trees), codes, K.DEMAND_FEATURES, clip01=True,
                         metric="r2", lower_is_better=False)
    return fit_once(spark, "demand", inputs(sf_dir, "events"), {"rounds": rounds, "trees": trees}, fit)


@register("demand_model_selection", None, ops=("J8", "J9", "J10", "B16", "B23"), heavy=True)
def demand_model_selection(spark, sf_dir):
    found = _demand(spark, sf_dir)
    return found.table("metrics").crossJoin(found.table("importance").groupBy().agg(by_importance().alias("best_feature_importance")))


@register("fare_predictions", None, ops=("J26", "B4", "C6", "A5", "A6", "A8", "I-json"), heavy=True)
def fare_predictions(spark, sf_dir):
    found = _pricing(spark, sf_dir)
    model, codes = found.model(found.facts["best"]), found.table("codes")
    req = validate.validate(B.price_requests(spark, sf_dir), validate.price_request_rules())
    valid, rejected = validate.split_valid(req)
    v = (valid.withColumn("weather_encoded", F.array_position(F.array(*[F.lit(w) for w in K.WEATHER]), F.col("weather")) - 1)
              .withColumn("is_weekend", cal.is_weekend("day_of_week"))
              .withColumn("is_night", cal.is_night("hour"))
              .withColumn("is_rush_hour", cal.is_rush_hour("hour"))
              .withColumn("demand_supply_ratio",
                          round_half_up(F.col("pending_requests") / (F.col("active_drivers") + 1), 2)))
    v = apply_codes(v, codes, "pickup_neighborhood", "pickup_enc", handle_invalid="error")
    v = apply_codes(v, codes, "dropoff_neighborhood", "dropoff_enc", handle_invalid="error")
    out = forecast.predict_fares(model, v)
    # a rejected request comes back with its errors and without a price
    bad = rejected.select("request_id", F.array_join("errors", "; ").alias("errors"))
    return (out.select("request_id", "response.*", "response_json", F.lit("").alias("errors"))
               .unionByName(bad, allowMissingColumns=True))


@register("scenario_demand_forecast", None, ops=("J27", "D9", "A6"), heavy=True)
def scenario_demand_forecast(spark, sf_dir):
    found = _demand(spark, sf_dir)
    s = geo.scenario_grid(spark, K.SCENARIO_ZONES, K.GRID_SCENARIO_DOW, K.GRID_SCENARIO_MONTH)
    s = cal.add_cyclical(s, {"hour": ("hour", 24), "dow": ("day_of_week", 7), "month": ("month", 12)})
    s = apply_codes(s, found.table("codes"), "neighborhood", "neighborhood_enc")
    p = found.model(found.facts["best"]).transform(s)
    return p.select("neighborhood", "hour", F.col("prediction").alias("predicted_demand"))


@register("stream_model_fares", None, ops=("K2", "J26", "A6", "C6"), heavy=True)
def stream_model_fares(spark, sf_dir):
    """K2 with the fitted pipeline: a stream of rides, encoded with the frozen
    codes and priced by the model loaded from the shared folder."""
    found = _pricing(spark, sf_dir)
    model, codes = found.model(found.facts["best"]), found.table("codes")
    boosts = cut_lineage(B.pricing_boost_by_date(spark, B.trips(spark, sf_dir).select("date")))
    rides = B.rides_from_trips(spark, B.trips_from_events(jobs.event_stream(spark, sf_dir)), boosts)
    rides = apply_codes(rides, codes, "pickup_neighborhood", "pickup_enc", handle_invalid="error")
    rides = apply_codes(rides, codes, "dropoff_neighborhood", "dropoff_enc", handle_invalid="error")
    fares = forecast.predict_fares(model, rides.withColumnRenamed("trip_id", "request_id"))
    return jobs.run_available_now(fares.select("request_id", "response.*", "response_json"), "k2-model")


# ----------------------------------------------------------------- fraud ensemble

def _fraud(spark, sf_dir, trees=K.IFOREST_TREES, epochs=K.AE_EPOCHS, rounds=300):
    """The stored fraud pipeline, one ``PipelineModel`` of own stages: scaler (J5),
    isolation forest (J17) and its rescaling (E29), autoencoder (J18, J19), boosted
    classifier with weighted positives (J20), ensemble (J21).

    Everything but the ensemble is fitted on the training rows, the ensemble's
    weights and bounds on a validation split inside train (Q13); nothing sees the
    test rows, which are stored beside the model."""
    def fit():
        f = B.fraud_trips(spark, sf_dir).na.fill(0, subset=K.FRAUD_FEATURES)   # B8
        f = f.select("trip_id", "is_fraud", "fraud_type", *K.FRAUD_FEATURES)
        s = cut_lineage(split.stratified_split(cut_lineage(f, "fraud-trips"), "trip_id", "is_fraud", 0.2), "fraud-split")
        v = cut_lineage(split.stratified_split(s.where(F.col("split") == "train").drop("split"), "trip_id", "is_fraud", 0.2), "fraud-train")
        train, val, test = v.where(F.col("split") == "train"), v.where(F.col("split") == "test"), s.where(F.col("split") == "test")
        z = [f"z_{c}" for c in K.FRAUD_FEATURES]
        c = train.agg(F.sum((F.col("is_fraud") == 0).cast("long")).alias("neg"), F.sum((F.col("is_fraud") == 1).cast("long")).alias("pos")).first()
        weight = float((c["neg"] or 0) // max(c["pos"] or 0, 1))
        scaler = est.Scaling(inputCols=K.FRAUD_FEATURES).fit(train)
        x = cut_lineage(scaler.transform(train).withColumn("__w", F.when(F.col("is_fraud") == 1, weight).otherwise(1.0)), "fraud-scaled")
        iso = est.IsolationForest(inputCols=z, keyCol="trip_id", trees=trees).fit(x)
        scaled = est.Scaling(inputCols=["iso_score"], kind="minmax", clip=True, prefix="scaled_").fit(iso.transform(x))
        ae = est.Autoencoder(inputCols=z, labelCol="is_fraud", epochs=epochs).fit(x)
        clf = HistogramBoosting(inputCols=K.FRAUD_FEATURES, labelCol="is_fraud", weightCol="__w", keyCol="trip_id", outputCol="xgb_score",
                                objective="logistic", rounds=rounds, maxDepth=5, rate=0.05, l2=1.0, leastHessian=1.0, maxBins=128).fit(x)
        stages = [scaler, iso, scaled, ae, clf]
        ens = est.Ensemble(inputCols=["scaled_iso_score", "ae_score", "xgb_score"], labelCol="is_fraud").fit(PipelineModel(stages).transform(val))
        return {"test": test.drop("split")}, {"fraud": PipelineModel([*stages, ens])}, {"aucs": ens.arrays["aucs"].tolist()}
    return fit_once(spark, "fraud", inputs(sf_dir, "events"), {"trees": trees, "epochs": epochs, "rounds": rounds}, fit)


@register("isolation_forest_scores", None, ops=("J17", "J5", "J2", "E29", "A6"), heavy=True)
def isolation_forest_scores(spark, sf_dir):
    found = _fraud(spark, sf_dir)
    return found.model("fraud").transform(found.table("test")).select(
        "trip_id", "is_fraud", "fraud_type", "iso_score", F.col("scaled_iso_score").alias("iso_score_scaled"))


@register("autoencoder_scores", None, ops=("J18", "J19", "B6", "E12", "B23", "A6"), heavy=True)
def autoencoder_scores(spark, sf_dir):
    found = _fraud(spark, sf_dir)
    return found.model("fraud").transform(found.table("test")).select("trip_id", "is_fraud", "fraud_type", "recon_error", "ae_score")


@register("fraud_ensemble_report", None, ops=("J20", "J21", "J23", "J24", "J25", "Q13", "A6"), heavy=True)
def fraud_ensemble_report(spark, sf_dir):
    found = _fraud(spark, sf_dir)
    t = cut_lineage(found.model("fraud").transform(found.table("test")).select("is_fraud", "ensemble_score", "is_flagged"), "fraud-scores")
    auc = evaluate.roc_auc(t, "is_fraud", "ensemble_score").select(F.lit("ensemble_auc").alias("metric"), F.col("auc").alias("value"))
    aucs = dict(zip(("iso", "ae", "xgb"), found.facts["aucs"]))
    w = spark.createDataFrame([(f"weight_{k}", v / sum(aucs.values())) for k, v in aucs.items()]
                              + [(f"val_auc_{k}", float(v)) for k, v in aucs.items()], "metric string, value double")
    cm = evaluate.confusion_matrix(t, "is_fraud", "is_flagged").select(
        F.concat(F.lit("cm_"), F.col("actual").cast("string"), F.lit("_"), F.col("predicted").cast("string")).alias("metric"),
        F.col("count").cast("double").alias("value"))
    rep = evaluate.classification_report(t, "is_fraud", "is_flagged").select(
        F.concat(F.lit("f1_"), F.col("class")).alias("metric"), F.col("f1").alias("value"))
    return auc.unionByName(w).unionByName(cm).unionByName(rep)


@register("stream_fraud_model_scores", None, ops=("K3", "J20", "J21", "A6"), heavy=True)
def stream_fraud_model_scores(spark, sf_dir):
    """K3 with the stored fraud pipeline: a stream of trips, scored and flagged
    row by row; every row names the model's version."""
    found = _fraud(spark, sf_dir)
    path = scratch_path(spark, "fraud-stream")
    found.table("test").write.parquet(path)
    stream = spark.readStream.schema(found.table("test").schema).parquet(path)
    return jobs.run_available_now(jobs.model_scoring(stream, found.model("fraud"), found.version), "k3-model")


# ----------------------------------------------------------------- fixed models

#: features of the fixed pipeline; any numbers do, they only have to be the same in both engines. Widths are
#: primes, so that quotients do not end in a digit 5 that two engines round apart
FIXED_COLS = ["fare_usd", "distance_km", "location_jump_km"]
FIXED_SHIFT, FIXED_WIDTH = [50.0, 30.0, 4.0], [29.0, 17.0, 7.0]
#: trees as (feature, threshold, left, right, size)
FIXED_TREES = [([0, 1, -1, -1, -1], [0.5, -0.25, 0.0, 0.0, 0.0], [1, 2, -1, -1, -1], [4, 3, -1, -1, -1], [8, 6, 1, 5, 2]),
               ([2, -1, 0, -1, -1], [0.125, 0.0, 1.0, 0.0, 0.0], [1, -1, 3, -1, -1], [2, -1, 4, -1, -1], [8, 5, 3, 2, 1])]
FIXED_PSI = 8
FIXED_LAYERS = [([[0.5, -0.25], [0.25, 0.5], [-0.5, 0.75]], [0.125, -0.25]), ([[1.0, 0.5, -0.5], [-0.5, 0.25, 0.75]], [0.0, 0.125, -0.125])]
FIXED_CUT = 1.5
FIXED_STUMPS = [(0, 60.0, -0.5, 0.75), (2, 2.0, -0.25, 0.5)]        # feature, greatest value that goes left, values of the leaves
FIXED_START, FIXED_AUCS, FIXED_BOUNDS = -1.0, [0.5, 0.75, 0.75], [0.125, 0.875]


def stump_arrays(stumps, n_features: int, start: float, gains=None) -> dict[str, np.ndarray]:
    """A boosted model of trees with one split each: (feature, greatest value that goes left, values of the leaves)."""
    edges = [sorted(t for g, t, *_ in stumps if g == f) for f in range(n_features)]
    trees = []
    for (f, t, left, right), gain in zip(stumps, gains or [1.0] * len(stumps)):
        tree = Tree()
        tree.split(0, f, edges[f].index(t), gain)
        tree.value[1:] = [left, right]
        trees.append(tree)
    return model_arrays([np.array(e) for e in edges], trees, start)


def stumps_sql(stumps, start: float, names=lambda f: f"x{f}") -> str:
    """The same model's margin; a null feature goes left."""
    return D(start) + "".join(f" + CASE WHEN {names(f)} > {D(t)} THEN {D(b)} ELSE {D(a)} END" for f, t, a, b in stumps)


def fixed_pipeline() -> PipelineModel:
    """Own stages with given numbers, as a user would load them."""
    z = [f"z_{c}" for c in FIXED_COLS]
    return PipelineModel([
        est.ScalingModel({"shift": FIXED_SHIFT, "width": FIXED_WIDTH}).with_params(inputCols=FIXED_COLS),
        est.IsolationForestModel(est.forest_arrays(FIXED_TREES, FIXED_PSI)).with_params(inputCols=z),
        est.AutoencoderModel(est.network_arrays(FIXED_LAYERS) | {"threshold": [FIXED_CUT]}).with_params(inputCols=z),
        HistogramBoostingModel(stump_arrays(FIXED_STUMPS, len(FIXED_COLS), FIXED_START))
        .with_params(inputCols=FIXED_COLS, outputCol="xgb_score", objective="logistic"),
        est.EnsembleModel({"aucs": FIXED_AUCS, "bounds": FIXED_BOUNDS}).with_params(inputCols=["iso_score", "ae_score", "xgb_score"])])


def _fixed_sql() -> str:
    z = [f"((coalesce({c}, 0) - {D(a)}) / {D(w)})" for c, a, w in zip(FIXED_COLS, FIXED_SHIFT, FIXED_WIDTH)]

    def path(tree, node, depth):
        f, t, left, right, size = (x[node] for x in tree)
        if f < 0:
            return D(depth + anomaly._c(size))
        return f"CASE WHEN z{f} < {D(t)} THEN {path(tree, left, depth + 1)} ELSE {path(tree, right, depth + 1)} END"

    (w0, b0), (w1, b1) = FIXED_LAYERS
    hid = [f"greatest({' + '.join(f'z{i} * {D(w0[i][j])}' for i in range(3))} + {D(b0[j])}, 0.0::DOUBLE)" for j in range(2)]
    err = " + ".join(f"pow(z{k} - ({' + '.join(f'h{j} * {D(w1[j][k])}' for j in range(2))} + {D(b1[k])}), 2)" for k in range(3))
    margin = D(FIXED_START) + "".join(f" + CASE WHEN coalesce({FIXED_COLS[f]}, 0) <= {D(t)} THEN {D(a)} ELSE {D(b)} END"
                                      for f, t, a, b in FIXED_STUMPS)
    total = " + ".join(f"{c} * {D(a / sum(FIXED_AUCS))}" for c, a in zip(("iso_score", "ae_score", "xgb_score"), FIXED_AUCS))
    lo, hi = FIXED_BOUNDS
    return with_(trips_cte(), fraud_trips_cte()) + f"""
, f0 AS (SELECT *, {', '.join(f'{x} AS z{i}' for i, x in enumerate(z))} FROM fraud_trips),
f1 AS (SELECT *, pow(2, -(({path(FIXED_TREES[0], 0, 0)}) + ({path(FIXED_TREES[1], 0, 0)})) / 2 / {D(anomaly._c(FIXED_PSI))}) AS iso_score,
              {hid[0]} AS h0, {hid[1]} AS h1 FROM f0),
f2 AS (SELECT *, ({err}) / 3 AS recon_error, 1 / (1 + exp(-({margin}))) AS xgb_score FROM f1),
f3 AS (SELECT *, least(recon_error / {D(2 * FIXED_CUT)}, 1.0::DOUBLE) AS ae_score FROM f2),
f4 AS (SELECT *, least(greatest(({total} - {D(lo)}) / {D(hi - lo)}, 0.0::DOUBLE), 1.0::DOUBLE) AS e FROM f3)
SELECT trip_id, round(iso_score, 6) AS iso_score, round(recon_error, 6) AS recon_error, round(ae_score, 6) AS ae_score,
       round(xgb_score, 6) AS xgb_score, round(e, 6) AS ensemble_score, CAST(e >= {D(K.FRAUD_THRESHOLD)} AS INTEGER) AS is_flagged"""


def _rounded(df):
    return df.select("trip_id", *[F.round(c, 6).alias(c) for c in ("iso_score", "recon_error", "ae_score", "xgb_score", "ensemble_score")],
                     "is_flagged")


def _saved(spark, model):
    """Written to the shared folder and loaded again."""
    path = scratch_path(spark, "model")
    io.save_model(model, path)
    return io.load_model(path)


@register("fixed_model_scores", _fixed_sql() + " FROM f4", ops=("A5", "A6", "J5", "J17", "J18", "J19", "J20", "J21"))
def fixed_model_scores(spark, sf_dir):
    """A pipeline of own stages, saved, loaded and applied to every trip."""
    return _rounded(_saved(spark, fixed_pipeline()).transform(B.fraud_trips(spark, sf_dir)))


@register("stream_fixed_model_scores", _fixed_sql() + ", 'fixed' AS model_version, " + """
       concat_ws(',',
         CASE WHEN speed_kmh > 90.0 AND location_jump_km > 15.0 THEN 'gps_spoofing' END,
         CASE WHEN fare_distance_ratio > 40.0 THEN 'fare_manipulation' END,
         CASE WHEN duration_min <= 3.0 AND speed_kmh > 90.0 THEN 'fake_completion' END,
         CASE WHEN new_device = 1 AND location_jump_km > 15.0 THEN 'account_takeover' END,
         CASE WHEN trip_count_today >= 15 AND cancellations_today >= 3 THEN 'promo_abuse' END) AS patterns FROM f4""",
          ops=("K3", "A6", "C7", "J20", "J21"))
def stream_fixed_model_scores(spark, sf_dir):
    """K3: the same pipeline and the pattern rules over a stream of trips, all
    bounds frozen; row for row what the batch gives."""
    path = scratch_path(spark, "fraud-trips")
    B.fraud_trips(spark, sf_dir).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    scored = jobs.model_scoring(stream, _saved(spark, fixed_pipeline()), "fixed", frozen_bound=40.0)
    out = jobs.run_available_now(scored, "k3-fixed")
    return _rounded(out).join(out.select("trip_id", "model_version", "patterns"), "trip_id")


# ----------------------------------------------------------------- selection among fixed models

SELECT_COLS = ["distance_km", "hour", "event_demand_multiplier", "weather_encoded"]
#: candidates as (start, stumps, gains of the splits); distances are cut between two steps of their grid
FIXED_CANDIDATES = {"coarse": (20.0, [(0, 10.005, -8.0, 12.0), (1, 6.5, 2.0, -0.5)], [3.0, 1.0]),
                    "fine": (16.0, [(0, 5.005, -6.0, 2.0), (0, 15.005, -2.0, 10.0), (0, 25.005, -1.0, 12.0), (1, 16.5, -0.5, 1.5),
                                    (2, 1.25, -0.5, 3.0), (3, 0.5, -0.25, 1.0)], [4.0, 3.0, 2.0, 1.0, 1.5, 0.5]),
                    "constant": (25.0, [(3, 1.5, 0.0, 0.0)], [0.0])}


def _fixed_selection_sql() -> str:
    preds, rows = [], []
    for order, (name, (start, stumps, gains)) in enumerate(FIXED_CANDIDATES.items()):
        margin = stumps_sql(stumps, start, lambda f: f"coalesce({SELECT_COLS[f]}, 0)")
        preds.append(f"SELECT '{name}' AS model, {order} AS o, price_usd AS y, {margin} AS p FROM t")
        by = {f: sum(g for (i, *_), g in zip(stumps, gains) if i == f) for f in range(len(SELECT_COLS))}
        total = sum(gains)
        imp = sorted(((-(by[f] / total if total else 0.0), SELECT_COLS[f]) for f in by))
        rows.append(f"('{name}', '{','.join(c for _, c in imp)}', {D(-imp[0][0])})")
    return with_(trips_cte(), rides_cte()) + f"""
, t AS (SELECT * FROM rides WHERE (('0x' || substr(md5(CAST(trip_id AS VARCHAR)), 1, 8))::BIGINT) % 100 < 20),
p AS ({' UNION ALL '.join(preds)}),
m AS (SELECT model, o, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
             1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS r2, avg(abs(y - p) / nullif(abs(y), 0)) * 100 AS mape, count(*) AS n
      FROM p WHERE y IS NOT NULL GROUP BY model, o),
best AS (SELECT model FROM m ORDER BY mae, o LIMIT 1)
SELECT m.model, round(mae, 5) AS mae, round(rmse, 5) AS rmse, round(r2, 5) AS r2, round(mape, 4) AS mape, n,
       m.model = best.model AS selected, i.features AS features_by_importance, round(i.top, 6) AS top_importance
FROM m, best, (VALUES {', '.join(rows)}) AS i(model, features, top) WHERE m.model = i.model"""


@register("fixed_model_selection", _fixed_selection_sql(), ops=("J1", "J6", "J9", "J10", "J22"))
def fixed_model_selection(spark, sf_dir):
    """J9 and J10 with candidates whose trees are given: errors over all test rows,
    the selected one, and the order of the features by their share of the gain."""
    r = B.rides(spark, sf_dir).select("trip_id", "price_usd", *SELECT_COLS)
    s = cut_lineage(split.hash_split(r, "trip_id", 20), "train-test")
    given = {name: Pipeline(stages=[HistogramBoostingModel(stump_arrays(stumps, len(SELECT_COLS), start, gains)).with_params(inputCols=SELECT_COLS)])
             for name, (start, stumps, gains) in FIXED_CANDIDATES.items()}
    metrics, _, models = forecast.evaluate_candidates(spark, s.where(F.col("split") == "train"), s.where(F.col("split") == "test"),
                                                      "price_usd", given)
    order = None
    for name, m in models.items():
        all_ = forecast.feature_importance(spark, m, SELECT_COLS).groupBy().agg(by_importance().alias("i"))
        one = all_.select(F.lit(name).alias("model"), F.array_join(F.transform("i", lambda x: x["feature"]), ",").alias("features_by_importance"),
                          F.round(F.col("i")[0]["importance"], 6).alias("top_importance"))
        order = one if order is None else order.unionByName(one)
    return metrics.join(order, "model").select("model", *[F.round(c, 5).alias(c) for c in ("mae", "rmse", "r2")], F.round("mape", 4).alias("mape"),
                                               "n", "selected", "features_by_importance", "top_importance")


# ----------------------------------------------------------------- one boosted tree against SQL

def _tree_sql(l2: float = 1.0) -> str:
    """A depth-2 tree by grouped sums: for every feature and value, the gain of
    sending values up to it to the left."""
    cols = ["hour", "day_of_week", "weather_encoded", "active_drivers"]
    feats = " UNION ALL ".join(f"SELECT node, '{c}' AS feature, {i} AS o, CAST({c} AS DOUBLE) AS x, y FROM %s" for i, c in enumerate(cols))

    def level(rows: str, name: str) -> str:
        return f"""{name}_v AS (SELECT node, feature, o, x, sum(y) AS g, count(*) AS n FROM ({feats.replace('%s', rows)}) GROUP BY ALL),
{name}_c AS (SELECT *, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER t AS gt, sum(n) OVER t AS nt FROM {name}_v
   WINDOW w AS (PARTITION BY node, feature ORDER BY x), t AS (PARTITION BY node, feature)),
{name}_s AS (SELECT *, gl * gl / (nl + {D(l2)}) + (gt - gl) * (gt - gl) / (nt - nl + {D(l2)}) - gt * gt / (nt + {D(l2)}) AS gain
   FROM {name}_c WHERE nl < nt),
{name} AS (SELECT * FROM {name}_s QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, o, x) = 1)"""

    side = " ".join(f"WHEN s.feature = '{c}' THEN r.{c}" for c in cols)
    return with_(trips_cte(), rides_cte()) + f"""
, r0 AS (SELECT 0 AS node, {', '.join(cols)}, CAST(floor(price_usd) AS DOUBLE) AS y FROM rides), {level('r0', 's0')},
r1 AS (SELECT CASE WHEN CASE {side} END <= s.x THEN 1 ELSE 2 END AS node, r.* EXCLUDE (node) FROM r0 r, s0 s), {level('r1', 's1')}
SELECT node, feature, x AS threshold, round(gain, 3) AS gain, CAST(nl AS BIGINT) AS rows_left, CAST(nt - nl AS BIGINT) AS rows_right,
       round(gl / (nl + {D(l2)}), 6) AS value_left, round((gt - gl) / (nt - nl + {D(l2)}), 6) AS value_right
FROM (SELECT * FROM s0 UNION ALL SELECT * FROM s1)"""


@register("boosted_first_tree", _tree_sql(), ops=("J6", "J8", "J15"))
def boosted_first_tree(spark, sf_dir):
    """One round of depth 2 on exact bins, from 0 and with step 1: the splits,
    and for each the value of either side."""
    cols = ["hour", "day_of_week", "weather_encoded", "active_drivers"]
    r = cut_lineage(B.rides(spark, sf_dir).select("trip_id", *cols, F.floor("price_usd").cast("double").alias("y")), "tree-rows")
    m = HistogramBoosting(inputCols=cols, labelCol="y", keyCol="trip_id", rounds=1, maxDepth=2, rate=1.0, l2=1.0, start=0.0, maxBins=255).fit(r)
    n = m.nodes(r)
    inner = n.where(F.col("feature").isNotNull())
    side = {k: F.col(k) for k in ("left", "right")}
    at = [i["node"] for i in inner.orderBy("node").collect()]                       # at most three splits
    by = {i["node"]: i for i in inner.collect()}
    sums = None
    for k in at:
        node, rows = by[k], r
        for up in at:                                                               # the way down to this split
            if k in (by[up]["left"], by[up]["right"]):
                low = F.col(by[up]["feature"]) <= by[up]["threshold"]
                rows = rows.where(low if k == by[up]["left"] else ~low)
        left = F.col(node["feature"]) <= node["threshold"]
        got = rows.agg(F.count(F.when(left, 1)).alias("nl"), F.count(F.when(~left, 1)).alias("nr"), F.sum(F.when(left, F.col("y"))).alias("gl"),
                       F.sum(F.when(~left, F.col("y"))).alias("gr")).withColumn("node", F.lit(k))
        sums = got if sums is None else sums.unionByName(got)
    return inner.drop(*side).join(sums, "node").select(
        "node", "feature", "threshold", F.round("gain", 3).alias("gain"), F.col("nl").alias("rows_left"), F.col("nr").alias("rows_right"),
        F.round(F.col("gl") / (F.col("nl") + 1.0), 6).alias("value_left"), F.round(F.col("gr") / (F.col("nr") + 1.0), 6).alias("value_right"))
