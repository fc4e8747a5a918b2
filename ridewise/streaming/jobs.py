"""Structured Streaming jobs.

K1  zone demand per event-time window: two chained aggregations (per driver, then
    per zone), so drivers are counted exactly and no group holds a set of them
K2  stateless price scoring of a request stream (stream-static join)
K3  fraud scoring with stored models and bounds frozen from training
K4  per-rider running features with ``transformWithStateInPandas`` on the RocksDB
    state store; a row is emitted once the watermark has passed it, so rows that
    arrive out of order within the watermark count in event-time order

Every job reads a file stream, writes a parquet sink and keeps its checkpoint in
the shared folder (``spark.checkpoint.dir``), so a restarted query resumes where it
stopped. ``run_available_now`` drives a job over the data present and returns the
sink as a batch DataFrame. ``run_to_end`` does so for a table that is finished: a
heartbeat then moves the watermark past its last row, so that open windows close
and held rows come out. Each run writes its progress (input, late rows dropped,
rows of state, by batch) as a table, ``progress_table``.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ridewise.functions.exprs import round_half_up
from ridewise.functions.rules import fraud_patterns, surge_explanation
from ridewise.session import scratch_path
from ridewise.sources import bindings as B

WATERMARK = "10 minutes"
WINDOW = "1 hour"


def _is_dir(spark: SparkSession, path: str) -> bool:
    """Asks the path's own store (HDFS, S3, local, ...)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def event_stream(spark: SparkSession, sf_dir: str, table: str = "events", max_files: int | None = None) -> DataFrame:
    """File stream over a table directory; schema taken from the batch table."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if _is_dir(spark, path):
        return r.parquet(path)
    # a single-file table: stream its directory, filtered to that file name
    return r.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


PROGRESS = "job string, batch long, input_rows long, late_rows long, state_rows long, watermark string"
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class Run:
    """One job's sink, checkpoint and progress table; may be started again and
    goes on where it stopped."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.sink, self.checkpoint, self.progress = (scratch_path(spark, f"{name}-{k}") for k in ("sink", "ckpt", "progress"))

    def start(self, df: DataFrame, output_mode: str = "append", timeout_s: int | None = None, conf: dict | None = None) -> None:
        """Runs the job over all data present. No time limit unless one is given."""
        spark = self.spark
        before = {k: spark.conf.get(k, None) for k in conf or {}}
        try:
            for k, v in (conf or {}).items():
                spark.conf.set(k, v)
            q = (df.writeStream.format("parquet").option("path", self.sink).option("checkpointLocation", self.checkpoint)
                   .outputMode(output_mode).trigger(availableNow=True).start())
            if timeout_s is None:
                q.awaitTermination()
            elif not q.awaitTermination(timeout_s):
                q.stop()
                raise TimeoutError(f"streaming job {self.name} did not finish in {timeout_s}s")
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        rows = []
        for p in map(lambda x: json.loads(x.json), q.recentProgress):
            state = p.get("stateOperators", [])
            rows.append((self.name, p["batchId"], p["numInputRows"], sum(o.get("numRowsDroppedByWatermark", 0) for o in state),
                         sum(o.get("numRowsTotal", 0) for o in state), p.get("eventTime", {}).get("watermark")))
        spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.progress)

    def rows(self, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.sink)

    def progress_table(self) -> DataFrame:
        """One row a batch: input rows, rows dropped as too late, rows of state."""
        return self.spark.read.parquet(self.progress)


def run_available_now(df: DataFrame, name: str, output_mode: str = "append",
                      timeout_s: int | None = None) -> DataFrame:
    """Runs the job over all data present and reads the sink."""
    run = Run(df.sparkSession, name)
    run.start(df, output_mode, timeout_s)
    return run.rows(df.schema)


def run_to_end(events: DataFrame, last, job: Callable[[DataFrame], DataFrame], name: str, time_col: str = "ts",
               conf: dict | None = None) -> tuple[DataFrame, Run]:
    """Runs ``job`` over a stream whose table is finished, until every row of it
    is out. ``last``: the greatest event time of the table.

    A second file stream, empty at first, joins the events. Once the job has taken
    in all of them, a heartbeat is written there: a row two days later, null but
    for its time. Taking it in moves the watermark past all rows; it stays in
    state itself (no watermark passes it) and so never reaches the sink.
    """
    spark = events.sparkSession
    beat = scratch_path(spark, f"{name}-heartbeat")
    path = spark._jvm.org.apache.hadoop.fs.Path(beat)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    df = job(events.unionByName(spark.readStream.schema(events.schema).parquet(beat)))
    run = Run(spark, name)
    run.start(df, conf=conf)
    if last is not None:
        late = spark.range(1).select(*[(F.lit(last).cast(f.dataType) + F.expr("INTERVAL 2 DAYS") if f.name == time_col else
                                        F.lit(None).cast(f.dataType)).alias(f.name) for f in events.schema.fields])
        late.write.mode("append").parquet(beat)
        run.start(df, conf=conf)
    return run.rows(df.schema), run


# --------------------------------------------------------------------------- A8

def request_stream(bodies: DataFrame, schema: str, rules: list, name: str, fill: Callable[[DataFrame], DataFrame] | None = None,
                   key: str = "request_id", body: str = "body") -> tuple[DataFrame, DataFrame]:
    """A stream of JSON request bodies. Every body is parsed by the whole
    ``schema``, gets its defaults (``fill``) and is checked by ``rules`` (B4, B5); valid
    requests go to one sink, all others with their errors and the body as it came
    to a dead-letter sink. Returns both sinks.

    A body that is not JSON or holds a value of another type: ``malformed body``.
    A batch is computed once and written to a folder of its number in both sinks,
    so a repeated batch replaces what it had written.
    """
    from ridewise.operators.validate import validate
    spark = bodies.sparkSession
    run = Run(spark, name)
    parsed = T.StructType(T._parse_datatype_string(schema).fields + [T.StructField("__corrupt", T.StringType())])

    def write(batch: DataFrame, number: int) -> None:
        b = F.from_json(body, parsed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"})
        p = batch.select(key, F.col(body).alias("__body"), b.alias("__b"))
        broken = F.col("__b").isNull() | F.col("__b.__corrupt").isNotNull()
        flat = p.select(key, "__body", broken.alias("__broken"), *[F.col(f"__b.{f.name}").alias(f.name) for f in parsed.fields[:-1]])
        v = validate(fill(flat) if fill else flat, rules)
        v = v.withColumn("errors", F.when(F.col("__broken"), F.lit("malformed body"))
                                    .otherwise(F.array_join("errors", "; ")))
        v = v.withColumn("part", F.when(F.col("errors") == "", "valid").otherwise("rejected")).drop("__broken", "is_valid")
        v.write.mode("overwrite").partitionBy("part").parquet(f"{run.sink}/batch={number}")

    q = (bodies.writeStream.foreachBatch(write).option("checkpointLocation", run.checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    names = [f.name for f in parsed.fields[:-1]]
    shape = fill(spark.createDataFrame([], schema)).schema if fill else T.StructType(parsed.fields[:-1])
    out_schema = T.StructType([T.StructField(key, bodies.schema[key].dataType), T.StructField("__body", T.StringType()),
                               *[shape[n] for n in names], T.StructField("errors", T.StringType()), T.StructField("batch", T.LongType()),
                               T.StructField("part", T.StringType())])
    sink = spark.read.schema(out_schema).option("basePath", run.sink).parquet(run.sink)
    return (sink.where(F.col("part") == "valid").select(key, *names),
            sink.where(F.col("part") == "rejected").select(key, "errors", F.col("__body").alias(body)))


# --------------------------------------------------------------------------- K1

def zone_window_demand(trips: DataFrame) -> DataFrame:
    """K1: requests, active drivers, completions, fares, and requests per active
    driver (plus one, as in B17) per (hour window, zone), with a 10-minute
    watermark; a window is emitted once the watermark has closed it (append)."""
    t = trips.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", WATERMARK)
    t = t.withColumn("driver_id", B.driver_of(F.col("trip_id")))
    by_driver = (t.groupBy(F.window("event_time", WINDOW).alias("w"), "neighborhood", "driver_id")
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("completed").alias("done"), F.sum("fare_usd").alias("paid")))
    g = (by_driver.groupBy(F.window(F.window_time("w"), WINDOW).alias("v"), "neighborhood")
                  .agg(F.sum("n").alias("requests"), F.count("driver_id").alias("active_drivers"), F.sum("done").alias("completed"),
                       F.sum("paid").alias("fares")))
    return g.select(F.col("v.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("v.end").cast("timestamp_ntz").alias("window_end"), "neighborhood", "requests", "active_drivers",
                    "completed", "fares",
                    round_half_up(F.col("requests") / (F.col("active_drivers") + 1), 2).alias("demand_supply_ratio"))


# --------------------------------------------------------------------------- K2

def price_scoring(spark: SparkSession, trips: DataFrame, boosts: DataFrame) -> DataFrame:
    """K2: each request is priced by the rule fare and explained (stateless)."""
    r = B.rides_from_trips(spark, trips, boosts)
    return r.select("trip_id", surge_explanation(price="price_usd").alias("resp")).select("trip_id", "resp.*")


# --------------------------------------------------------------------------- K3

def fraud_scoring(stream: DataFrame, frozen_bound: float) -> DataFrame:
    """K3: pattern flags with the fare/distance bound frozen from training
    data (a per-batch bound would drift with each micro-batch)."""
    return stream.select("trip_id", "is_fraud", "fraud_type",
                         F.array_join(fraud_patterns(frozen_bound), ",").alias("patterns"))


def model_scoring(stream: DataFrame, model, version: str, frozen_bound: float | None = None) -> DataFrame:
    """K3 with stored models: a fitted pipeline (scaler, forest, network,
    classifier, ensemble) and, with a bound, the pattern flags. Nothing is
    fitted or rescaled on a micro-batch, so the stream scores as a batch would."""
    out = model.transform(stream)
    cols = ["trip_id", "is_fraud", "iso_score", "recon_error", "ae_score", "xgb_score", "ensemble_score", "is_flagged"]
    if frozen_bound is not None:
        out = out.withColumn("patterns", F.array_join(fraud_patterns(frozen_bound), ","))
        cols.append("patterns")
    return out.select(*cols, F.lit(version).alias("model_version"))


# --------------------------------------------------------------------------- K4

K4_OUT = T.StructType([
    T.StructField("trip_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("date", T.DateType()), T.StructField("trips_so_far", T.IntegerType()),
    T.StructField("cancellations_so_far", T.IntegerType()), T.StructField("location_jump_km", T.DoubleType()),
    T.StructField("new_device", T.IntegerType()),
])
KM_PER_DEGREE = 111.0
DAY_MS = 86_400_000
HELD = ("ms", "trip_id", "error", "lat", "lon", "device")
HELD_ROWS = 4096


class RiderState(StatefulProcessor):
    """Running features of one rider, the unit of state (they are sequential).

    * ``held``: rows the watermark has not passed yet, up to ``HELD_ROWS`` an element of
      the list (elements are converted one by one); a timer at the earliest row
    * ``rider``, one value: per day the trips, cancellations and last pickup, and the
      devices the rider has been seen with. A day is kept until no row of it can come
      any more; a timer at its end drops it.

    Every use of state is a round trip between Python and the store, so a call
    makes a few of them, whatever the number of its rows, days and devices.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "ms array<long>, trip_id array<long>, error array<int>, lat array<double>, lon array<double>, "
                                                 "device array<int>")
        self.rider = handle.getValueState("rider", "day array<long>, n array<int>, cancels array<int>, lat array<double>, lon array<double>, "
                                                   "device array<int>, since array<long>")

    def handleInputRows(self, key, rows, timerValues):
        frames = [p[list(HELD)] for p in rows if len(p)]
        yield from self._advance(key, pd.concat(frames, ignore_index=True) if frames else None, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._advance(key, None, timerValues.getCurrentWatermarkInMs())

    def _advance(self, key, fresh, watermark: int):
        held = [pd.DataFrame(dict(zip(HELD, x))) for x in self.held.get()] if self.held.exists() else []
        rows = [*held, *([] if fresh is None else [fresh])]
        rows = pd.concat(rows, ignore_index=True) if rows else pd.DataFrame([], columns=list(HELD))
        rows = rows.sort_values(["ms", "trip_id"], kind="stable", ignore_index=True)
        ready = int((rows["ms"] < watermark).sum())
        out = None
        if ready or fresh is None:
            day, n, cancels, lat, lon, device, since = self.rider.get() if self.rider.exists() else [()] * 7
            days, devices = {d: v for d, *v in zip(day, n, cancels, lat, lon)}, dict(zip(device, since))
            if ready:
                out = self._emit(key, rows.iloc[:ready], days, devices)
            kept = {d: v for d, v in days.items() if (d + 1) * DAY_MS >= watermark}
            for d in kept:
                self.handle.registerTimer((d + 1) * DAY_MS + 1)
            if ready or len(kept) < len(day):
                self.rider.update((list(kept), *map(list, zip(*kept.values()) if kept else [()] * 4), list(devices), list(devices.values())))
        wait = rows.iloc[ready:]
        if fresh is not None or ready:
            if len(wait):
                cells = [wait["ms"].astype("int64").tolist(), [None if pd.isna(x) else int(x) for x in wait["trip_id"]],
                         *(wait[c].astype(t).tolist() for c, t in zip(HELD[2:], ("int32", "float64", "float64", "int32")))]
                self.held.put([tuple(c[lo:lo + HELD_ROWS] for c in cells) for lo in range(0, len(wait), HELD_ROWS)])
                self.handle.registerTimer(max(int(wait["ms"].iloc[0]) + 1, watermark + 1))
            elif len(held):
                self.held.clear()
        if out is not None:
            yield out

    def _emit(self, key, out: pd.DataFrame, days: dict[int, list], devices: dict[int, int]) -> pd.DataFrame:
        """The features of ``out``, rows in order; ``days`` and ``devices`` then hold these rows, too."""
        ms, error, lat, lon, device = (out[c].to_numpy() for c in ("ms", "error", "lat", "lon", "device"))
        new = ~out["device"].duplicated().to_numpy() & ~np.isin(device, list(devices))
        seen = dict(zip(device[new].tolist(), ms[new].tolist()))
        if not devices:
            new[0] = False                                               # the rider's first trip of all
        devices |= seen
        day = ms // DAY_MS
        first = np.flatnonzero(np.r_[True, day[1:] != day[:-1]])
        size = np.diff(np.r_[first, len(day)])
        before = [days.get(d, (0, 0, np.nan, np.nan)) for d in day[first].tolist()]
        trips, cancels = (np.array([b[i] for b in before], dtype=np.int64) for i in (0, 1))
        plat, plon = np.r_[np.nan, lat[:-1]], np.r_[np.nan, lon[:-1]]
        plat[first], plon[first] = ([b[i] for b in before] for i in (2, 3))
        jump = np.sqrt((lat - plat) * (lat - plat) + (lon - plon) * (lon - plon)) * KM_PER_DEGREE
        done = np.cumsum(error)
        trips = np.arange(1, len(day) + 1) + np.repeat(trips - first, size)
        cancels = done + np.repeat(cancels - (done[first] - error[first]), size)
        for d, i in zip(day[first].tolist(), (first + size - 1).tolist()):
            days[d] = [int(trips[i]), int(cancels[i]), float(lat[i]), float(lon[i])]
        return pd.DataFrame({
            "trip_id": out["trip_id"].astype("int64"), "customer_id": key[0], "date": out["ms"].floordiv(DAY_MS).map(
                {d: pd.Timestamp(d * DAY_MS, unit="ms").date() for d in day[first].tolist()}),
            "trips_so_far": trips.astype(np.int32), "cancellations_so_far": cancels.astype(np.int32),
            "location_jump_km": np.nan_to_num(np.floor(jump * 100.0 + 0.5) / 100.0), "new_device": new.astype(np.int32)})

    def close(self) -> None:
        pass


def rider_running(trips: DataFrame) -> DataFrame:
    """K4: running trip count, cancellations and location jump per rider-day, and
    whether the rider is on a new device. Run with the ``ROCKSDB`` conf."""
    t = trips.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", WATERMARK)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    t = t.select(F.coalesce("customer_id", F.lit(-1)).alias("customer_id"), "event_time", F.unix_millis("event_time").alias("ms"), "trip_id",
                 F.coalesce((F.col("trip_type") == "error").cast("int"), F.lit(0)).alias("error"), zero(F.col("pickup_lat")).alias("lat"),
                 zero(F.col("pickup_lon")).alias("lon"), F.coalesce(B.device_of(F.col("trip_id")), F.lit(0)).alias("device"))
    return t.groupBy("customer_id").transformWithStateInPandas(RiderState(), K4_OUT, "append", "EventTime")
