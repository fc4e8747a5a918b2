"""Streams: late rows, restarts, and every row out at the end."""

import datetime as dt
import tempfile
import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ridewise.sources import bindings as B
from ridewise.streaming import jobs

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def at(d, h, m, s=0):
    return dt.datetime(2024, 1, d, h, m, s)


def write(spark, path, rows):
    data = [(i, t, u, "error" if i % 10 == 3 else "view", 5.0 + i) for i, t, u in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)                                       # file order is by modification time


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


#: (id, time, rider); 20 and 40 are booked from devices of their own (one trip in twenty)
BATCHES = [[(1, at(1, 23, 50), 7), (2, at(2, 0, 1), 7), (3, at(2, 0, 2), 7), (20, at(2, 0, 2), 8)],
           [(4, at(1, 23, 58), 7), (5, at(2, 0, 5), 7)],                     # 4 is late but within the watermark
           [(6, at(2, 0, 3), 7), (40, at(2, 0, 20), 7), (21, at(2, 0, 21), 8)],
           [(8, at(2, 0, 30), 8)], [(60, at(2, 0, 4), 7)],                   # rows up to 0:11 are out when 60 comes
           [(9, at(5, 0, 0), 7), (90, at(5, 0, 1), 8)]]
KEPT = sorted((t, i, u) for rows in BATCHES for i, t, u in rows if i != 60)


def expected():
    out, day, device = {}, {}, {}
    for t, i, u in KEPT:
        n, c = day.get((u, t.date()), (0, 0))
        day[u, t.date()] = n + 1, c + (i % 10 == 3)
        d = i % 50 + 1 if i * 17 % 20 == 0 else 0
        seen = device.setdefault(u, set())
        out[i] = (u, t.date(), n + 1, c + (i % 10 == 3), int(bool(seen) and d not in seen))
        seen.add(d)
    return out


def test_rider_state_over_late_files_and_a_restart(spark):
    path = tempfile.mkdtemp(prefix="rw-k4-", dir="/tmp") + "/t"
    job = lambda e: jobs.rider_running(B.trips_from_events(e))
    run = jobs.Run(spark, "k4test")
    for k, rows in enumerate(BATCHES):
        write(spark, path, rows)
        if k in (1, 5):                                   # stops after two files, goes on from the checkpoint
            df = job(stream(spark, path))
            run.start(df, conf=jobs.ROCKSDB)
    got = {r.trip_id: (r.customer_id, r.date, r.trips_so_far, r.cancellations_so_far, r.new_device) for r in run.rows(df.schema).collect()}
    want = expected()
    assert {i: v for i, v in want.items() if i not in (9, 90)} == got        # those two are still within the watermark
    assert run.progress_table().agg(F.sum("late_rows"), F.sum("input_rows")).first()[:] == (1, sum(map(len, BATCHES)))


def test_run_to_end_returns_every_row(spark):
    path = tempfile.mkdtemp(prefix="rw-k4-", dir="/tmp") + "/t"
    for rows in BATCHES[:4] + BATCHES[5:]:
        write(spark, path, rows)
    out, run = jobs.run_to_end(stream(spark, path), at(5, 0, 1), lambda e: jobs.rider_running(B.trips_from_events(e)), "k4end",
                               conf=jobs.ROCKSDB)
    got = {r.trip_id: (r.customer_id, r.date, r.trips_so_far, r.cancellations_so_far, r.new_device) for r in out.collect()}
    assert got == expected()
    assert run.progress_table().agg(F.sum("late_rows")).first()[0] == 0


def test_windows_count_drivers_and_report_late_rows(spark):
    path = tempfile.mkdtemp(prefix="rw-k1-", dir="/tmp") + "/t"
    first = [(10 * i, at(1, 8, i), 1) for i in range(50)]                    # all in zone 0
    write(spark, path, first)
    write(spark, path, [(7, at(1, 12, 0), 1)])
    write(spark, path, [(17, at(1, 12, 10), 1)])
    write(spark, path, [(500, at(1, 8, 5), 1), (510, at(1, 8, 6), 1), (520, at(1, 12, 30), 1)])      # two of them too late
    out, run = jobs.run_to_end(stream(spark, path), at(1, 12, 30), lambda e: jobs.zone_window_demand(B.trips_from_events(e)), "k1end")
    got = {(r.window_start, r.requests): r.active_drivers for r in out.collect()}
    drivers = len({10 * i * 29 % 211 for i in range(50)})
    assert got == {(at(1, 8, 0), 50): drivers, (at(1, 12, 0), 2): 2, (at(1, 12, 0), 1): 1}
    assert out.count() == 3
    assert run.progress_table().agg(F.sum("late_rows")).first()[0] == 2


def test_stream_scores_like_the_batch(spark):
    from conftest import SF
    from ridewise.plans.q_models import fixed_pipeline
    from ridewise.session import scratch_path
    path = scratch_path(spark, "trips")
    B.fraud_trips(spark, SF).repartition(5).write.parquet(path)
    model, table = fixed_pipeline(), spark.read.parquet(path)
    cols = ["trip_id", "iso_score", "recon_error", "ae_score", "xgb_score", "ensemble_score", "is_flagged"]
    stream_ = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 2).parquet(path)
    out = jobs.run_available_now(jobs.model_scoring(stream_, model, "v1"), "k3test")
    assert {tuple(r) for r in out.select(*cols).collect()} == {tuple(r) for r in model.transform(table).select(*cols).collect()}
    assert out.select("model_version").distinct().collect() == [("v1",)]


class _Store:
    """A rider's state in memory; counts its uses."""

    def __init__(self):
        self.calls, self.timers, self.state = 0, set(), {}

    def getListState(self, name, schema):
        return _Slot(self, name)

    getValueState = getListState

    def getMapState(self, name, *schemas):
        return _Slot(self, name)

    def registerTimer(self, at_):
        self.calls += 1
        self.timers.add(at_)


class _Slot:
    def __init__(self, store, name):
        self.store, self.name = store, name

    def _use(self):
        self.store.calls += 1
        return self.store.state

    def exists(self):
        return bool(self._use().get(self.name))

    def get(self):
        return self._use()[self.name]

    def put(self, value):
        self._use()[self.name] = value

    update = put

    def clear(self):
        self._use().pop(self.name, None)

    def keys(self):
        return list(self._use().setdefault(self.name, {}))

    def containsKey(self, k):
        return k in self._use().setdefault(self.name, {})

    def getValue(self, k):
        return self._use()[self.name][k]

    def updateValue(self, k, v):
        self._use().setdefault(self.name, {})[k] = v

    def removeKey(self, k):
        self._use()[self.name].pop(k)


class _Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_uses_of_rider_state_do_not_grow_with_days_and_devices(monkeypatch):
    monkeypatch.setattr(jobs, "HELD_ROWS", 7, raising=False)
    day, n = jobs.DAY_MS, 60
    rows = pd.DataFrame({"ms": np.arange(n) * day // 2 + 5, "trip_id": np.arange(n), "error": np.arange(n) % 3 // 2, "lat": np.arange(n) / 100.0,
                         "lon": 0.0, "device": np.arange(n) % 11}).sample(frac=1, random_state=1)
    store, rider = _Store(), jobs.RiderState()
    rider.init(store)
    assert not list(rider.handleInputRows((7,), iter([rows.iloc[:40], rows.iloc[40:]]), _Now(0)))
    out = pd.concat(rider.handleExpiredTimer((7,), _Now(20 * day + day // 4), None))
    rest = pd.concat(rider.handleExpiredTimer((7,), _Now(99 * day), None))
    assert store.calls <= 25
    got = pd.concat([out, rest], ignore_index=True)
    assert len(out) == 41 and got["trip_id"].tolist() == list(range(n))
    assert got["trips_so_far"].tolist() == [1, 2] * (n // 2)
    assert got["cancellations_so_far"].tolist() == [sum(i % 3 == 2 for i in range(k - k % 2, k + 1)) for k in range(n)]
    assert got["new_device"].tolist() == [int(0 < k < 11) for k in range(n)]
    assert got["location_jump_km"].tolist() == [1.11 if k % 2 else 0.0 for k in range(n)]
    assert got["date"].tolist() == [dt.date(1970, 1, 1) + dt.timedelta(days=k // 2) for k in range(n)]
