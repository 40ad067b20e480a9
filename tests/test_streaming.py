"""Streams over several micro-batches give the batch answer."""

import shutil
import time
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from compare import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetspan.functions import health
from fleetspan.operators.serving import latest_per_engine
from fleetspan.plans.binding import as_feed, table
from fleetspan.streaming import feed as feeds
from fleetspan.streaming import engine_state
from fleetspan.streaming import reports as live

BATCHES = 7


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    """The events as one file per batch, in time order."""
    path = tmp_path_factory.mktemp("feed")
    events = pd.read_parquet(f"{sf_dir}/events.parquet").sort_values("ts")
    size = -(-len(events) // BATCHES)
    for i in range(BATCHES):
        part = events.iloc[i * size : (i + 1) * size]
        part.to_parquet(path / f"events-{i:03d}.parquet", index=False, coerce_timestamps="us")
    return str(path)


@pytest.fixture(scope="module")
def batch(spark, sf_dir):
    return as_feed(table(spark, sf_dir, "events"))


def same(a, b):
    columns = sorted(b.columns)
    return rows_of(columns, a.select(*columns).collect()) == rows_of(columns, b.select(*columns).collect())


def stream(spark, folder):
    return feeds.read_feed(spark, folder, files_per_batch=1)


def test_latest(spark, folder, batch, tmp_path):
    out = live.stream_latest(spark, stream(spark, folder), str(tmp_path))
    want = latest_per_engine(batch, ["engine_id"], "ts").withColumn(
        "health_status", health.health_status(F.col("rul"), "HEALTHY")
    )
    assert same(out, want)
    assert len(list((tmp_path / "table").glob("batch=[0-9]*"))) == BATCHES


def same_rolling(out, batch):
    frame = Window.partitionBy("engine_id").orderBy("ts").rowsBetween(-19, 0)
    want = batch.withColumn("rolling_avg", F.avg("rul").over(frame))
    rounded = F.round("rolling_avg", 9).alias("rolling_avg")
    keep = ["engine_id", "ts", "rul", rounded]
    return same(out.select(*keep), want.select(*keep))


def test_rolling(spark, folder, batch, tmp_path):
    out = live.stream_rolling(spark, stream(spark, folder), str(tmp_path))
    assert same_rolling(out, batch) and live.late_rows(spark, str(tmp_path)).isEmpty()
    assert len(list((tmp_path / "table").glob("batch=[0-9]*"))) >= BATCHES


def test_a_restarted_stream_goes_on(spark, folder, batch, tmp_path):
    """The list of an engine's last readings comes back from the checkpoint."""
    arriving, out = tmp_path / "in", str(tmp_path / "out")
    arriving.mkdir()
    files = sorted(Path(folder).glob("*.parquet"))
    for part in (files[:3], files[3:]):
        for file in part:
            shutil.copy(file, arriving)
            time.sleep(0.02)
        found = live.stream_rolling(spark, stream(spark, str(arriving)), out)
    assert same_rolling(found, batch)


def at(day, hour=0):
    return pd.Timestamp(2024, 1, day, hour)


def written(folder, *batches):
    """A file for each batch of (engine, time, value)."""
    folder.mkdir()
    for i, rows in enumerate(batches):
        frame = pd.DataFrame(rows, columns=["user_id", "ts", "value"])
        frame = frame.assign(event_id=range(len(rows)), event_type="x", props=None).astype({"props": "string", "value": float})
        frame.to_parquet(folder / f"{i}.parquet", index=False, coerce_timestamps="us")
        time.sleep(0.02)
    return str(folder)


def test_late_rows_are_set_aside(spark, tmp_path):
    first = [(1, at(5), 10.0), (1, at(6), 20.0), (2, at(6), 90.0)]
    second = [(1, at(5, 12), 99.0), (2, at(6, 1), 20.0), (3, at(1), 5.0)]
    third = [(1, at(6, 2), 60.0), (2, at(5, 23), 7.0), (4, at(6, 1), 1.0)]
    feed = written(tmp_path / "in", first, second, third)
    rows = lambda df: sorted(map(tuple, df.collect()))
    rolling = live.stream_rolling(spark, stream(spark, feed), str(tmp_path / "rolling"), rows=2)
    assert rows(rolling.select("engine_id", "rul", "rolling_avg")) == [(1, 10, 10), (1, 20, 15), (1, 60, 40), (2, 20, 55), (2, 90, 90), (3, 5, 5), (4, 1, 1)]
    assert rows(live.late_rows(spark, str(tmp_path / "rolling")).select("engine_id", "rul")) == [(1, 99), (2, 7)]
    alerts = live.stream_alerts(spark, stream(spark, feed), str(tmp_path / "alerts"))
    assert rows(alerts.select("engine_id", "rul", "previous_status")) == [(1, 10, None), (2, 20, "HEALTHY"), (3, 5, None), (4, 1, None)]
    kpis = live.stream_kpis(spark, stream(spark, feed), str(tmp_path / "kpis"))
    assert kpis.agg(F.sum("readings")).first()[0] == 6
    late = live.late_rows(spark, str(tmp_path / "kpis"))
    assert rows(late.select("engine_id", "rul")) == [(1, 99), (2, 7), (3, 5)]


def test_a_silent_engine_is_forgotten(spark, tmp_path):
    feed = written(tmp_path / "in", [(1, at(1), 1.0)], [(2, at(10), 1.0)], [(2, at(11), 1.0)], [(1, at(12), 2.0), (2, at(12), 3.0)])
    kept = engine_state.with_last_readings(stream(spark, feed), 2, idle_ms=5 * 24 * 3600 * 1000)
    out = str(tmp_path / "out")
    feeds.run_available(kept, lambda df, batch: feeds.write_batch(df, out, batch), str(tmp_path / "checkpoint"))
    last = spark.read.parquet(out).where("ts >= '2024-01-12'").select("engine_id", "has_previous").collect()
    assert sorted(map(tuple, last)) == [(1, False), (2, True)]


def test_sketches_of_intervals_merge(spark):
    feed = spark.range(60_000).selectExpr("id % 20000 AS engine_id", "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "double(id) AS rul")
    merged = live.merged_kpis(live.kpi_parts(feed), "1 day").first()
    assert merged["readings"] == 60_000 and abs(merged["engines"] - 20_000) < 0.05 * 20_000
    one = live.kpi_windows(feed.where("engine_id < 40")).agg(F.max("engines")).first()[0]
    assert one == 40


def test_engines_of_an_interval_are_counted_exactly(spark):
    feed = spark.range(90_000).selectExpr("id % 30000 AS engine_id", "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id / 10) AS ts", "double(id) AS rul")
    half = feed.where("rul < 45000")
    parts = live.kpi_parts(half).union(live.kpi_parts(feed.where("rul >= 45000")))
    day = live.merged_kpis(parts, "1 day").first()
    assert (day["readings"], day["engines"], day["min_rul"]) == (90_000, 30_000, 0.0)
    assert {r["engines"] for r in live.kpi_windows(feed).collect()} == {3000}


def test_alerts(spark, folder, batch, tmp_path):
    out = live.stream_alerts(spark, stream(spark, folder), str(tmp_path))
    w = Window.partitionBy("engine_id").orderBy("ts")
    want = (
        batch.withColumn("health_status", health.health_status(F.col("rul"), "HEALTHY"))
        .withColumn("previous_status", F.lag("health_status").over(w))
        .where("health_status = 'DANGER' AND coalesce(previous_status, '') <> 'DANGER'")
    )
    assert same(out, want)


def test_kpis(spark, folder, batch, tmp_path):
    out = live.stream_kpis(spark, stream(spark, folder), str(tmp_path))
    rounded = F.round("avg_rul", 9).alias("avg_rul")
    keep = ["window_start", "readings", "danger", rounded, "min_rul", "engines"]
    assert same(out.select(*keep), live.kpi_windows(batch).select(*keep))


def test_repeated_batch_overwrites_itself(spark, tmp_path):
    for _ in range(2):
        feeds.write_batch(spark.range(3), str(tmp_path), 0)
    assert spark.read.parquet(str(tmp_path)).count() == 3


def test_a_table_of_several_files_and_an_empty_one(spark, sf_dir, batch, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    feed = lambda name: feeds.read_feed(spark, str(tmp_path / name))
    out = live.stream_kpis(spark, feed("events.parquet"), str(tmp_path / "k"))
    assert out.agg(F.sum("readings")).first()[0] == batch.count()
    assert live.stream_rolling(spark, feed("events.parquet"), str(tmp_path / "r")).count() == batch.count()
    events.where("false").write.parquet(str(tmp_path / "none.parquet"))
    for n, build in enumerate((live.stream_latest, live.stream_alerts, live.stream_rolling, live.stream_kpis)):
        assert build(spark, feed("none.parquet"), str(tmp_path / f"e{n}")).count() == 0


class Store:
    """A state store of one key."""

    def __init__(self):
        self.value, self.timers = None, set()
        self.get, self.listTimers = lambda: self.value, lambda: iter(set(self.timers))
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def getValueState(self, name, schema):
        return self

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def getCurrentWatermarkInMs(self):
        return 0


def test_one_call_works_on_many_engines():
    """A place's engines are told apart: windows, late rows and kept readings are each engine's own."""
    rng, rows, store, seen = np.random.default_rng(3), 5, Store(), []
    state = engine_state.LastReadings(rows, 1000)
    state.init(store)
    for number in range(4):
        made = pd.DataFrame({"place": 0, "engine_id": rng.integers(0, 30, 200), "at": rng.permutation(200) * 10_000 + number * 1_500_000})
        made["rul"] = np.where(rng.random(200) < 0.1, np.nan, rng.random(200))
        found = pd.concat(state.handleInputRows((0,), iter([made[:70], made[70:]]), store))
        assert len(found) == 200
        last = pd.concat([f[~f["late"]] for f in [*seen, found.iloc[:0]]]).groupby("engine_id")["at"].max()
        assert (found["late"] == (found["at"] < found["engine_id"].map(last))).all()
        seen.append(found)
    assert sum(f["late"].sum() for f in seen) > 20
    done = pd.concat(f[~f["late"]] for f in seen).reset_index(drop=True)
    for _, own in done.groupby("engine_id"):
        assert own["at"].is_monotonic_increasing
        mean = own["rul"].rolling(rows, min_periods=1).mean()
        np.testing.assert_allclose(own["rolling_avg"], mean)
        np.testing.assert_array_equal(own["previous_rul"], own["rul"].shift())
        assert own["has_previous"].tolist() == [False, *[True] * (len(own) - 1)]
    kept = pd.DataFrame(dict(zip(["engine_id", "at", "rul"], store.value, strict=True)))
    tails = done.sort_values(["engine_id", "at"]).groupby("engine_id").tail(rows - 1)[["engine_id", "at", "rul"]]
    pd.testing.assert_frame_equal(kept, tails.reset_index(drop=True), check_dtype=False)
    assert store.timers == {int(done.groupby("engine_id")["at"].max().min()) // 1000 + 1000}


def test_rows_without_an_engine_are_kept(spark, tmp_path):
    feed = spark.createDataFrame([(None, at(1).to_pydatetime(), 1.0), (None, at(2).to_pydatetime(), 3.0), (0, at(1).to_pydatetime(), 9.0)], "user_id long, ts timestamp, value double")
    whole = feed.selectExpr("0L AS event_id", "ts::timestamp_ntz AS ts", "user_id", "'x' AS event_type", "value", "'' AS props")
    whole.write.parquet(str(tmp_path / "events.parquet"))
    out = live.stream_rolling(spark, feeds.read_feed(spark, str(tmp_path / "events.parquet")), str(tmp_path / "out"))
    assert sorted(map(tuple, out.select("engine_id", "rul", "rolling_avg").collect()), key=str) == [(0, 9, 9), (None, 1, 1), (None, 3, 2)]
