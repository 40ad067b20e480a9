"""History windows, split and unsplit, against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetspan.operators import history, lives


@pytest.fixture(scope="module")
def readings(spark):
    """One long engine with gaps, one dense, one single row; cycles 1.. with holes."""
    rng = np.random.default_rng(3)
    cycles = {1: np.sort(rng.choice(np.arange(1, 900), 300, replace=False)), 2: np.arange(1, 41), 3: np.array([7])}
    # A hole wider than several blocks.
    cycles[1] = cycles[1][(cycles[1] < 200) | (cycles[1] > 420)]
    frame = pd.concat(
        pd.DataFrame({"dataset": "FD001", "engine_id": e, "cycle": c, "sensor_2": rng.normal(size=len(c))})
        for e, c in cycles.items()
    )
    return frame, spark.createDataFrame(frame)


def _expected(frame):
    frame = frame.sort_values(["engine_id", "cycle"])
    grouped = frame.groupby("engine_id")["sensor_2"]
    return frame.assign(
        sensor_2_rolling_avg=grouped.transform(lambda x: x.rolling(20, min_periods=1).mean()),
        sensor_2_rolling_std=grouped.transform(lambda x: x.rolling(20, min_periods=2).std().fillna(0)),
        previous=grouped.shift(1),
    )


@pytest.mark.parametrize("block_rows", [10, 50, 1_000_000])
def test_rolling_equals_pandas(readings, block_rows):
    frame, df = readings
    out = history.rolling(df, ["sensor_2"], block_rows=block_rows).toPandas()
    out = out.sort_values(["engine_id", "cycle"])
    want = _expected(frame)
    assert list(out["cycle"]) == list(want["cycle"])
    for column in ("sensor_2_rolling_avg", "sensor_2_rolling_std"):
        np.testing.assert_allclose(out[column], want[column], atol=1e-12)


@pytest.mark.parametrize("block_rows", [1, 7, 1_000_000])
def test_lag_equals_pandas(readings, block_rows):
    frame, df = readings
    out = history.cycle_delta(df, block_rows=block_rows).toPandas().sort_values(["engine_id", "cycle"])
    np.testing.assert_array_equal(out["previous_cycle_sensor_2"], _expected(frame)["previous"])


def test_blocks_bound_the_window_partition(readings):
    _, df = readings
    plan = history.rolling(df, ["sensor_2"], block_rows=10)._jdf.queryExecution().toString()
    assert "_block" in plan
    plan = history.rolling(df, ["sensor_2"], rows_per_key=400)._jdf.queryExecution().toString()
    assert "_block" not in plan


def test_short_keys_are_not_split(readings):
    _, df = readings
    assert history._largest_key_over(df, ["engine_id"], 1000) == 0
    assert history._largest_key_over(df, ["engine_id"], 100) == 101


def test_with_life_join_equals_window(fleet):
    from fleetspan.operators import lives

    rows = fleet.readings.select("dataset", "engine_id", "cycle")
    joined, windowed = lives.with_life(rows), lives.with_life(rows, 362)
    assert joined.exceptAll(windowed.select(*joined.columns)).isEmpty()
    assert joined.count() == windowed.count()


def test_rul_properties(fleet):
    from fleetspan.operators import lives

    out = lives.features(fleet.readings, fleet.rows_per_engine)
    row = out.agg(
        F.min("RUL").alias("least"),
        F.max("RUL_capped").alias("most"),
        F.max("cycle_ratio").alias("ratio"),
        F.count_if(F.col("RUL") + F.col("cycle") != F.col("max_cycle")).alias("off"),
    ).first()
    assert (row["least"], row["most"], row["ratio"], row["off"]) == (0, 125, 1.0, 0)


def test_a_mean_on_the_edge_of_the_band_has_not_left_it(spark):
    """Two readings: the first is half their distance from the mean, and so is the edge at 1 / sqrt(2) deviations."""
    pairs = [(e, 554 - (e % 97) / 1000, 554 - (e % 89) / 100) for e in range(2_000)]
    rows = [(e, "FD001", cycle, v) for e, *pair in pairs for cycle, v in enumerate(pair, 1)]
    frame = spark.createDataFrame(rows, "engine_id long, dataset string, cycle int, sensor_7 double")
    out = lives.baseline_breach(frame, sensors=("sensor_7",), sigmas=2**-0.5, rows_per_engine=2)
    assert out.where("cycle = 1 AND sensor_7_breach").isEmpty()
    nearer = lives.baseline_breach(frame, sensors=("sensor_7",), sigmas=2**-0.5 - 1e-6, rows_per_engine=2)
    assert nearer.where("cycle = 1 AND sensor_7_breach").count() == sum(a != b for _, a, b in pairs)
