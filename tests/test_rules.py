"""Status rules, latest rows, histograms and report details."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetspan import constants as C
from fleetspan.functions import health, scalars
from fleetspan.operators import analysis, profiling, serving, sets
from fleetspan.sinks import reports

LATEST = "dataset string, engine_id bigint, cycle int, rul_capped int, is_anomaly boolean"


@pytest.fixture(scope="module")
def latest(spark):
    rows = [
        ("FD001", 1, 31, 0, True),
        ("FD001", 2, 40, 29, False),
        ("FD001", 3, 50, 30, False),
        ("FD001", 4, 60, 79, None),
        ("FD001", 5, 70, 80, False),
        ("FD001", 6, 80, None, False),
        ("FD001", 7, 80, 125, True),
    ]
    return spark.createDataFrame(rows, LATEST)


def one(df):
    return df.first()[0]


@pytest.mark.parametrize(
    "rul,want", [(-1, "DANGER"), (29, "DANGER"), (30, "WARNING"), (79, "WARNING"), (80, "NORMAL"), (None, "NORMAL")]
)
def test_status(spark, rul, want):
    assert one(spark.range(1).select(health.health_status(F.lit(rul).cast("int")))) == want


def test_null_policies(spark):
    row = spark.range(1).select(
        health.health_status(F.lit(None).cast("int"), "HEALTHY", null_label="UNKNOWN"),
        health.clip_above(F.lit(None).cast("int")),
        health.clip_above(F.lit(200)),
        health.life_category(F.lit(None).cast("int")),
        health.life_category(F.lit(250)),
        health.action_for(F.lit("OTHER")),
        health.cycle_ratio(F.lit(1), F.lit(0)),
    ).first()
    assert list(row) == ["UNKNOWN", None, 125, C.LIFE_LABELS[2], C.LIFE_LABELS[2], None, None]


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.half_up(F.lit(2.5)),
        scalars.half_even(F.lit(2.5)),
        scalars.truncated(F.lit(-2.7)),
        scalars.to_number(F.lit(" 4.5 ")),
        scalars.to_number(F.lit("abc")),
        scalars.to_flag(F.lit(None).cast("string")),
        scalars.to_flag(F.lit("true")),
        scalars.contains_any(F.lit("A Jet Page"), ["jet"]),
        F.size(scalars.words(F.lit("  a  b\tc "))),
        scalars.lookup(F.create_map(F.lit("a"), F.lit("1")), F.lit("z"), "none"),
        scalars.thousands(F.lit(1234567)),
    ).first()
    assert list(row) == [3.0, 2.0, -2, 4.5, None, False, True, True, 3, "none", "1,234,567"]
    assert len(reports.stamped_name(spark)) == len("maintenance_report_20240101_0000")


def test_critical_list_puts_zero_first_and_unknown_last(latest):
    rows = serving.critical_engines(latest, 7).collect()
    assert [r["engine_id"] for r in rows] == [1, 2, 3, 4, 5, 7, 6]


def test_counts_ignore_unknown_life(latest):
    row = serving.rul_kpis(latest).first()
    assert (row["total"], row["danger"], row["warning"], row["healthy"], row["min_rul"]) == (7, 2, 2, 2, 0)
    statuses = {r["health_status"]: r["engines"] for r in serving.fleet_status(latest).collect()}
    assert statuses == {"DANGER": 2, "WARNING": 2, "HEALTHY": 3}


def test_histogram_is_half_open_and_filled(latest):
    bins = [r["engines"] for r in serving.rul_histogram(latest).orderBy("bin").collect()]
    assert bins == [1, 1, 1, 0, 1, 1, 0, 1]


def test_latest_keeps_whole_rows_and_can_skip_nulls(spark):
    rows = [("FD001", 1, 1, 5.0, 1.0), ("FD001", 1, 2, None, 2.0), ("FD001", 2, 9, 1.0, None)]
    df = spark.createDataFrame(rows, "dataset string, engine_id int, cycle int, a double, b double")
    whole = {r["engine_id"]: (r["cycle"], r["a"], r["b"]) for r in serving.latest_per_engine(df).collect()}
    assert whole == {1: (2, None, 2.0), 2: (9, 1.0, None)}
    filled = {r["engine_id"]: (r["cycle"], r["a"], r["b"]) for r in serving.latest_non_null(df).collect()}
    assert filled == {1: (2, 5.0, 2.0), 2: (9, 1.0, None)}


def test_banner(spark):
    cases = spark.createDataFrame([(1, 0), (0, 2), (0, 0)], "d int, w int")
    got = [r[0] for r in cases.select(health.fleet_banner(F.col("d"), F.col("w"))).collect()]
    assert got == ["critical", "warning", "ok"]


def test_equal_width_histograms_match_numpy(spark):
    values = np.random.default_rng(2).integers(0, 300, 500)
    df = spark.createDataFrame(pd.DataFrame({"dataset": "FD001", "v": values, "x": values / 7.0}))
    want, edges = np.histogram(values, bins=20)
    rows = profiling.integer_histogram(df, "v", 20).orderBy("bin").collect()
    assert [r["n"] for r in rows] == list(want)
    np.testing.assert_allclose([r["bin_from"] for r in rows], edges[:-1], atol=1e-4)
    got = {r["bin"]: r["n"] for r in profiling.numeric_histogram(df, "x", 20).collect()}
    assert sum(got.values()) == 500
    flat = spark.createDataFrame(pd.DataFrame({"dataset": ["FD001"] * 3, "v": [4, 4, 4]}))
    assert [r["n"] for r in profiling.integer_histogram(flat, "v", 4).orderBy("bin").collect()] == [0, 0, 3, 0]


def test_correlations_match_pandas_with_gaps(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"a": rng.normal(9000, 1, 400)})
    frame["b"] = frame["a"] * 2 + rng.normal(size=400)
    frame["c"] = rng.normal(size=400)
    frame["flat"] = 2388.0
    frame.loc[::7, "b"] = np.nan
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "a double, b double, c double, flat double")
    rows = profiling.correlation_matrix(df.repartition(5), ["a", "b", "c", "flat"], digits=8).collect()
    want = frame[["a", "b", "c"]].corr()
    assert len(rows) == 9
    for r in rows:
        assert r["r"] == pytest.approx(want.loc[r["sensor_a"], r["sensor_b"]], abs=1e-7)


def test_alert_gate_and_document(spark, latest, tmp_path):
    gate = reports.gate(latest).first()
    assert (gate["danger"], gate["warning"], gate["anomalies"], gate["report_due"]) == (2, 2, 2, True)
    quiet = latest.where("engine_id = 5")
    assert reports.emit_alerts(quiet, str(tmp_path / "quiet")) is False
    assert not (tmp_path / "quiet").exists()
    assert reports.emit_alerts(latest, str(tmp_path / "alerts")) is True
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == 3
    document = json.loads(one(reports.kpi_document(latest)))
    assert document["rul_hist"] == [1, 1, 1, 0, 1, 1, 0, 1]
    assert document["critical"][0]["engine_id"] == 1 and "updated" in document


def test_point_lookup_and_chosen_engines(fleet):
    rows = serving.engine_history(fleet.readings, 3, "FD004").select("cycle").collect()
    assert [r["cycle"] for r in rows] == list(range(1, len(rows) + 1)) and rows
    trends = profiling.sensor_trends(fleet.readings, engines=[1, 2])
    assert {r[0] for r in trends.select("engine_id").distinct().collect()} == {1, 2}


def test_alerts_by_dataset(fleet):
    alerts = analysis.maintenance_alerts(fleet.readings, fleet.engines, 30, "FD002")
    assert {r["dataset"] for r in alerts.collect()} == {"FD002"}
    assert "report_generated_at" in alerts.columns


def test_guards(spark, latest):
    with pytest.raises(ValueError, match="no data"):
        sets.require_rows(latest.where("engine_id > 99"), "no data")
    assert sets.keep_present(latest, ["cycle", "absent"]) == ["cycle"]
    assert sets.rename(latest, {"rul_capped": "RUL_capped"}).columns[3] == "RUL_capped"
    headers = serving.work_order_report(latest).columns
    assert "Estimated RUL" in headers and "Action" in headers


def test_latest_and_insert_do_not_depend_on_row_order(spark):
    from fleetspan.sinks import tables

    rows = [("FD001", 1, 5, float(i % 7), float(i)) for i in range(40)]
    frames = [spark.createDataFrame(rows[k:] + rows[:k], "dataset string, engine_id long, cycle int, a double, b double").repartition(k + 1) for k in range(4)]
    assert {tuple(serving.latest_per_engine(df).first()) for df in frames} == {("FD001", 1, 5, 6.0, 34.0)}
    empty = frames[0].where("false")
    assert {tuple(tables.insert_ignore(empty, df, ["dataset", "engine_id"]).first()) for df in frames} == {("FD001", 1, 5, 0.0, 0.0)}
