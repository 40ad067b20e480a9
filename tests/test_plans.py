"""The physical plans the design relies on."""

import re

from fleetspan.operators import history, lives, serving
from fleetspan.plans import binding
from fleetspan.plans.registry import all_queries
from fleetspan.plans.shared import staged


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return plan(df).count("Exchange hashpartitioning")


def test_every_line_item_is_a_reading(spark, sf_dir, fleet):
    assert "WindowGroupLimit" not in plan(fleet.readings)
    assert fleet.readings.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert fleet.rows_per_engine == max(r["count"] for r in fleet.readings.groupBy("engine_id").count().collect())


def test_the_fleet_is_laid_out_once(spark, sf_dir):
    """Queries by engine scan the laid-out readings and exchange nothing by engine."""
    for name in ("feature_frame", "rolling_avg", "rolling_std", "cycle_delta", "rul_capped"):
        text = plan(all_queries()[name](spark, sf_dir))
        assert text.count("FileScan") == 1 and "Exchange" not in text, name
    for name in ("fleet_status", "work_order", "serving_frame", "latest_per_engine", "engine_history"):
        text = plan(all_queries()[name](spark, sf_dir))
        assert text.count("FileScan") == 2 and text.count("Window [row_number()") <= 1, name
        assert "Bucketed: true" in text and not re.search(r"hashpartitioning\(dataset#\d+, engine_id#\d+L?, \d+\)[^\n]*\n[^\n]*Window", text)
    assert "SelectedBucketsCount: 1 out of" in plan(all_queries()["engine_history"](spark, sf_dir))


def test_the_alert_function_reads_its_view_once(spark, sf_dir):
    assert plan(all_queries()["maintenance_alerts_sql"](spark, sf_dir)).count("FileScan") == 2


def test_feature_frame_is_one_exchange_in_the_jvm(fleet):
    df = lives.features(staged(fleet.readings), 1000)
    assert exchanges(df) == 1
    assert "Python" not in plan(df) and "Arrow" not in plan(df)


def test_rolling_reads_only_its_columns(fleet):
    df = history.rolling(
        fleet.readings.select("dataset", "engine_id", "cycle", "sensor_7"),
        sensors=["sensor_7"],
        rows_per_key=fleet.rows_per_engine,
    )
    assert "l_quantity" not in plan(df)


def test_latest_row_is_limited_before_the_exchange(fleet):
    text = plan(serving.latest_per_engine(staged(fleet.readings)))
    assert "WindowGroupLimit" in text[text.index("Exchange hashpartitioning") :]


def test_one_engine_reaches_the_scan(fleet):
    text = plan(serving.engine_history(staged(fleet.readings), 3, "FD004"))
    assert "EqualTo(engine_id,3)" in text and "EqualTo(dataset,FD004)" in text


def test_engine_reports_scan_one_column(spark, sf_dir):
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan(all_queries()["fleet_summary"](spark, sf_dir))


def test_no_query_uses_a_cartesian_product(spark, sf_dir):
    for name in ("minmax_scaled", "residual_histogram", "rul_histogram_equal", "rank_longevity"):
        text = plan(all_queries()[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_readings_are_placed_once_in_buckets_of_bounded_size(spark, sf_dir, tmp_path, monkeypatch):
    """One exchange of narrow items lays the readings out, and buckets grow with the rows."""
    text = plan(binding._readings(binding.table(spark, sf_dir, "lineitem"), 30))
    assert text.count("Exchange") == 1 and "sensor" not in text[text.index("Exchange") :]
    monkeypatch.setattr(binding, "BUCKET_ROWS", 200)
    (tmp_path / "lineitem.parquet").symlink_to(f"{sf_dir}/lineitem.parquet")
    readings = binding.lineitem_fleet(spark, str(tmp_path)).readings
    assert f"out of {-(-readings.count() // 200)}" in plan(readings.where("engine_id = 3").groupBy("engine_id").count())
    assert readings.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def test_the_text_round_trip_lays_nothing_out(spark, sf_dir, tmp_path, monkeypatch):
    """Its readings are scanned once, so they are made as they are written."""
    monkeypatch.setattr(binding, "write_by_engine", None)
    (tmp_path / "lineitem.parquet").symlink_to(f"{sf_dir}/lineitem.parquet")
    back = all_queries()["text_round_trip"](spark, str(tmp_path))
    assert back.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
