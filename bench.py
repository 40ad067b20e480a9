"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from fleetspan.plans.binding import lineitem_fleet
from fleetspan.plans.registry import all_queries
from fleetspan.session import build_session

HEADLINE = [
    "fleet_status",
    "fleet_summary",
    "life_category_summary",
    "rank_longevity",
    "cycle_delta",
    "degradation_delta",
    "rul_health",
    "maintenance_alerts",
    "life_variability",
    "sensor_profile",
    "describe_sensors",
    "missing_report",
    "constant_sensors",
    "correlation_matrix",
    "rul_correlation",
    "rul_histogram_equal",
    "life_stage_profile",
    "sensor_trends",
    "rolling_avg",
    "rolling_std",
    "baseline_breach",
    "feature_frame",
    "minmax_scaled",
    "serving_frame",
    "latest_per_engine",
    "rul_kpis",
    "rul_histogram",
    "critical_engines",
    "work_order",
    "engine_cards",
    "kpi_json",
    "load_breakdown",
    "insert_ignore",
    "page_links",
    "number_functions",
    "regression_metrics",
    "residual_histogram",
    "stream_latest",
    "stream_rolling",
    "stream_kpis",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    start = time.perf_counter()
    lineitem_fleet(spark, sf_dir).readings  # laid out once, by the first query that reads it
    seconds = {"lay_out_fleet": round(time.perf_counter() - start, 3)}
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    queries[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
