"""Known results of the first truncated fleet, from its true remaining lives."""

import pytest

from fleetspan.operators import lives, serving
from fleetspan.sources import text

# True remaining life of engines 1 to 100 of FD001
TRUE_RUL = [
    112, 98, 69, 82, 91, 93, 91, 95, 111, 96, 97, 124, 95, 107, 83, 84, 50, 28, 87, 16,
    57, 111, 113, 20, 145, 119, 66, 97, 90, 115, 8, 48, 106, 7, 11, 19, 21, 50, 142, 28,
    18, 10, 59, 109, 114, 47, 135, 92, 21, 79, 114, 29, 26, 97, 137, 15, 103, 37, 114, 100,
    21, 54, 72, 28, 128, 14, 77, 8, 121, 94, 118, 50, 131, 126, 113, 10, 34, 107, 63, 90,
    8, 9, 137, 58, 118, 89, 116, 115, 136, 28, 38, 20, 85, 55, 128, 137, 82, 59, 117, 20,
]


@pytest.fixture(scope="module")
def labels(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("golden") / "RUL_FD001.txt"
    path.write_text("".join(f"{value} \n" for value in TRUE_RUL))
    return text.read_labels(spark, str(path))


def test_labels(labels):
    rows = [r["true_rul"] for r in labels.orderBy("engine_id").collect()]
    assert rows == TRUE_RUL
    assert (len(rows), min(rows), max(rows), sum(rows)) == (100, 7, 145, 7552)


def test_status_counts(labels):
    latest = labels.withColumnRenamed("true_rul", "rul_capped")
    counts = {r["health_status"]: r["engines"] for r in serving.fleet_status(latest).collect()}
    assert counts == {"DANGER": 25, "WARNING": 20, "HEALTHY": 55}
    assert serving.fleet_banner(latest).first()["banner"] == "critical"


def test_histogram(labels):
    rows = serving.rul_histogram(labels, value="true_rul").orderBy("bin").collect()
    assert [r["engines"] for r in rows] == [9, 16, 3, 11, 6, 21, 21, 13]


def test_most_critical(labels):
    latest = labels.withColumnRenamed("true_rul", "rul_capped")
    rows = [(r["engine_id"], r["rul_capped"]) for r in serving.critical_engines(latest).collect()]
    assert rows == [(34, 7), (31, 8), (68, 8), (81, 8), (82, 9), (42, 10), (76, 10)]


def test_mean_with_cap(spark, labels):
    last = labels.selectExpr("dataset", "engine_id", "engine_id + 30 AS cycle")
    capped = lives.rul_from_labels(last, labels)
    assert serving.rul_kpis(capped.select("dataset", "engine_id", "rul_capped")).first()["avg_rul"] == 74.5
    assert capped.agg({"rul_capped": "avg"}).first()[0] == pytest.approx(74.45)
