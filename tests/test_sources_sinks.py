"""Text and table readers, loading, refresh and exports."""

import re

import pytest
from pyspark.sql import functions as F

from fleetspan import constants as C
from fleetspan.models import forest
from fleetspan.plans import shared, sql_surface
from fleetspan.sinks import reports, tables
from fleetspan.sources import files, pages, tables as stored, text


@pytest.fixture
def folder(tmp_path):
    line = " ".join(str(v) for v in [1, 1, *[0.5] * 24])
    (tmp_path / "train_FD001.txt").write_text(f"{line}  \n{line.replace('1 1', '1 2', 1)}\n\n")
    (tmp_path / "train_FD003.txt").write_text("  7   9 " + "1.5 " * 23 + "oops \n")
    (tmp_path / "RUL_FD001.txt").write_text("".join(f"{(i * 37) % 145} \n" for i in range(5000)))
    return tmp_path


def test_reads_every_dataset_found(spark, folder):
    df = text.read_fleet(spark, str(folder))
    rows = {(r["dataset"], r["engine_id"], r["cycle"]): r for r in df.collect()}
    assert set(rows) == {("FD001", 1, 1), ("FD001", 1, 2), ("FD003", 7, 9)}
    assert rows["FD001", 1, 2]["sensor_21"] == 0.5
    assert rows["FD003", 7, 9]["sensor_20"] == 1.5 and rows["FD003", 7, 9]["sensor_21"] is None
    assert df.columns == C.READING_SCHEMA.names
    assert df.schema["sensor_2"].metadata["unit"] == "°R"


def test_lines_of_single_blanks_need_no_regular_expression(spark, tmp_path):
    """Only lines with other whitespace are split by one; both give the same fields."""
    fields = ["3", "7", *[str(0.1 + 0.2 * i) for i in range(24)]]
    lines = [" ".join(fields), " ".join(fields) + "  ", "  " + "  ".join(fields), "\t".join(fields) + " \t", " \t ".join(fields), "3 7 x \x0b"]
    (tmp_path / "train_FD002.txt").write_bytes("\n".join([*lines, "   ", ""]).encode())
    df = text.read_readings(spark, str(tmp_path / "train_FD002.txt"))
    whole = ("FD002", 3, 7, *[float(x) for x in fields[2:]])
    assert sorted(map(tuple, df.collect()), key=str) == sorted([*[whole] * 5, ("FD002", 3, 7, *[None] * 24)], key=str)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and "contains" in plan.lower()


def test_label_lines_are_numbered_across_splits(spark, folder):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = text.read_fleet(spark, str(folder), "RUL")
        assert text._lines(spark, str(folder / "RUL_FD001.txt")).rdd.getNumPartitions() > 1
        got = {r["engine_id"]: r["true_rul"] for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i + 1: (i * 37) % 145 for i in range(5000)}


def test_missing_features_are_reported(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="build the feature frame"):
        stored.read_features(spark, str(tmp_path / "none"))
    assert forest.load_model(str(tmp_path / "none")) is None


def test_serving_read_projects_at_the_scan(spark, fleet, tmp_path):
    path = str(tmp_path / "serving")
    fleet.readings.write.parquet(path)
    df = stored.read_serving(spark, path, ["engine_id", "cycle"]).where("engine_id = 3")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<engine_id:bigint,cycle:int>" in plan
    assert "EqualTo(engine_id,3)" in plan


def test_tables_load_once(spark, fleet, tmp_path):
    tables.create_tables(spark, "fleet_test", str(tmp_path / "db"))
    tables.create_tables(spark, "fleet_test", str(tmp_path / "db"))
    for _ in range(2):
        tables.load_fleet(spark, fleet.readings, fleet.engines, fleet.labels, "fleet_test")
    counts = [spark.table(f"fleet_test.{t}").count() for t in ("engines", "sensor_readings", "rul_labels")]
    assert counts == [26, 6000, 26]
    tables.append(fleet.engines, "fleet_test.engines")
    assert spark.table("fleet_test.engines").count() == 52
    plan = spark.table("fleet_test.sensor_readings").where("dataset = 'FD001'")
    assert "PartitionFilters: [isnotnull(dataset" in plan._jdf.queryExecution().executedPlan().toString()


def test_existing_keys_win(spark):
    schema = "dataset string, engine_id int, max_cycle int"
    target = spark.createDataFrame([("FD001", 1, 100)], schema)
    source = spark.createDataFrame([("FD001", 1, 5), ("FD001", 2, 7), ("FD001", 2, 7)], schema)
    out = {(r["engine_id"], r["max_cycle"]) for r in tables.insert_ignore(target, source, C.KEYS).collect()}
    assert out == {(1, 100), (2, 7)}


def test_refresh_switches_versions(spark, tmp_path):
    for version in (1, 2):
        frame = spark.range(version * 3).withColumn("v", F.lit(version))
        tables.refresh(frame, "refreshed", str(tmp_path / f"v{version}"))
        rows = spark.table("refreshed").collect()
        assert len(rows) == version * 3 and {r["v"] for r in rows} == {version}


def test_written_readings_and_observation(spark, fleet, tmp_path):
    seen = tables.write_observed(fleet.readings, str(tmp_path / "observed"))
    assert seen["rows"] == 6000
    tables.write_readings(fleet.readings, str(tmp_path / "sorted"))
    assert spark.read.parquet(str(tmp_path / "sorted")).count() == 6000


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    reports.export_csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", True).schema("x int, y string").csv(str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, None)]


def test_inventory_and_catalogue(spark, folder):
    rows = {r["file_name"]: r["is_found"] for r in files.file_inventory(spark, str(folder)).collect()}
    assert len(rows) == 12 and rows["train_FD001.txt"] and not rows["test_FD002.txt"]
    catalog = stored.column_catalog(spark).orderBy("position").collect()
    assert [r["column_name"] for r in catalog] == C.RAW_COLUMNS


def test_links(spark):
    html = (
        '<p><a class="x" href="/one">First <b>Jet</b> set</a> <a name="n">no target</a>'
        '<A HREF="/jet/data.zip">Download\nhere</A><a href="/three">other</a></p>'
    )
    df = spark.createDataFrame([(1, "u", html)], "page_id int, url string, html string")
    found = [(r["href"], r["link_text"]) for r in pages.page_links(df).collect()]
    assert found == [("/one", "First Jet set"), ("/jet/data.zip", "Download\nhere"), ("/three", "other")]
    hits = [r["href"] for r in pages.relevant_links(df, ["jet"], ["data"]).collect()]
    assert hits == ["/one", "/jet/data.zip"]
    assert tuple(pages.link_counts(df, ["jet"], ["data"]).first()) == (3, 2)


def test_links_in_every_form(spark):
    html = (
        "<!-- <a href='/hidden'>no</a> --><a href='/one?a=1&amp;b=2' title=\"x > y\">R&amp;D &lt;new&gt;</a><a class=k href=/two>bare</a>"
        "<script>var s = \"<a href='/script'>no</a>\";</script><a data-href=\"/no\">no target</a>"
        "<a title='href=/trap' href = \"/three\">it's <img alt='a > b' src=x> here</a><abbr href='/abbr'>no</abbr><a href=''>empty</a>"
    )
    df = spark.createDataFrame([(1, "u", html), (2, "u", None), (3, "u", "<a href='/open'>never closed")], "page_id int, url string, html string")
    found = [(r["href"], r["link_text"]) for r in pages.page_links(df).collect()]
    assert found == [("/one?a=1&b=2", "R&D <new>"), ("/two", "bare"), ("/three", "it's  here"), ("", "empty")]


LATEST = "dataset string, engine_id int, cycle int, rul_capped int, is_anomaly boolean"


def test_a_report_of_a_day_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "alerts")
    first = spark.createDataFrame([("FD001", 1, 9, 10, False), ("FD002", 2, 9, 20, False), ("FD002", 3, 9, 100, False)], LATEST)
    second = spark.createDataFrame([("FD001", 1, 9, 10, False), ("FD001", 4, 9, 90, True)], LATEST)
    assert reports.emit_alerts(first, path, "2024-01-01") and reports.emit_alerts(first, path, "2024-01-02")
    assert reports.emit_alerts(second, path, "2024-01-02") and not reports.emit_alerts(first.where("false"), path, "2024-01-03")
    rows = sorted((str(r["report_day"]), r["engine_id"]) for r in spark.read.parquet(path).collect())
    assert rows == [("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 1), ("2024-01-02", 4)]


def test_mail_lists_the_most_urgent_and_counts_the_rest(spark):
    rows = [("FD001", i, 9, i, False) for i in range(1, 29)] + [("FD002", 50, 9, 40, False), ("FD002", 51, 9, None, True)]
    mail = reports.alert_mail(spark.createDataFrame(rows, LATEST), listed=3).first()
    assert "28 engines" in mail["subject"] and "25 further engines" in mail["body"] and "1 of 1 engines" in mail["body"]
    listed = re.findall(r"Engine (\d+)</td><td>(\d+) cycles", mail["body"])
    assert listed == [("1", "1"), ("2", "2"), ("3", "3"), ("50", "40")]
    calm = spark.createDataFrame([("FD001", 1, 9, 100, False)], LATEST)
    assert reports.alert_mail(calm).isEmpty()
    flagged = reports.alert_mail(spark.createDataFrame([("FD001", 1, 9, 100, True)], LATEST)).first()
    assert flagged["body"].count(reports.NO_ROWS) == 2


def test_page_has_no_marker_left(spark):
    page = reports.kpi_page(spark.createDataFrame([("FD001", 1, 9, 10, False)], LATEST)).first()["page"]
    assert "{{" not in page and "const histogram = [1,0,0,0,0,0,0,0]" in page


def test_a_second_load_reads_only_the_partitions_it_touches(spark, fleet, tmp_path):
    tables.create_tables(spark, "fleet_touched", str(tmp_path / "db"))
    whole = tables.load_report(spark, fleet.readings, fleet.engines, "fleet_touched").collect()
    assert whole[-1]["engines_loaded"] == 26 and whole[-1]["readings_loaded"] == 6000
    again = tables.load_report(spark, fleet.readings, fleet.engines, "fleet_touched").collect()
    assert all(r["engines_loaded"] == r["readings_loaded"] == 0 for r in again)
    some = fleet.engines.where("dataset = 'FD003'").withColumn("engine_id", tables.F.col("engine_id") + 1000)
    tables.append_new(some, "fleet_touched.engines", C.KEYS)
    assert spark.table("fleet_touched.engines").count() == 26 + some.count()


def test_histogram_has_all_bins(spark):
    from fleetspan.operators import profiling

    df = spark.createDataFrame([(0.0,), (0.1,), (4.0,), (None,)], "x double")
    rows = [tuple(r) for r in profiling.numeric_histogram(df, "x", 4).orderBy("bin").collect()]
    assert rows == [(0, 0.0, 1.0, 2), (1, 1.0, 2.0, 0), (2, 2.0, 3.0, 0), (3, 3.0, 4.0, 1)]
    assert profiling.numeric_histogram(df.where("false"), "x", 4).isEmpty()


def test_view_and_table_function(spark, fleet):
    sql_surface.register_views(spark, fleet)
    sql_surface.register_alert_function(spark)
    n = spark.sql("SELECT count(*) FROM maintenance_alerts('FD001', 30)").first()[0]
    assert n == fleet.engines.where("dataset = 'FD001'").count()
    assert spark.sql("SELECT count(*) FROM v_engine_health WHERE health_status = 'DANGER'").first()[0] == 780  # 30 in each engine


def test_shared_folder_comes_from_the_session(spark):
    assert shared.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_exported_csv_can_be_compressed(spark, tmp_path):
    df = spark.range(500).selectExpr("id", "id / 7 AS x", "if(id % 9 = 0, NULL, 'a,b') AS s")
    reports.export_csv(df, str(tmp_path / "csv"), "gzip")
    assert all(f.name.endswith(".csv.gz") for f in (tmp_path / "csv").glob("part-*"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, schema=df.schema)
    assert back.exceptAll(df).isEmpty() and back.count() == 500
