"""Every query by name: a function of the session and a table folder."""

from collections.abc import Callable
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan import constants as C
from fleetspan.functions import health, scalars
from fleetspan.models import forest, isolation, prepare
from fleetspan.operators import analysis, history, lives, profiling, quantiles, serving, sets
from fleetspan.plans import sql_surface
from fleetspan.plans.binding import Fleet, as_feed, lineitem_fleet, passing_readings, state_of, table, with_gaps
from fleetspan.plans.shared import new_path
from fleetspan.sinks import reports, tables
from fleetspan.sources import pages, text
from fleetspan.sources import tables as stored
from fleetspan.streaming import feed as feeds
from fleetspan.streaming import reports as live

Query = Callable[[SparkSession, str], DataFrame]

READING = [*C.KEYS, "cycle"]
LINK_TEXT_TERMS = ["the", "tion"]
LINK_HREF_TERMS = ["tion"]


def _on_fleet(build: Callable[[Fleet], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(lineitem_fleet(spark, sf_dir))


def _serving(fleet: Fleet) -> DataFrame:
    return lives.serving_frame(fleet.test_readings, fleet.labels, fleet.rows_per_engine)


def _on_serving(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_fleet(lambda fleet: build(_serving(fleet)))


def _on_latest(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_serving(lambda df: build(serving.latest_per_engine(df)))


def _rounded(df: DataFrame, digits: int = 6, suffixes: tuple[str, ...] = ("",)) -> DataFrame:
    """Round the float columns whose name ends in one of the suffixes.

    Sums depend on row order in their last bits, and engines break decimal ties
    differently. Snapping to a finer grid first and rounding by ``floor`` gives
    the same digits everywhere.
    """
    scale = F.lit(10.0**digits)
    chosen = {c for c, t in df.dtypes if t == "double" and c.endswith(suffixes)}

    def snapped(c: str):
        return (F.floor(F.round(c, digits + 4) * scale + 0.5).cast("double") / scale).alias(c)

    return df.select(*[snapped(c) if c in chosen else F.col(c) for c in df.columns])


_ROLLED = ("_rolling_avg", "_rolling_std")


def _features(fleet: Fleet) -> DataFrame:
    return lives.features(fleet.readings, fleet.rows_per_engine)


def _rul(fleet: Fleet, *columns: str) -> DataFrame:
    return lives.rul(fleet.readings.select(*READING, *columns), fleet.rows_per_engine)


def _insert_ignore(fleet: Fleet) -> DataFrame:
    engines = fleet.engines
    shift = engines.agg(F.max("engine_id") + 1).scalar()
    arrivals = fleet.labels.select(
        (F.col("engine_id") + shift).alias("engine_id"), "dataset", F.col("true_rul").alias("max_cycle")
    )
    repeats = engines.withColumn("max_cycle", F.col("max_cycle") + 1)
    return tables.insert_ignore(engines, repeats.unionByName(arrivals), C.KEYS)


def _repeated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    fleet = lineitem_fleet(spark, sf_dir)
    database = f"fleet_{uuid4().hex}"
    tables.create_tables(spark, database, new_path(spark, "tables"))
    for _ in range(2):
        tables.append_new(fleet.engines, f"{database}.engines", C.KEYS)
    return spark.table(f"{database}.engines").select(
        F.col("engine_id").cast("bigint").alias("engine_id"), "dataset", "max_cycle"
    )


def _text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "text")
    readings = passing_readings(spark, sf_dir)
    line = F.concat(F.concat_ws(" ", *[F.col(c).cast("string") for c in C.RAW_COLUMNS]), F.lit("  "))
    file_name = F.concat(F.lit("train_"), F.col("dataset"), F.lit(".txt"))
    readings.select(line.alias("value"), file_name.alias("name")).write.partitionBy("name").text(path)
    return text.read_readings(spark, f"{path}/name=train_FD[0-9]*.txt").withColumn(
        "engine_id", F.col("engine_id").cast("bigint")
    )


def _label_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "labels")
    file_name = F.concat(F.lit("RUL_"), F.col("dataset"), F.lit(".txt"))
    line = F.concat(F.col("true_rul").cast("string"), F.lit(" "))
    (
        lineitem_fleet(spark, sf_dir)
        .labels.withColumn("name", file_name)
        .repartitionByRange("name", "engine_id")
        .sortWithinPartitions("name", "engine_id")
        .select(line.alias("value"), "name")
        .write.partitionBy("name")
        .text(path)
    )
    return text.read_labels(spark, f"{path}/name=RUL_FD[0-9]*.txt")


def _feature_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv")
    features = _features(lineitem_fleet(spark, sf_dir))
    reports.export_csv(features.select(*C.FEATURE_SCHEMA.names), path, "gzip")
    back = stored.read_features(spark, path, "csv")
    return back.select(
        "dataset",
        F.col("engine_id").cast("bigint").alias("engine_id"),
        "cycle",
        "max_cycle",
        "RUL",
        "RUL_capped",
    )


def _serving_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"fleet_readings_{uuid4().hex}"
    frame = _serving(lineitem_fleet(spark, sf_dir))
    tables.refresh(frame, name, new_path(spark, "serving"))
    tables.refresh(spark.table(name), name, new_path(spark, "serving"))
    return stored.read_serving(spark, name, C.SERVING_COLUMNS, is_table=True)


def _nan_to_null(fleet: Fleet) -> DataFrame:
    broken = F.when(F.col("cycle") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("sensor_2"))
    return scalars.nan_to_null(
        fleet.readings.select("engine_id", "dataset", "cycle", broken.alias("sensor_2"))
    )


def _coerce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        scalars.to_number(
            F.when(kind == "error", kind).otherwise(F.col("value").cast("string"))
        ).alias("value"),
        scalars.to_flag(F.when(kind == "click", "true").when(kind == "view", "false")).alias("is_anomaly"),
    )


def _number_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.col("l_quantity") * 0.5
    at = F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        scalars.half_up(half).alias("half_up"),
        scalars.half_even(half).alias("half_even"),
        scalars.truncated(F.col("l_extendedprice")).alias("truncated"),
        F.round(F.sqrt("l_extendedprice"), 6).alias("root"),
        F.abs(F.col("l_discount") - 0.05).alias("distance"),
        scalars.engine_label(F.col("l_suppkey"), F.lower("l_returnflag")).alias("label"),
        scalars.thousands(F.col("l_partkey") * 1000).alias("thousands"),
        F.format_string("%.2f", "l_quantity").alias("fixed"),
        scalars.stamp(scalars.STAMP_PAGE, at).alias("stamp_page"),
        scalars.stamp(scalars.STAMP_MAIL, at).alias("stamp_mail"),
        scalars.stamp(scalars.STAMP_FILE, at).alias("stamp_file"),
    )


def _text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(scalars.words(F.col("text"))).cast("bigint").alias("words"),
        scalars.contains_any(F.col("text"), ["license", "copyright"]).alias("mentions_terms"),
        F.md5(F.replace("text", F.lit("the"), F.lit("<THE>"))).alias("replaced_md5"),
    )


def _predicted(fleet: Fleet) -> DataFrame:
    """A closed-form prediction, so that the error measures have an exact answer."""
    capped = health.clip_above(F.col("RUL")).cast("double")
    return _rul(fleet, "sensor_2").select(
        capped.alias("RUL_capped"),
        (capped + (F.col("sensor_2") - 642.0) * 4.0).alias("predicted_rul"),
    )


def _late_life_flags(fleet: Fleet) -> DataFrame:
    return _serving(fleet)


def _status_by_engine(df: DataFrame) -> DataFrame:
    status = serving.with_status(serving.latest_per_engine(df)).select(*C.KEYS, "health_status")
    return df.select(*READING).join(status, C.KEYS)


def _report_time():
    """A fixed time of report, so that pages can be compared."""
    return F.lit("2024-02-01 08:30:00").cast("timestamp")


def _alerts_emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = serving.latest_per_engine(_serving(lineitem_fleet(spark, sf_dir)))
    path = new_path(spark, "alerts")
    for day in ("2024-01-31", "2024-02-01", "2024-02-01"):  # the second day is reported twice
        reports.emit_alerts(latest, path, day)
    return spark.read.parquet(path).drop("reported_at")


def _load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    fleet, database = lineitem_fleet(spark, sf_dir), f"fleet_{uuid4().hex}"
    tables.create_tables(spark, database, new_path(spark, "tables"))
    return tables.load_report(spark, fleet.readings, fleet.engines, database)


def _sensor_profile_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.labelled(spark, profiling.sensor_profile(lineitem_fleet(spark, sf_dir).readings))


# --- Models: trained once per application and state of the table, saved, and loaded back ---


def _state(spark: SparkSession, sf_dir: str) -> str:
    return state_of(spark, f"{sf_dir}/lineitem.parquet")


@cache
def _training_frame(app: str, sf_dir: str, state: str) -> str:
    spark = SparkSession.active()
    path = new_path(spark, "features")
    prepare.model_frame(_features(lineitem_fleet(spark, sf_dir))).write.parquet(path)
    return path


def _model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_training_frame(spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir)))


@cache
def _trained_forest(app: str, sf_dir: str, state: str) -> str:
    spark = SparkSession.active()
    model, _, _ = forest.train_life_model(_model_frame(spark, sf_dir))
    path = new_path(spark, "forest")
    forest.save_model(model, path)
    return path


def _forest(spark: SparkSession, sf_dir: str):
    return forest.load_model(_trained_forest(spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir)))


@cache
def _trained_isolation(app: str, sf_dir: str, state: str) -> str:
    spark = SparkSession.active()
    fitted = isolation.fit_isolation_forest(prepare.healthy_rows(_model_frame(spark, sf_dir)))
    path = new_path(spark, "isolation")
    fitted.save(path)
    return path


def _isolation(spark: SparkSession, sf_dir: str) -> isolation.IsolationForest:
    return isolation.IsolationForest.load(
        spark, _trained_isolation(spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir))
    )


def _held_out_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _model_frame(spark, sf_dir).where(prepare.split_flag())
    return forest.predict(_forest(spark, sf_dir), held_out)


def _rul_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = forest.residuals(_held_out_predictions(spark, sf_dir))
    return scored.select(*READING, "RUL_capped", "predicted_rul", "residual")


def _rul_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.regression_metrics(_held_out_predictions(spark, sf_dir))


def _feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.importances(_forest(spark, sf_dir))


def _anomaly_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _isolation(spark, sf_dir).score(_model_frame(spark, sf_dir))
    return scored.select(*READING, "cycle_ratio", "sensor_2", "anomaly_score", "is_anomaly")


def _anomaly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isolation.anomaly_rate(_anomaly_flags(spark, sf_dir))


def _model_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = _model_frame(spark, sf_dir)
    return forest.model_card(
        _held_out_predictions(spark, sf_dir),
        frame.where(~prepare.split_flag()),
        _feature_importances(spark, sf_dir),
        _anomaly_rate(spark, sf_dir),
    )


def _model_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the trained models, whatever they have learned: sizes, shares and bounds."""
    frame, life, odd = _model_frame(spark, sf_dir), _forest(spark, sf_dir), _isolation(spark, sf_dir)
    learned = frame.agg(F.count_if(~prepare.split_flag()).alias("training_rows"), F.count_if(prepare.split_flag()).alias("held_out_rows"))
    inside = F.col("predicted_rul").between(0, C.RUL_CAP)
    scored = _held_out_predictions(spark, sf_dir).agg(F.count_if(inside).alias("predictions_in_range"))
    listed = forest.importances(life).agg(
        F.count("*").alias("importances"), F.round(F.sum("importance"), 9).alias("importance_sum")
    )
    grown = life.nodes.agg(
        F.countDistinct("tree").alias("trees"),
        F.count_if(F.col("node") >= 2 ** (C.FOREST_DEPTH + 1)).alias("nodes_too_deep"),
        F.count_if((F.col("input") < 0) & (F.col("rows") < C.FOREST_MIN_LEAF)).alias("leaves_too_small"),
    )
    isolated = odd.nodes.agg(F.countDistinct("tree").alias("isolation_trees"))
    flagged = odd.score(prepare.healthy_rows(frame)).agg(
        F.round(F.avg(F.col("is_anomaly").cast("int")), 2).alias("healthy_share_flagged")
    )
    facts = None
    for part in (learned, scored, listed, grown, isolated, flagged):
        tall = part.select(*[F.col(c).cast("double") for c in part.columns]).unpivot([], part.columns, "fact", "value")
        facts = tall if facts is None else facts.unionByName(tall)
    return facts


def _anomaly_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isolation.anomaly_scatter(_anomaly_flags(spark, sf_dir))


def _fleet_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved model's life estimate at the last reading of each truncated engine."""
    fleet = lineitem_fleet(spark, sf_dir)
    features = lives.features(fleet.test_readings, fleet.rows_per_engine)
    latest = serving.latest_per_engine(features.select(*READING, *C.MODEL_FEATURES))
    scored = forest.score_fleet(_forest(spark, sf_dir), latest)
    return scored.select(*READING, "predicted_rul")


# --- Streams ---------------------------------------------------------------------


BATCHES, FILES = 6, 2


@cache
def _feed_files(app: str, sf_dir: str, state: str) -> str:
    """The events as files in time order, so that streams have batches."""
    spark = SparkSession.active()
    path = new_path(spark, "feed")
    feeds.in_time_order(table(spark, sf_dir, "events"), path, BATCHES, FILES)
    return path


def _stream(build: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        files = _feed_files(spark.sparkContext.applicationId, sf_dir, state_of(spark, f"{sf_dir}/events.parquet"))
        out = build(spark, feeds.read_feed(spark, files, files_per_batch=FILES), new_path(spark, "stream"))
        stamps = [c for c, t in out.dtypes if t == "timestamp"]
        return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})

    return run


def _late_rows(spark: SparkSession, feed: DataFrame, path: str) -> DataFrame:
    """How many rows the streams by engine and by interval set aside as late; none, where files come in time order."""
    found = []
    for name, build in (("rolling", live.stream_rolling), ("kpis", live.stream_kpi_parts)):
        build(spark, feed, f"{path}/{name}")
        late = live.late_rows(spark, f"{path}/{name}")
        found.append(late.agg(F.lit(name).alias("stream"), F.count("*").alias("late_rows")))
    return found[0].union(found[1])


def _chosen_engines(fleet: Fleet) -> DataFrame:
    """The IN list and the data set filter of the view; no engine chosen is an error."""
    found = lives.rul_health(fleet.readings, fleet.engines, dataset="FD002", engine_ids=[1, 5, 9, 1])
    return sets.require_rows(found, "no such engines")


def _present_columns(fleet: Fleet) -> DataFrame:
    """Optional columns are taken where the frame has them."""
    frame = with_gaps(fleet.readings)
    return frame.select(*READING, *sets.keep_present(frame, ["sensor_2", "sensor_99", "sensor_7", "is_anomaly"]))


def all_queries() -> dict[str, Query]:
    return {
        # SQL analysis
        "fleet_summary": _on_fleet(lambda f: analysis.fleet_summary(f.engines)),
        "readings_per_dataset": _on_fleet(lambda f: analysis.readings_per_dataset(f.readings)),
        "life_category": _on_fleet(lambda f: analysis.life_categories(f.engines)),
        "life_category_summary": _on_fleet(lambda f: analysis.life_category_summary(f.engines)),
        "rank_longevity": _on_fleet(lambda f: analysis.rank_longevity(f.engines)),
        "cycle_delta": _on_fleet(
            lambda f: history.cycle_delta(f.readings, rows_per_key=f.rows_per_engine)
        ),
        "early_life": _on_fleet(lambda f: _rounded(analysis.early_life(f.readings))),
        "late_life": _on_fleet(lambda f: _rounded(analysis.late_life(f.readings, f.engines))),
        "degradation_delta": _on_fleet(
            lambda f: analysis.degradation_delta(f.readings, f.engines, digits=4)
        ),
        "degradation_by_joins": _on_fleet(
            lambda f: analysis.degradation_by_joins(f.readings, f.engines, digits=4)
        ),
        "rul_health": _on_fleet(lambda f: lives.rul_health(f.readings, f.engines)),
        "engine_health_danger": _on_fleet(
            lambda f: lives.rul_health(f.readings, f.engines).where("health_status = 'DANGER'")
        ),
        "danger_preview": _on_fleet(
            lambda f: profiling.preview(
                lives.rul_health(f.readings, f.engines).where("health_status = 'DANGER'"), READING, 20
            )
        ),
        "chosen_engines": _on_fleet(_chosen_engines),
        "present_columns": _on_fleet(_present_columns),
        "work_order_report": _on_latest(serving.work_order_report),
        "stamped_alerts": _on_fleet(
            lambda f: analysis.maintenance_alerts(f.readings, f.engines)
            .groupBy("dataset")
            .agg(F.count("*").alias("alerts"), F.count_if(F.col("report_generated_at").isNull()).alias("unstamped"))
        ),
        "maintenance_alerts": _on_fleet(
            lambda f: analysis.maintenance_alerts(f.readings, f.engines, stamped=False)
        ),
        "maintenance_alerts_sql": lambda spark, sf_dir: sql_surface.maintenance_alerts_sql(
            spark, lineitem_fleet(spark, sf_dir), C.DANGER_BELOW
        ),
        "life_variability": _on_fleet(lambda f: analysis.life_variability(f.engines)),
        "sensor_profile": _on_fleet(lambda f: profiling.sensor_profile(f.readings)),
        "sensor_profile_union": _on_fleet(lambda f: profiling.sensor_profile_union(f.readings)),
        "sensor_profile_labelled": _sensor_profile_labelled,
        # Profiling
        "describe_sensors": _on_fleet(
            lambda f: _rounded(
                quantiles.describe(f.readings, ["cycle", *C.SETTINGS, *C.SENSORS]),
                4,
                ("mean", "std", "min", "p25", "p50", "p75", "max"),
            )
        ),
        "profile_columns": _on_fleet(lambda f: profiling.profile_columns(with_gaps(f.readings))),
        "missing_report": _on_fleet(lambda f: profiling.missing_report(with_gaps(f.readings))),
        "missing_verdict": _on_fleet(lambda f: profiling.missing_verdict(with_gaps(f.readings))),
        "drop_all_null_columns": _on_fleet(
            lambda f: profiling.drop_all_null_columns(with_gaps(f.readings))
        ),
        "constant_sensors": _on_fleet(lambda f: _rounded(profiling.constant_sensors(f.readings))),
        "rul_stats": _on_fleet(lambda f: profiling.rul_stats(f.readings, f.rows_per_engine)),
        "correlation_matrix": _on_fleet(lambda f: profiling.correlation_matrix(f.readings, digits=4)),
        "correlated_pairs": _on_fleet(
            lambda f: profiling.correlated_pairs(profiling.correlation_matrix(f.readings, digits=4))
        ),
        "rul_correlation": _on_fleet(
            lambda f: profiling.rul_correlation(f.readings, f.rows_per_engine, digits=4)
        ),
        "lifespan_histogram": _on_fleet(lambda f: profiling.lifespan_histogram(f.engines)),
        "mean_life": _on_fleet(lambda f: profiling.mean_life(f.engines)),
        "lifespan_bins": _on_fleet(lambda f: profiling.integer_histogram(f.engines, "max_cycle", 20)),
        "rul_histogram_equal": _on_fleet(lambda f: profiling.integer_histogram(_rul(f), "RUL", 40)),
        "fleet_rul_bins": _on_latest(lambda df: profiling.integer_histogram(df, "rul_capped", 25)),
        "life_stage_profile": _on_fleet(
            lambda f: profiling.life_stage_profile(f.readings, f.rows_per_engine)
        ),
        "sensor_trends": _on_fleet(lambda f: profiling.sensor_trends(f.readings)),
        "preview_readings": _on_fleet(
            lambda f: profiling.preview(_rul(f), READING).select(*READING, "max_cycle", "RUL")
        ),
        # Features
        "engine_lives": _on_fleet(lambda f: lives.engine_lives(f.readings)),
        "rolling_avg": _on_fleet(
            lambda f: _rounded(
                history.rolling(
                    f.readings.select(*READING, *C.KEY_SENSORS), std=False, rows_per_key=f.rows_per_engine
                ).drop(*C.KEY_SENSORS)
            )
        ),
        "rolling_std": _on_fleet(
            lambda f: _rounded(
                history.rolling(
                    f.readings.select(*READING, *C.KEY_SENSORS), mean=False, rows_per_key=f.rows_per_engine
                ).drop(*C.KEY_SENSORS)
            )
        ),
        "cycle_ratio": _on_fleet(
            lambda f: lives.with_life(f.readings.select(*READING), f.rows_per_engine).select(
                *READING, health.cycle_ratio(F.col("cycle"), F.col("max_cycle")).alias("cycle_ratio")
            )
        ),
        "rul_capped": _on_fleet(
            lambda f: _rul(f).select(*READING, "RUL", health.clip_above(F.col("RUL")).alias("RUL_capped"))
        ),
        "rul_from_labels": _on_serving(lambda df: df.select(*READING, "rul_capped")),
        "late_life_flag": _on_serving(lambda df: df.select(*READING, "is_anomaly")),
        "baseline_breach": _on_fleet(
            lambda f: _rounded(lives.baseline_breach(f.readings, rows_per_engine=f.rows_per_engine))
        ),
        "feature_frame": _on_fleet(lambda f: _rounded(_features(f), suffixes=_ROLLED)),
        "minmax_scaled": _on_fleet(
            lambda f: prepare.minmax_scaled(
                f.readings.select(*READING, *C.SETTINGS, *C.SENSORS), (*C.SETTINGS, *C.SENSORS)
            )
        ),
        "hash_split": _on_fleet(
            lambda f: f.readings.select(*READING, prepare.split_flag().alias("held_out"))
        ),
        # Serving
        "serving_frame": _on_fleet(_serving),
        "latest_per_engine": _on_latest(lambda df: df),
        "latest_non_null": _on_fleet(
            lambda f: serving.latest_non_null(with_gaps(f.readings))
        ),
        "fleet_status": _on_latest(serving.fleet_status),
        "rul_kpis": _on_latest(serving.rul_kpis),
        "rul_histogram": _on_latest(serving.rul_histogram),
        "critical_engines": _on_latest(serving.critical_engines),
        "danger_list": _on_latest(serving.danger_list),
        "warning_top5": _on_latest(serving.top_warnings),
        "work_order": _on_latest(serving.work_order),
        "engine_history": _on_serving(lambda df: serving.engine_history(df, 3, "FD004")),
        "worst_engine_histories": _on_serving(serving.worst_engine_histories),
        "readings_desc": _on_serving(stored.by_cycle_descending),
        "engine_cards": _on_serving(serving.engine_cards),
        "rul_gauges": _on_serving(serving.rul_gauges),
        "sensor_series": _on_serving(serving.sensor_series),
        "fleet_banner": _on_latest(serving.fleet_banner),
        "selection_list": _on_latest(serving.selection_list),
        "status_by_engine": _on_serving(_status_by_engine),
        "fleet_alerts": _on_latest(serving.fleet_alerts),
        "alert_rows_html": _on_latest(reports.alert_rows),
        "report_body": _on_latest(reports.report_body),
        "alert_sections": _on_latest(reports.alert_sections),
        "kpi_json": _on_latest(lambda df: reports.kpi_document(df, stamped=False)),
        "kpi_page": _on_latest(lambda df: reports.kpi_page(df, at=_report_time())),
        "alert_mail": _on_latest(lambda df: reports.alert_mail(df, at=_report_time())),
        "alerts_gate": _on_latest(reports.gate),
        "alerts_emitted": _alerts_emitted,
        # Load and sink
        "load_breakdown": _on_fleet(lambda f: analysis.load_breakdown(f.readings)),
        "load_report": _load_report,
        "table_counts": _on_fleet(
            lambda f: analysis.table_counts(
                engines=f.engines, sensor_readings=f.readings, rul_labels=f.labels
            )
        ),
        "insert_ignore": _on_fleet(_insert_ignore),
        "repeated_load": _repeated_load,
        "text_round_trip": _text_round_trip,
        "label_round_trip": _label_round_trip,
        "feature_csv_round_trip": _feature_csv_round_trip,
        "serving_refresh": _serving_refresh,
        "nan_to_null": _on_fleet(_nan_to_null),
        "coerce_types": _coerce_types,
        "page_links": lambda spark, sf_dir: pages.page_links(table(spark, sf_dir, "pages")),
        "relevant_links": lambda spark, sf_dir: pages.relevant_links(
            table(spark, sf_dir, "pages"), LINK_TEXT_TERMS, LINK_HREF_TERMS
        ),
        "link_counts": lambda spark, sf_dir: pages.link_counts(
            table(spark, sf_dir, "pages"), LINK_TEXT_TERMS, LINK_HREF_TERMS
        ),
        "number_functions": _number_functions,
        "text_functions": _text_functions,
        # Streams
        "stream_latest": _stream(live.stream_latest),
        "stream_alerts": _stream(live.stream_alerts),
        "stream_rolling": _stream(
            lambda spark, feed, path: _rounded(live.stream_rolling(spark, feed, path), suffixes=("_avg",))
        ),
        "stream_kpis": _stream(
            lambda spark, feed, path: _rounded(live.stream_kpis(spark, feed, path), suffixes=("avg_rul",))
        ),
        "stream_kpis_daily": _stream(
            lambda spark, feed, path: _rounded(
                live.merged_kpis(live.stream_kpi_parts(spark, feed, path), "1 day"), suffixes=("avg_rul",)
            )
        ),
        "stream_late_rows": _stream(_late_rows),
        # Models
        "regression_metrics": _on_fleet(lambda f: forest.regression_metrics(_predicted(f))),
        "residual_histogram": _on_fleet(
            lambda f: _rounded(profiling.numeric_histogram(forest.residuals(_predicted(f)), "residual", 40))
        ),
        "late_life_scatter": _on_serving(isolation.anomaly_scatter),
        "late_life_rate": _on_serving(isolation.anomaly_rate),
        "healthy_population": _on_fleet(
            lambda f: prepare.healthy_rows(
                _rul(f).withColumn("RUL_capped", health.clip_above(F.col("RUL")))
            ).select(*READING)
        ),
        "rul_predictions": _rul_predictions,
        "rul_model_scores": _rul_model_scores,
        "feature_importances": _feature_importances,
        "anomaly_flags": _anomaly_flags,
        "anomaly_rate": _anomaly_rate,
        "anomaly_scatter": _anomaly_scatter,
        "top_importances": lambda spark, sf_dir: forest.top_importances(_feature_importances(spark, sf_dir)),
        "model_facts": _model_facts,
        "model_card": _model_card,
        "fleet_predictions": _fleet_predictions,
    }


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fleet status from raw line items: lives, labels, latest reading, status shares."""
    return all_queries()["fleet_status"](spark, sf_dir)
