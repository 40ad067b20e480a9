"""Continuous forms of the latest state, alerts, rolling means and KPIs.

Results are tables of per-batch files. Rows that come too late for a result are not lost:
they are written to a table of their own beside it (``late_rows``).
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan import constants as C
from fleetspan.functions import health
from fleetspan.operators.serving import latest_per_engine
from fleetspan.streaming.engine_state import with_last_readings
from fleetspan.streaming.feed import newest_version, run_available, write_batch

KEY = ["engine_id"]
WINDOW = "5 minutes"
LATE = "engine_id bigint, ts timestamp, rul double"


def _started(spark: SparkSession, path: str, columns: str) -> None:
    """An empty result, so that a stream without rows has one too."""
    write_batch(spark.createDataFrame([], columns), path, -1)


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{c} {t}" for c, t in df.dtypes)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came too late for the result at ``path``."""
    return spark.read.parquet(f"{path}/late").drop("batch")


def stream_latest(spark: SparkSession, feed: DataFrame, path: str) -> DataFrame:
    """Latest reading and status per engine, kept current by the stream."""
    latest = latest_per_engine(feed, KEY, "ts").withColumn(
        "health_status", health.health_status(F.col("rul"), "HEALTHY")
    )
    _started(spark, f"{path}/table", _schema(latest))
    run_available(
        latest, lambda df, batch: write_batch(df, f"{path}/table", batch), f"{path}/checkpoint", "update"
    )
    return newest_version(spark, f"{path}/table", KEY)


def _run(spark: SparkSession, feed: DataFrame, path: str, rows: int, columns: str, result, flag: str) -> None:
    """Write ``result`` of the rows in time, and the rows with the flag to the table of late ones."""

    def each(df: DataFrame, batch: int) -> None:
        write_batch(result(df.where(f"NOT {flag}")), f"{path}/table", batch)
        write_batch(df.where(flag).select("engine_id", "ts", "rul"), f"{path}/late", batch)

    _started(spark, f"{path}/table", columns)
    _started(spark, f"{path}/late", LATE)
    run_available(with_last_readings(feed, rows), each, f"{path}/checkpoint", reread=True)


def stream_alerts(spark: SparkSession, feed: DataFrame, path: str) -> DataFrame:
    """One alert whenever an engine's status turns to danger."""
    status = health.health_status(F.col("rul"), "HEALTHY")
    previous = F.when(F.col("has_previous"), health.health_status(F.col("previous_rul"), "HEALTHY"))
    turned = "health_status = 'DANGER' AND coalesce(previous_status, '') <> 'DANGER'"

    def alerts(df: DataFrame) -> DataFrame:
        known = df.select("engine_id", "ts", "rul", status.alias("health_status"), previous.alias("previous_status"))
        return known.where(turned)

    _run(spark, feed, path, 2, f"{LATE}, health_status string, previous_status string", alerts, "late")
    return spark.read.parquet(f"{path}/table").drop("batch")


def stream_rolling(
    spark: SparkSession, feed: DataFrame, path: str, rows: int = C.ROLLING_ROWS
) -> DataFrame:
    """Mean of each engine's last ``rows`` values at every reading."""
    wanted = ["engine_id", "ts", "rul", "rolling_avg"]
    _run(spark, feed, path, rows, f"{LATE}, rolling_avg double", lambda df: df.select(*wanted), "late")
    return spark.read.parquet(f"{path}/table").drop("batch")


def kpi_parts(feed: DataFrame) -> DataFrame:
    """What the KPIs of a refresh interval are made of, engine by engine; parts of one interval can be merged."""
    return (
        feed.groupBy(F.window("ts", WINDOW).alias("w"), "engine_id")
        .agg(
            F.count("*").alias("readings"),
            F.count_if(health.is_danger(F.col("rul"))).alias("danger"),
            F.sum("rul").alias("sum_rul"),
            F.count("rul").alias("known"),
            F.min("rul").alias("min_rul"),
        )
        .select(F.col("w.start").alias("window_start"), "engine_id", "readings", "danger", "sum_rul", "known", "min_rul")
    )


def merged_kpis(parts: DataFrame, interval: str | None = None) -> DataFrame:
    """Fleet KPIs of each refresh interval, or of a longer one; every engine counts once in an interval."""
    start = F.window("window_start", interval)["start"] if interval else F.col("window_start")
    sums = [F.sum(c).alias(c) for c in ("readings", "danger", "sum_rul", "known")]
    of_engine = parts.groupBy(start.alias("window_start"), "engine_id").agg(*sums, F.min("min_rul").alias("min_rul"))
    return of_engine.groupBy("window_start").agg(
        F.sum("readings").alias("readings"),
        F.sum("danger").alias("danger"),
        F.try_divide(F.sum("sum_rul"), F.sum("known")).alias("avg_rul"),
        F.min("min_rul").alias("min_rul"),
        F.count("engine_id").alias("engines"),
    )


def kpi_windows(feed: DataFrame) -> DataFrame:
    """The same KPIs of a table."""
    return merged_kpis(kpi_parts(feed))


def stream_kpi_parts(spark: SparkSession, feed: DataFrame, path: str) -> DataFrame:
    """Mergeable parts of the KPIs, one for each interval and engine that a batch has rows of.

    An interval gets no more parts once the watermark has passed it: what comes after is late.
    No state is kept for intervals.
    """
    columns = "window_start timestamp, engine_id bigint, readings bigint, danger bigint, sum_rul double, known bigint, min_rul double"
    _run(spark, feed, path, 1, columns, kpi_parts, "behind")
    return spark.read.parquet(f"{path}/table").drop("batch")


def stream_kpis(spark: SparkSession, feed: DataFrame, path: str) -> DataFrame:
    """KPI snapshots per refresh interval over all rows that came in time."""
    return merged_kpis(stream_kpi_parts(spark, feed, path))
