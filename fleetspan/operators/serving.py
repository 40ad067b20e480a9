"""Reports on the latest state of each engine."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspan import constants as C
from fleetspan.functions import health, scalars


def latest_per_engine(df: DataFrame, keys: list[str] = C.KEYS, order: str = "cycle") -> DataFrame:
    """The whole row of each engine's last cycle; of several, the one with the largest other columns.

    The limit on the row number is applied before the exchange as well, so a long
    engine shrinks to one row per task. On a stream, which has no row numbers, the
    same row is the largest struct.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    if df.isStreaming:
        newest = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("newest"))
        return newest.select(*keys, "newest.*").select(*df.columns)
    last = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (order, *rest)])
    return df.withColumn("_nth", F.row_number().over(last)).where(F.col("_nth") == 1).drop("_nth")


def latest_non_null(df: DataFrame, keys: list[str] = C.KEYS, order: str = "cycle") -> DataFrame:
    """Each column's last value that is not null, column by column; of several at one place the largest."""
    rest = [c for c in df.columns if c not in keys and c != order]
    newest = [
        F.max(F.when(F.col(c).isNotNull(), F.struct(order, c))).getField(c).alias(c) for c in rest
    ]
    return df.groupBy(*keys).agg(F.max(order).alias(order), *newest).select(*df.columns)


def with_status(latest: DataFrame, good: str = "HEALTHY") -> DataFrame:
    return latest.withColumn("health_status", health.health_status(F.col("rul_capped"), good))


def fleet_status(latest: DataFrame) -> DataFrame:
    """Engines per status with their truncated share of the fleet, per dataset."""
    counts = with_status(latest).groupBy("dataset", "health_status").agg(F.count("*").alias("engines"))
    # Three rows per dataset.
    fleet = F.sum("engines").over(Window.partitionBy("dataset"))
    return counts.withColumn("fleet_size", fleet).withColumn(
        "pct_of_fleet",
        scalars.truncated(F.lit(100) * F.col("engines") / F.col("fleet_size")),
    )


def _status_counts() -> list:
    life = F.col("rul_capped")
    return [
        F.count("*").alias("total"),
        F.count_if(health.is_danger(life)).alias("danger"),
        F.count_if(health.is_warning(life)).alias("warning"),
        F.count_if(health.is_healthy(life)).alias("healthy"),
    ]


def rul_kpis(latest: DataFrame) -> DataFrame:
    """One row per dataset: fleet size, status counts, mean and least remaining life."""
    return latest.groupBy("dataset").agg(
        *_status_counts(),
        F.coalesce(F.round(F.avg("rul_capped"), 1), F.lit(0.0)).alias("avg_rul"),
        F.coalesce(F.min("rul_capped"), F.lit(0)).alias("min_rul"),
    )


def fleet_banner(latest: DataFrame) -> DataFrame:
    """Overall state per dataset."""
    return (
        latest.groupBy("dataset")
        .agg(*_status_counts())
        .select(
            "dataset",
            "danger",
            "warning",
            health.fleet_banner(F.col("danger"), F.col("warning")).alias("banner"),
        )
    )


def rul_histogram(
    latest: DataFrame, edges: tuple[int, ...] = C.RUL_BIN_EDGES, value: str = "rul_capped"
) -> DataFrame:
    """Engines per half-open life bin, empty bins included, values outside left out."""
    spans = list(zip(edges, edges[1:]))
    life = F.col(value)
    wide = latest.groupBy("dataset").agg(
        *[F.count_if((life >= lo) & (life < hi)).alias(f"{lo}-{hi}") for lo, hi in spans]
    )
    rows = [
        F.struct(
            F.lit(i).alias("bin"),
            F.lit(lo).alias("bin_from"),
            F.lit(hi).alias("bin_to"),
            F.col(f"{lo}-{hi}").alias("engines"),
        )
        for i, (lo, hi) in enumerate(spans)
    ]
    return wide.select("dataset", F.inline(F.array(*rows)))


def critical_engines(latest: DataFrame, k: int = 7) -> DataFrame:
    """The k engines with the least remaining life; unknown life comes last."""
    return (
        with_status(latest, good="OK")
        .select("dataset", "engine_id", "rul_capped", "health_status")
        .orderBy(F.col("rul_capped").asc_nulls_last(), "dataset", "engine_id")
        .limit(k)
    )


def danger_list(latest: DataFrame) -> DataFrame:
    return (
        latest.where(health.is_danger(F.col("rul_capped")))
        .select("dataset", "engine_id", "rul_capped")
        .orderBy("rul_capped", "dataset", "engine_id")
    )


def top_warnings(latest: DataFrame, k: int = 5) -> DataFrame:
    return (
        latest.where(health.is_warning(F.col("rul_capped")))
        .select("dataset", "engine_id", "rul_capped")
        .orderBy("rul_capped", "dataset", "engine_id")
        .limit(k)
    )


def work_order(latest: DataFrame) -> DataFrame:
    """Every engine by urgency, with status, action and display class."""
    return (
        with_status(latest)
        .select(
            "dataset",
            "engine_id",
            F.col("cycle").alias("last_cycle"),
            scalars.half_even(F.col("rul_capped").cast("double"), 1).alias("estimated_rul"),
            F.col("health_status").alias("status"),
            health.action_for(F.col("health_status")).alias("action"),
            health.status_style(F.col("health_status")).alias("style_class"),
        )
        .orderBy(F.col("estimated_rul").asc_nulls_last(), "dataset", "engine_id")
    )


def work_order_report(latest: DataFrame) -> DataFrame:
    """The work order under its report headers."""
    return work_order(latest).withColumnsRenamed(
        {
            "engine_id": "Engine ID",
            "last_cycle": "Last Cycle",
            "estimated_rul": "Estimated RUL",
            "status": "Status",
            "action": "Action",
        }
    )


def selection_list(latest: DataFrame) -> DataFrame:
    """Engine ids in order with a status label."""
    return (
        with_status(latest)
        .select(
            "dataset",
            "engine_id",
            scalars.engine_label(F.col("engine_id"), F.col("health_status")).alias("label"),
        )
        .orderBy("dataset", "engine_id")
    )


def engine_cards(serving: DataFrame) -> DataFrame:
    """Current life, cycles lived, anomalies and status of each engine; of several last rows the longest life."""
    card = serving.groupBy(*C.KEYS).agg(
        F.max(F.struct("cycle", "rul_capped")).getField("rul_capped").alias("current_rul"),
        F.max("cycle").alias("cycles_lived"),
        F.count_if("is_anomaly").alias("anomalies"),
        F.count("*").alias("readings"),
    )
    return card.withColumn("status", health.health_status(F.col("current_rul"), "HEALTHY"))


def rul_gauges(serving: DataFrame) -> DataFrame:
    """Gauge value, distance to the warning limit and band limits per engine."""
    value = F.col("current_rul").cast("int")
    return engine_cards(serving).select(
        *C.KEYS,
        value.alias("gauge_value"),
        (value - C.WARNING_BELOW).alias("gauge_delta"),
        F.lit(C.DANGER_BELOW).alias("danger_to"),
        F.lit(C.WARNING_BELOW).alias("warning_to"),
        F.lit(C.RUL_CAP).alias("gauge_max"),
        F.col("status"),
    )


def engine_history(serving: DataFrame, engine_id: int, dataset: str | None = None) -> DataFrame:
    """All readings of one engine in cycle order; on a stored table both filters reach the scan, and one bucket is read."""
    rows = serving.where(F.col("engine_id") == engine_id)
    if dataset is not None:
        rows = rows.where(F.col("dataset") == dataset)
    return rows.orderBy("cycle")


def worst_engine_histories(serving: DataFrame) -> DataFrame:
    """Readings of the engine with the least remaining life in each dataset.

    One engine per dataset is picked by aggregation; the semi join then scans
    the readings once and keeps theirs.
    """
    latest = latest_per_engine(serving.select(*C.KEYS, "cycle", "rul_capped"))
    worst = latest.groupBy("dataset").agg(
        F.min(F.struct("rul_capped", "engine_id")).getField("engine_id").alias("engine_id")
    )
    return serving.join(worst, C.KEYS, "left_semi")


def sensor_series(serving: DataFrame, sensor: str = "sensor_2") -> DataFrame:
    """A sensor's line and its anomaly markers (null where there is none)."""
    marker = F.when(F.col("is_anomaly"), F.col(sensor)) if "is_anomaly" in serving.columns else F.lit(None)
    return serving.select(
        *C.KEYS, "cycle", F.col(sensor).alias("reading"), marker.cast("double").alias("anomaly_marker")
    )


def fleet_alerts(latest: DataFrame, threshold: int = C.DANGER_BELOW) -> DataFrame:
    """Engines of a truncated fleet within ``threshold`` cycles of failure."""
    return (
        latest.where(F.col("rul_capped") <= threshold)
        .select(
            *C.KEYS,
            F.col("cycle").alias("current_cycle"),
            F.col("rul_capped").alias("cycles_remaining"),
            F.lit(C.ALERT_MESSAGE).alias("alert_message"),
        )
        .orderBy("cycles_remaining", *C.KEYS)
    )
