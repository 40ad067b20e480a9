"""Engine lives and remaining useful life."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspan import constants as C
from fleetspan.functions import health
from fleetspan.operators import history

EDGE = 1e-12


def engine_lives(readings: DataFrame) -> DataFrame:
    """Last cycle per engine: the ``engines`` table of a set of readings."""
    return readings.groupBy("engine_id", "dataset").agg(F.max("cycle").alias("max_cycle"))


def with_life(readings: DataFrame, rows_per_engine: int | None = None) -> DataFrame:
    """Put each engine's last cycle on its rows.

    With a bound on the rows of one engine this is a window, which shares its
    exchange with the rolling features. Without one the lives are aggregated on
    the map side and joined back, so a long engine is never one task; the join
    is left unhinted for Spark to broadcast by size or to split by skew.
    """
    if rows_per_engine is not None and rows_per_engine <= history.BLOCK_CYCLES:
        life = F.max("cycle").over(Window.partitionBy(*C.KEYS))
        return readings.withColumn("max_cycle", life)
    return readings.join(engine_lives(readings), C.KEYS)


def join_engines(readings: DataFrame, engines: DataFrame) -> DataFrame:
    """Readings with the life stored in the engines table."""
    return readings.join(engines.select(*C.KEYS, "max_cycle"), C.KEYS)


def rul(readings: DataFrame, rows_per_engine: int | None = None) -> DataFrame:
    """Remaining cycles of run-to-failure histories."""
    return with_life(readings, rows_per_engine).withColumn("RUL", F.col("max_cycle") - F.col("cycle"))


def rul_from_labels(
    readings: DataFrame, labels: DataFrame, rows_per_engine: int | None = None
) -> DataFrame:
    """Remaining cycles of truncated histories: label plus distance to the last reading."""
    remaining = F.col("true_rul") + (F.col("max_cycle") - F.col("cycle"))
    return (
        with_life(readings, rows_per_engine)
        .join(labels.select(*C.KEYS, "true_rul"), C.KEYS)
        .withColumn("rul_capped", health.clip_above(remaining))
    )


def rul_health(
    readings: DataFrame,
    engines: DataFrame,
    dataset: str | None = None,
    engine_ids: list[int] | None = None,
) -> DataFrame:
    """Remaining life and status of every reading, for all engines or a chosen few."""
    chosen = readings
    if dataset is not None:
        chosen = chosen.where(F.col("dataset") == dataset)
    if engine_ids is not None:
        chosen = chosen.where(F.col("engine_id").isin(engine_ids))
    remaining = F.col("max_cycle") - F.col("cycle")
    return (
        join_engines(chosen, engines)
        .withColumn("remaining_useful_life", remaining)
        .select(
            "engine_id",
            "dataset",
            "cycle",
            "max_cycle",
            "remaining_useful_life",
            health.health_status(F.col("remaining_useful_life")).alias("health_status"),
            *C.KEY_SENSORS,
        )
    )


def features(readings: DataFrame, rows_per_engine: int | None = None) -> DataFrame:
    """The full training frame: life, remaining life, rolling features, ratio and target."""
    return (
        history.rolling(rul(readings, rows_per_engine), rows_per_key=rows_per_engine)
        .withColumn("cycle_ratio", health.cycle_ratio(F.col("cycle"), F.col("max_cycle")))
        .withColumn("RUL_capped", health.clip_above(F.col("RUL")))
    )


def serving_frame(
    readings: DataFrame, labels: DataFrame, rows_per_engine: int | None = None
) -> DataFrame:
    """The published table of a truncated fleet."""
    return (
        rul_from_labels(readings, labels, rows_per_engine)
        .withColumn("cycle_ratio", health.cycle_ratio(F.col("cycle"), F.col("max_cycle")))
        .withColumn("is_anomaly", health.late_life_flag(F.col("cycle_ratio")))
        .select(*C.SERVING_COLUMNS)
    )


def baseline_breach(
    readings: DataFrame,
    sensors: tuple[str, ...] = C.BREACH_SENSORS,
    sigmas: float = C.BREACH_SIGMAS,
    baseline_cycles: int = C.EARLY_CYCLES,
    rows_per_engine: int | None = None,
) -> DataFrame:
    """Flag rows whose rolling mean has left the engine's early-life band.

    The band is the mean and sample deviation over the first
    ``baseline_cycles``, aggregated per engine and joined back. A mean on the
    band's edge has not left it; sums in another order move it by their last digits,
    so what is nearer to the edge than ``EDGE`` of the mean counts as on it.
    """
    baseline = (
        readings.where(F.col("cycle") <= baseline_cycles)
        .groupBy(*C.KEYS)
        .agg(
            *[F.avg(s).alias(f"{s}_mu") for s in sensors],
            *[F.stddev_samp(s).alias(f"{s}_sd") for s in sensors],
        )
    )
    smooth = history.rolling(
        readings.select(*C.KEYS, "cycle", *sensors),
        sensors=sensors,
        std=False,
        rows_per_key=rows_per_engine,
    )
    outside = [
        F.coalesce(
            F.abs(F.col(f"{s}_rolling_avg") - F.col(f"{s}_mu")) - sigmas * F.col(f"{s}_sd") > EDGE * F.abs(F.col(f"{s}_mu")),
            F.lit(False),
        ).alias(f"{s}_breach")
        for s in sensors
    ]
    averages = [f"{s}_rolling_avg" for s in sensors]
    return smooth.join(baseline, C.KEYS).select(*C.KEYS, "cycle", *averages, *outside)
