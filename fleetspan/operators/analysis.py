"""The analyst's questions: lives, degradation, ranks and alerts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspan import constants as C
from fleetspan.functions import health
from fleetspan.operators import lives


def fleet_summary(engines: DataFrame) -> DataFrame:
    return (
        engines.groupBy("dataset")
        .agg(
            F.countDistinct("engine_id").alias("total_engines"),
            F.min("max_cycle").alias("shortest_life"),
            F.max("max_cycle").alias("longest_life"),
            F.round(F.avg("max_cycle"), 1).alias("average_life"),
        )
        .orderBy("dataset")
    )


def life_variability(engines: DataFrame) -> DataFrame:
    """Spread of lives per dataset; the deviation is the population form."""
    return engines.groupBy("dataset").agg(
        F.countDistinct("engine_id").alias("total_engines"),
        F.round(F.avg("max_cycle"), 0).alias("avg_engine_life"),
        F.min("max_cycle").alias("shortest_life"),
        F.max("max_cycle").alias("longest_life"),
        F.round(F.stddev_pop("max_cycle"), 1).alias("life_variability"),
    )


def readings_per_dataset(readings: DataFrame) -> DataFrame:
    return readings.groupBy("dataset").agg(F.count("*").alias("total_readings"))


def life_categories(engines: DataFrame) -> DataFrame:
    return engines.select(
        "engine_id",
        "dataset",
        F.col("max_cycle").alias("total_life_in_cycles"),
        health.life_category(F.col("max_cycle")).alias("life_category"),
    )


def life_category_summary(engines: DataFrame) -> DataFrame:
    return (
        life_categories(engines)
        .groupBy("dataset", "life_category")
        .agg(
            F.count("*").alias("number_of_engines"),
            F.round(F.avg("total_life_in_cycles"), 1).alias("avg_life_in_category"),
        )
        .orderBy("dataset", "avg_life_in_category")
    )


def rank_longevity(engines: DataFrame) -> DataFrame:
    """Rank, distance from the mean and percentile of each engine in its dataset.

    Ranks depend only on the life, so they are worked out on one row per
    distinct life (a dataset has at most about sqrt(2 x readings) of them) and
    joined back; no dataset's engines are ever sorted in one task.
    """
    longest_first = Window.partitionBy("dataset").orderBy(F.col("max_cycle").desc())
    shortest_first = Window.partitionBy("dataset").orderBy("max_cycle")
    strictly_before = (Window.unboundedPreceding, -1)
    fleet = Window.partitionBy("dataset")
    ranked = (
        engines.groupBy("dataset", "max_cycle")
        .count()
        .withColumn("longer", F.sum("count").over(longest_first.rowsBetween(*strictly_before)))
        .withColumn("shorter", F.sum("count").over(shortest_first.rowsBetween(*strictly_before)))
        .withColumn("engines", F.sum("count").over(fleet))
        .withColumn("cycles", F.sum(F.col("count") * F.col("max_cycle")).over(fleet))
        .select(
            "dataset",
            "max_cycle",
            (1 + F.coalesce("longer", F.lit(0))).alias("rank_by_longevity"),
            F.round(F.col("max_cycle") - F.col("cycles") / F.col("engines"), 1).alias(
                "difference_from_average"
            ),
            F.round(
                F.lit(100.0) * (1 + F.coalesce("shorter", F.lit(0))) / F.col("engines"), 1
            ).alias("percentile"),
        )
    )
    return engines.join(ranked, ["dataset", "max_cycle"]).select(
        "engine_id",
        "dataset",
        "max_cycle",
        "rank_by_longevity",
        "difference_from_average",
        "percentile",
    )


def early_life(readings: DataFrame, cycles: int = C.EARLY_CYCLES) -> DataFrame:
    return (
        readings.where(F.col("cycle") <= cycles)
        .groupBy("engine_id", "dataset")
        .agg(*[F.avg(s).alias(f"avg_{s}_early") for s in C.KEY_SENSORS])
    )


def late_life(readings: DataFrame, engines: DataFrame, cycles: int = C.LATE_CYCLES) -> DataFrame:
    """Means from ``cycles`` before the last cycle on, both ends included."""
    return (
        lives.join_engines(readings, engines)
        .where(F.col("cycle") >= F.col("max_cycle") - cycles)
        .groupBy("engine_id", "dataset")
        .agg(*[F.avg(s).alias(f"avg_{s}_late") for s in C.KEY_SENSORS])
    )


def degradation_delta(
    readings: DataFrame,
    engines: DataFrame,
    early: int = C.EARLY_CYCLES,
    late: int = C.LATE_CYCLES,
    sensors: tuple[str, ...] = ("sensor_2", "sensor_11"),
    digits: int = 2,
) -> DataFrame:
    """Early mean, late mean and change per engine, in one pass over the readings.

    Both phases are conditional means of one grouping, so there is neither a
    second scan nor a join of per-engine results. An engine needs readings in
    both phases to appear, as with the inner join of two summaries.
    """
    is_early = F.col("cycle") <= early
    is_late = F.col("cycle") >= F.col("max_cycle") - late
    phases = {"early": is_early, "late": is_late}
    means = [
        F.avg(F.when(rows, F.col(s))).alias(f"{s}_{phase}_raw")
        for s in sensors
        for phase, rows in phases.items()
    ]
    per_engine = (
        lives.join_engines(readings, engines)
        .where(is_early | is_late)
        .groupBy("engine_id", "dataset", F.col("max_cycle").alias("total_life"))
        .agg(*means, F.count_if(is_early).alias("n_early"), F.count_if(is_late).alias("n_late"))
        .where("n_early > 0 AND n_late > 0")
    )
    columns = ["engine_id", "dataset", "total_life"]
    for s in sensors:
        first, last = F.col(f"{s}_early_raw"), F.col(f"{s}_late_raw")
        columns += [
            F.round(first, digits).alias(f"{s}_early"),
            F.round(last, digits).alias(f"{s}_late"),
            F.round(last - first, digits).alias(f"{s}_change"),
        ]
    return per_engine.select(*columns)


def degradation_by_joins(readings: DataFrame, engines: DataFrame, digits: int = 2) -> DataFrame:
    """The same report as three joined summaries, the form an analyst writes as CTEs."""
    joined = engines.join(early_life(readings), C.KEYS).join(late_life(readings, engines), C.KEYS)
    columns = ["engine_id", "dataset", F.col("max_cycle").alias("total_life")]
    for s in ("sensor_2", "sensor_11"):
        first, last = F.col(f"avg_{s}_early"), F.col(f"avg_{s}_late")
        columns += [
            F.round(first, digits).alias(f"{s}_early"),
            F.round(last, digits).alias(f"{s}_late"),
            F.round(last - first, digits).alias(f"{s}_change"),
        ]
    return joined.select(*columns)


def maintenance_alerts(
    readings: DataFrame,
    engines: DataFrame,
    threshold: int = C.DANGER_BELOW,
    dataset: str | None = None,
    stamped: bool = True,
) -> DataFrame:
    """Engines at their last reading with at most ``threshold`` cycles left."""
    rows = readings.select("engine_id", "dataset", "cycle")
    if dataset is not None:
        rows = rows.where(F.col("dataset") == dataset)
    alerts = (
        lives.join_engines(rows, engines)
        .where(F.col("cycle") == F.col("max_cycle"))
        .where(F.col("max_cycle") - F.col("cycle") <= threshold)
        .select(
            "engine_id",
            "dataset",
            F.col("cycle").alias("current_cycle"),
            F.col("max_cycle").alias("failure_cycle"),
            (F.col("max_cycle") - F.col("cycle")).alias("cycles_remaining"),
            F.lit(C.ALERT_MESSAGE).alias("alert_message"),
        )
    )
    if stamped:
        alerts = alerts.withColumn("report_generated_at", F.current_timestamp())
    return alerts.orderBy("cycles_remaining", *C.KEYS)


def table_counts(**tables: DataFrame) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def load_breakdown(readings: DataFrame) -> DataFrame:
    """Engines, rows and cycle range per dataset.

    Engines are pre-aggregated, so the distinct count never carries readings.
    """
    per_engine = readings.groupBy("dataset", "engine_id").agg(
        F.count("*").alias("n"), F.min("cycle").alias("lo"), F.max("cycle").alias("hi")
    )
    return (
        per_engine.groupBy("dataset")
        .agg(
            F.count("*").alias("number_of_engines"),
            F.sum("n").alias("total_sensor_readings"),
            F.min("lo").alias("min_cycle"),
            F.max("hi").alias("max_cycle"),
        )
        .orderBy("dataset")
    )
