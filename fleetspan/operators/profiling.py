"""Column profiles, correlations and histograms."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspan import constants as C
from fleetspan.functions import health
from fleetspan.operators import lives
from fleetspan.operators.sets import union_all


def _stack(columns: dict[str, list[Column]], names: list[str]) -> Column:
    """Turn groups of cells of one wide row into one row per group."""
    rows = [
        F.struct(F.lit(key).alias(names[0]), *[c.alias(n) for c, n in zip(cells, names[1:])])
        for key, cells in columns.items()
    ]
    return F.inline(F.array(*rows))


def _tall(wide: DataFrame, columns: dict[str, list[str]], names: list[str], keep=()) -> DataFrame:
    cells = {key: [F.col(c) for c in cols] for key, cols in columns.items()}
    return wide.select(*keep, _stack(cells, names))


def profile_columns(df: DataFrame) -> DataFrame:
    """Type, row count and non-null count of every column, in one pass."""
    wide = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    types = dict(df.dtypes)
    cells = {c: [F.lit(types[c]), F.col("_rows"), F.col(c)] for c in df.columns}
    return wide.select(_stack(cells, ["column_name", "data_type", "row_count", "non_null_count"]))


def missing_report(df: DataFrame) -> DataFrame:
    """Null count and percentage of the columns that have nulls."""
    return (
        profile_columns(df)
        .withColumn("missing_count", F.col("row_count") - F.col("non_null_count"))
        .where("missing_count > 0")
        .select(
            "column_name",
            "missing_count",
            F.round(F.lit(100.0) * F.col("missing_count") / F.col("row_count"), 2).alias("missing_pct"),
        )
    )


def missing_verdict(df: DataFrame) -> DataFrame:
    """One row: the number of missing cells and whether the data are complete."""
    missing = F.coalesce(F.sum("missing_count"), F.lit(0))
    return missing_report(df).agg(
        missing.alias("missing_cells"), (missing == 0).alias("is_complete")
    )


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value; one row of counts decides the schema."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def sensor_profile(
    readings: DataFrame, sensors: tuple[str, ...] = C.PROFILE_SENSORS, digits: int = 4
) -> DataFrame:
    """Mean, population deviation and range of each sensor per dataset, in one scan."""
    aggregates = {"average_value": F.avg, "std_deviation": F.stddev_pop, "min_value": F.min, "max_value": F.max}
    wide = readings.groupBy("dataset").agg(
        *[F.round(fn(s), digits).alias(f"{s}_{name}") for s in sensors for name, fn in aggregates.items()]
    )
    cells = {s: [f"{s}_{name}" for name in aggregates] for s in sensors}
    return _tall(wide, cells, ["sensor_name", *aggregates], keep=["dataset"]).orderBy(
        "dataset", F.col("std_deviation").desc()
    )


def sensor_profile_union(
    readings: DataFrame, sensors: tuple[str, ...] = C.PROFILE_SENSORS, digits: int = 4
) -> DataFrame:
    """The same report as one aggregate per sensor, concatenated."""
    return union_all(
        [
            readings.groupBy("dataset").agg(
                F.lit(s).alias("sensor_name"),
                F.round(F.avg(s), digits).alias("average_value"),
                F.round(F.stddev_pop(s), digits).alias("std_deviation"),
                F.round(F.min(s), digits).alias("min_value"),
                F.round(F.max(s), digits).alias("max_value"),
            )
            for s in sensors
        ]
    ).orderBy("dataset", F.col("std_deviation").desc())


def constant_sensors(
    df: DataFrame, sensors: list[str] = C.SENSORS, below: float = C.CONSTANT_BELOW_STD
) -> DataFrame:
    """Sample deviation of each sensor and whether it carries nothing."""
    wide = df.agg(*[F.stddev_samp(s).alias(s) for s in sensors])
    return _tall(wide, {s: [s] for s in sensors}, ["sensor_name", "std"]).withColumn(
        "is_constant", F.col("std") < below
    )


def rul_stats(readings: DataFrame, rows_per_engine: int | None = None) -> DataFrame:
    life = lives.rul(readings.select(*C.KEYS, "cycle"), rows_per_engine)
    return life.groupBy("dataset").agg(
        F.min("RUL").alias("min_rul"),
        F.max("RUL").alias("max_rul"),
        F.round(F.avg("RUL"), 4).alias("mean_rul"),
    )


_PAIR_SCHEMA = "a int, b int, n double, mx double, my double, cxx double, cyy double, cxy double"


def _pair_moments_of_task(columns: list[str]):
    """Counts, means and centred products of all column pairs, over one task's rows."""

    def accumulate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centre = total = None
        for batch in batches:
            if batch.empty:
                continue
            x = batch[columns].to_numpy(dtype=float)
            if centre is None:
                centre = np.nan_to_num(batch[columns].astype(float).mean().to_numpy())
            known = ~np.isnan(x)
            x = np.where(known, x - centre, 0.0)
            k = known.astype(float)
            sx, sxx = x.T @ k, (x * x).T @ k
            part = np.stack([k.T @ k, sx, sx.T, sxx, sxx.T, x.T @ x])
            total = part if total is None else total + part
        if total is None:
            return
        n, sx, sy, sxx, syy, sxy = total
        rows = np.maximum(n, 1.0)
        a, b = np.indices(n.shape)
        cells = {
            "a": a,
            "b": b,
            "n": n,
            "mx": centre[:, None] + sx / rows,
            "my": centre[None, :] + sy / rows,
            "cxx": sxx - sx * sx / rows,
            "cyy": syy - sy * sy / rows,
            "cxy": sxy - sx * sy / rows,
        }
        yield pd.DataFrame({name: matrix.ravel() for name, matrix in cells.items()})

    return accumulate


def pair_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(sensor_a, sensor_b, r) of every column pair, constant columns left out.

    Each task reduces its rows to one small matrix of moments with matrix
    products, and only those are exchanged: columns squared rows per task. A
    missing value drops a row from the pairs it concerns, not from the others.
    """
    columns = list(columns)
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    n, mx, my = F.col("n"), F.col("mx"), F.col("my")
    merged = (
        values.mapInPandas(_pair_moments_of_task(columns), _PAIR_SCHEMA)
        .groupBy("a", "b")
        .agg(
            F.sum(n).alias("rows"),
            F.sum(n * mx).alias("sx"),
            F.sum(n * my).alias("sy"),
            F.sum(F.col("cxx") + n * mx * mx).alias("sxx"),
            F.sum(F.col("cyy") + n * my * my).alias("syy"),
            F.sum(F.col("cxy") + n * mx * my).alias("sxy"),
        )
        .where("rows > 1")
    )
    rows, sx, sy = F.col("rows"), F.col("sx"), F.col("sy")
    spread_a = F.col("sxx") - sx * sx / rows
    spread_b = F.col("syy") - sy * sy / rows
    joint = F.col("sxy") - sx * sy / rows
    least = F.lit(C.CONSTANT_BELOW_STD**2) * (rows - 1)
    names = F.array(*[F.lit(c) for c in columns])
    return merged.where((spread_a >= least) & (spread_b >= least)).select(
        names[F.col("a")].alias("sensor_a"),
        names[F.col("b")].alias("sensor_b"),
        (joint / F.sqrt(spread_a * spread_b)).alias("r"),
    )


def correlation_matrix(df: DataFrame, columns: list[str] = C.SENSORS, digits: int = 2) -> DataFrame:
    """Pearson r of the useful sensors in long form."""
    return pair_correlations(df, columns).withColumn("r", F.round("r", digits))


def correlated_pairs(matrix: DataFrame, min_r: float = 0.9) -> DataFrame:
    """Each strongly correlated pair once."""
    return matrix.where((F.col("sensor_a") < F.col("sensor_b")) & (F.abs("r") >= min_r))


def rul_correlation(
    readings: DataFrame,
    rows_per_engine: int | None = None,
    sensors: list[str] = C.SENSORS,
    digits: int = 3,
) -> DataFrame:
    """|r| of every useful sensor with remaining life, ranked, with a strength band."""
    life = lives.rul(readings.select(*C.KEYS, "cycle", *sensors), rows_per_engine)
    # At most one row per sensor from here on.
    ranked = Window.partitionBy(F.lit(1)).orderBy(F.col("abs_r").desc())
    return (
        pair_correlations(life, [*sensors, "RUL"])
        .where((F.col("sensor_b") == "RUL") & (F.col("sensor_a") != "RUL"))
        .select(F.col("sensor_a").alias("sensor_name"), F.round(F.abs("r"), digits).alias("abs_r"))
        .withColumn("strength", health.correlation_band(F.col("abs_r")))
        .withColumn("position", F.rank().over(ranked).cast("long"))
    )


def lifespan_histogram(
    engines: DataFrame, start: int = C.LIFESPAN_BIN_START, width: int = C.LIFESPAN_BIN_WIDTH
) -> DataFrame:
    """Engines per fixed-width life bin and dataset."""
    bin_index = F.floor((F.col("max_cycle") - start) / width)
    return (
        engines.groupBy("dataset", bin_index.alias("bin"))
        .agg(F.count("*").alias("engines"))
        .select(
            "dataset",
            (start + F.col("bin") * width).alias("bin_from"),
            (start + (F.col("bin") + 1) * width).alias("bin_to"),
            "engines",
        )
    )


def _span(low: Column, high: Column) -> tuple[Column, Column]:
    """Ends of a histogram; a single value gets half a unit on either side."""
    return F.when(high > low, low).otherwise(low - 0.5), F.when(high > low, high).otherwise(high + 0.5)


def _equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin of a value; the last bin is closed."""
    start, end = _span(low, high)
    return F.least(F.floor((value - start) / (end - start) * bins), F.lit(bins - 1)).cast("int")


def integer_histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width histogram of an integer column per dataset, empty bins included.

    The column is first counted by distinct value, so that the range and the
    bins come from that small table and the data are scanned once.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy("dataset", F.col(value).alias("v")).count()
    fleet = Window.partitionBy("dataset")
    binned = (
        counted.withColumn("low", F.min("v").over(fleet))
        .withColumn("high", F.max("v").over(fleet))
        .withColumn("bin", _equal_width_bin(F.col("v"), F.col("low"), F.col("high"), bins))
        .groupBy("dataset", "low", "high", "bin")
        .agg(F.sum("count").alias("n"))
    )
    # ``bins`` entries per dataset at most.
    filled = binned.groupBy("dataset", "low", "high").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found")
    )
    start, end = _span(F.col("low"), F.col("high"))
    width = (end - start) / F.lit(float(bins))
    return (
        filled.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select(
            "dataset",
            "bin",
            F.round(start + F.col("bin") * width, 4).alias("bin_from"),
            F.round(start + (F.col("bin") + 1) * width, 4).alias("bin_to"),
            F.coalesce(F.try_element_at("found", F.col("bin")), F.lit(0)).alias("n"),
        )
    )


def numeric_histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width histogram of a fractional column over the whole frame: every bin with its bounds, empty ones too.

    The range is a scalar subquery: one row, evaluated before the binning scan.
    """
    values = df.where(F.col(value).isNotNull())
    ends = values.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("ends"))
    spanned = values.withColumn("ends", ends.scalar())
    low, high = F.col("ends.low"), F.col("ends.high")
    counted = spanned.groupBy("ends", _equal_width_bin(F.col(value), low, high, bins).alias("bin")).agg(F.count("*").alias("n"))
    # ``bins`` entries at most.
    found = counted.groupBy("ends").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found"))
    start, end = _span(low, high)
    width = (end - start) / F.lit(float(bins))
    return found.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).select(
        "bin",
        (start + F.col("bin") * width).alias("bin_from"),
        (start + (F.col("bin") + 1) * width).alias("bin_to"),
        F.coalesce(F.try_element_at("found", F.col("bin")), F.lit(0)).alias("n"),
    )


def mean_life(engines: DataFrame) -> DataFrame:
    """Reference line of the life histogram."""
    return engines.groupBy("dataset").agg(F.round(F.avg("max_cycle"), 4).alias("mean_life"))


def life_stage_profile(
    readings: DataFrame,
    rows_per_engine: int | None = None,
    stages: int = C.LIFE_STAGES,
    sensors: tuple[str, ...] = C.KEY_SENSORS,
) -> DataFrame:
    """Mean sensor values per fifth of life."""
    ratio = health.cycle_ratio(F.col("cycle"), F.col("max_cycle"))
    stage = F.least(F.floor(ratio * stages), F.lit(stages - 1)).cast("int")
    return (
        lives.with_life(readings.select(*C.KEYS, "cycle", *sensors), rows_per_engine)
        .groupBy("dataset", stage.alias("life_stage"))
        .agg(F.count("*").alias("n"), *[F.round(F.avg(s), 4).alias(f"avg_{s}") for s in sensors])
    )


def sensor_trends(
    readings: DataFrame,
    engines: list[int] | None = None,
    sensors: tuple[str, ...] = C.TREND_SENSORS,
) -> DataFrame:
    """Sensor series in long form, for all engines or a chosen few."""
    rows = readings if engines is None else readings.where(F.col("engine_id").isin(engines))
    return rows.select(*C.KEYS, "cycle", *sensors).unpivot(
        [*C.KEYS, "cycle"], list(sensors), "sensor_name", "reading"
    )


def preview(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The first rows by key: a top-k, not a sort."""
    return df.orderBy(*keys).limit(n)
