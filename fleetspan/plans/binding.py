"""Fleet tables, and their binding to a star-schema ``lineitem`` table.

``lineitem_fleet`` deals blocks of thirty order numbers to engines, one, two or
three blocks each, so lives differ. Every line item is a reading: its cycle is its
place in the engine's ship order, and a life is the engine's number of readings.

Readings are laid out once for an application and a state of the table: bucketed by
engine and sorted by cycle, with the life on every row. The number of buckets grows with the
rows, so that a task of a later job sorts and holds a bounded share of them. Windows, joins and latest
rows by engine then need no exchange, truncated histories are a filter, and the
longest life is a measured bound on the rows of one engine.
"""

from collections.abc import Callable
from functools import cache, cached_property
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspan import constants as C
from fleetspan.plans.shared import new_path
from fleetspan.sinks.tables import write_by_engine

MIN_TEST_CYCLES = 31
BUCKET_ROWS = 250_000
"""Readings of a bucket, about, where the session's own number of partitions would make larger ones."""


class Fleet:
    """Run-to-failure readings, their engines, truncated readings and labels.

    Each table is given as a builder and made on first use, so a query pays
    only for the tables it reads. ``rows_per_engine`` tells a bound on the readings
    of one engine, or None where there is none; history operators then count first.
    """

    def __init__(
        self,
        readings: Callable[[], DataFrame],
        engines: Callable[[], DataFrame],
        test_readings: Callable[[], DataFrame],
        labels: Callable[[], DataFrame],
        rows_per_engine: Callable[[], int | None] = lambda: None,
    ):
        self._build = {
            "rows_per_engine": rows_per_engine,
            "readings": readings,
            "engines": engines,
            "test_readings": test_readings,
            "labels": labels,
        }

    @cached_property
    def rows_per_engine(self) -> int | None:
        return self._build["rows_per_engine"]()

    @cached_property
    def readings(self) -> DataFrame:
        return self._build["readings"]()

    @cached_property
    def engines(self) -> DataFrame:
        return self._build["engines"]()

    @cached_property
    def test_readings(self) -> DataFrame:
        return self._build["test_readings"]()

    @cached_property
    def labels(self) -> DataFrame:
        return self._build["labels"]()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def state_of(spark: SparkSession, path: str) -> str:
    """Changes when the files of a table do: their names, sizes and times of writing."""
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path", "length", "modificationTime").alias("h"))
    return str(files.agg(F.sum(F.col("h").cast("decimal(38,0)"))).first()[0])


def _buckets(lineitem: DataFrame) -> int:
    placed = int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(placed, -(-lineitem.count() // BUCKET_ROWS))


@cache
def _laid_out(app: str, sf_dir: str, state: str) -> tuple[str, int]:
    """The table of all readings, each with the ``life`` of its engine, and the longest life."""
    spark = SparkSession.active()
    name = f"readings_{uuid4().hex}"
    lineitem = table(spark, sf_dir, "lineitem")
    buckets = _buckets(lineitem)
    readings = _readings(lineitem, buckets)
    longest = write_by_engine(readings, name, new_path(spark, "readings"), {"longest": F.max("life")}, buckets)["longest"]
    return name, longest or 0


def lineitem_fleet(spark: SparkSession, sf_dir: str) -> Fleet:
    lineitem = table(spark, sf_dir, "lineitem")

    def laid_out() -> tuple[DataFrame, int]:
        name, longest = _laid_out(spark.sparkContext.applicationId, sf_dir, state_of(spark, f"{sf_dir}/lineitem.parquet"))
        return spark.table(name), longest

    return Fleet(
        readings=lambda: laid_out()[0].drop("life"),
        engines=lambda: _engines(lineitem),
        test_readings=lambda: _test_readings(laid_out()[0]),
        labels=lambda: _labels(lineitem),
        rows_per_engine=lambda: laid_out()[1],
    )


def passing_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings for a query that scans them once: placed by engine in as many parts, but not laid out."""
    lineitem = table(spark, sf_dir, "lineitem")
    return _readings(lineitem, _buckets(lineitem)).drop("life")


def _dataset(engine_id):
    return F.concat(F.lit("FD00"), (1 + engine_id % 4).cast("string"))


def _engine_id() -> Column:
    """Six blocks of thirty orders make three engines: of one, two and three blocks."""
    place = "l_orderkey div 30 % 6"
    return F.expr(f"l_orderkey div 180 * 3 + CASE WHEN {place} = 0 THEN 0 WHEN {place} <= 2 THEN 1 ELSE 2 END")


def _true_rul(engine_id):
    return (7 + (engine_id * 29) % 139).cast("int")


def _readings(lineitem: DataFrame, buckets: int) -> DataFrame:
    """Narrow items are placed by engine once; cycles, lives and all columns then need no exchange."""
    items = lineitem.select(
        _engine_id().alias("engine_id"),
        "l_shipdate",
        "l_orderkey",
        "l_suppkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").alias("p"),
        F.col("l_quantity").alias("q"),
        F.col("l_discount").alias("d"),
        F.col("l_tax").alias("t"),
    ).repartition(buckets, "engine_id")
    of_engine = Window.partitionBy("engine_id")
    in_ship_order = of_engine.orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "p")
    cycles = (
        items.withColumn("cycle", F.row_number().over(in_ship_order))
        .withColumn("life", F.count("*").over(of_engine).cast("int"))
        .withColumn("c", F.col("cycle").cast("double"))
    )
    q, p, d, t, c = (F.col(name) for name in "qpdtc")

    def const(value):
        return F.lit(float(value))

    return cycles.select(
        "engine_id",
        _dataset(F.col("engine_id")).alias("dataset"),
        "cycle",
        (d - const(0.05)).alias("op_setting_1"),
        (t - const(0.04)).alias("op_setting_2"),
        const(100.0).alias("op_setting_3"),
        const(518.67).alias("sensor_1"),
        (const(641.0) + const(0.02) * q + const(0.005) * c).alias("sensor_2"),
        (const(1580.0) + const(0.2) * q + const(0.05) * c).alias("sensor_3"),
        (const(1400.0) + const(0.25) * q + const(0.06) * c).alias("sensor_4"),
        const(14.62).alias("sensor_5"),
        const(21.61).alias("sensor_6"),
        (const(554.0) - const(10.0) * d - const(0.004) * c).alias("sensor_7"),
        (const(2388.0) + t).alias("sensor_8"),
        (const(9050.0) + const(0.0002) * p).alias("sensor_9"),
        const(1.3).alias("sensor_10"),
        (const(47.2) + const(5.0) * t + const(0.002) * c).alias("sensor_11"),
        (const(521.5) - const(0.00001) * p - const(0.003) * c).alias("sensor_12"),
        (const(2388.0) + d).alias("sensor_13"),
        (const(8140.0) + const(0.0001) * p + d).alias("sensor_14"),
        (const(8.4) + d + const(0.0005) * c).alias("sensor_15"),
        const(0.03).alias("sensor_16"),
        (const(392.0) + const(0.01) * c).alias("sensor_17"),
        const(2388.0).alias("sensor_18"),
        const(100.0).alias("sensor_19"),
        (const(38.9) - t - const(0.001) * c).alias("sensor_20"),
        (const(23.3) - d - const(0.0006) * c).alias("sensor_21"),
        "life",
    )


def _engines(lineitem: DataFrame) -> DataFrame:
    """Cycles are dense from 1, so a life is the row count."""
    return (
        lineitem.groupBy(_engine_id().alias("engine_id"))
        .count()
        .select(
            "engine_id",
            _dataset(F.col("engine_id")).alias("dataset"),
            F.col("count").cast("int").alias("max_cycle"),
        )
    )


def _labels(lineitem: DataFrame) -> DataFrame:
    return (
        lineitem.select(_engine_id().alias("engine_id"))
        .distinct()
        .select(
            "engine_id",
            _dataset(F.col("engine_id")).alias("dataset"),
            _true_rul(F.col("engine_id")).alias("true_rul"),
        )
    )


def _test_readings(laid_out: DataFrame) -> DataFrame:
    """Histories cut ``true_rul`` cycles before failure."""
    last = F.greatest(F.lit(MIN_TEST_CYCLES), F.col("life") - _true_rul(F.col("engine_id")))
    return laid_out.where(F.col("cycle") <= last).drop("life")


def with_gaps(readings: DataFrame) -> DataFrame:
    """Readings with missing sensor_2 values and one column that is always null."""
    return readings.select(
        "engine_id",
        "dataset",
        "cycle",
        F.when(F.col("cycle") % 17 != 0, F.col("sensor_2")).alias("sensor_2"),
        "sensor_7",
        F.lit(None).cast("double").alias("empty_col"),
    )


def as_feed(events: DataFrame) -> DataFrame:
    """An event table as a timestamped feed: user = engine, value = remaining life."""
    return events.select(
        F.col("user_id").alias("engine_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("rul"),
    )
