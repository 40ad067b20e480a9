"""Fleet tables: creation, idempotent loading and refresh."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from fleetspan import constants as C

READING_KEYS = [*C.KEYS, "cycle"]
TABLES = {
    "engines": (C.ENGINE_SCHEMA, C.KEYS),
    "sensor_readings": (C.READING_SCHEMA, READING_KEYS),
    "rul_labels": (C.LABEL_SCHEMA, C.KEYS),
}


def create_tables(spark: SparkSession, database: str = "default", location: str | None = None) -> list[str]:
    """Create the three fleet tables where they do not exist, partitioned by dataset."""
    home = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} {home}")
    names = []
    for name, (schema, _) in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        where = f"LOCATION '{location}/{name}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet "
            f"PARTITIONED BY (dataset) {where}"
        )
        names.append(f"{database}.{name}")
    return names


def new_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks; of several with one key the smallest in the other columns."""
    rest = [c for c in source.columns if c not in keys]
    first = Window.partitionBy(*keys).orderBy(*(rest or keys))
    one = source.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") == 1).select(*source.columns)
    return one.join(target.select(*keys), keys, "left_anti")


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target after an insert in which existing keys win."""
    return target.unionByName(new_rows(target, source, keys).select(*target.columns))


def append(df: DataFrame, table: str) -> None:
    """Bulk append; loading the same rows twice stores them twice."""
    spark = df.sparkSession
    df.select(*spark.table(table).columns).write.mode("append").insertInto(table)


def append_new(df: DataFrame, table: str, keys: list[str]) -> None:
    """Append only keys the table lacks, so a repeated load changes nothing.

    Of a table partitioned by data set only the partitions that arrivals touch are read; data sets are few.
    """
    target = df.sparkSession.table(table)
    if "dataset" in keys:
        target = target.where(F.col("dataset").isin([r[0] for r in df.select("dataset").distinct().collect()]))
    append(new_rows(target, df, keys), table)


def append_counted(df: DataFrame, table: str, keys: list[str], datasets: tuple[str, ...] = C.DATASETS) -> dict[str, int]:
    """Append new keys and count the rows of each data set as they are written."""
    seen = Observation()
    target = df.sparkSession.table(table).where(F.col("dataset").isin(list(datasets)))
    counters = [F.count_if(F.col("dataset") == d).alias(d) for d in datasets]
    append(new_rows(target, df, keys).observe(seen, *counters), table)
    return seen.get


def load_fleet(
    spark: SparkSession,
    readings: DataFrame,
    engines: DataFrame,
    labels: DataFrame,
    database: str = "default",
) -> None:
    """Load all three tables idempotently."""
    for name, df in (("engines", engines), ("sensor_readings", readings), ("rul_labels", labels)):
        append_new(df, f"{database}.{name}", TABLES[name][1])


def write_readings(df: DataFrame, path: str) -> None:
    """Readings as Parquet by dataset, each file in engine and cycle order.

    Range partitioning on the full key spreads one engine's history over
    several files when it is long, and keeps footer statistics selective.
    """
    (
        df.repartitionByRange(*READING_KEYS)
        .sortWithinPartitions(*READING_KEYS)
        .write.partitionBy("dataset")
        .parquet(path)
    )


def write_by_engine(df: DataFrame, table: str, path: str, measures: dict[str, Column] | None = None, placed: int | None = None) -> dict:
    """A new table at ``path``, bucketed by engine and sorted by cycle; what is measured is taken while it is written.

    A bucket is one task of later jobs: as many as a shuffle of this session has. By the id alone, so
    that a filter on one engine reads one bucket (Spark prunes by a single column); it serves (dataset, engine) too. Rows
    that were repartitioned by ``engine_id`` into ``placed`` partitions before are written as they stand, a bucket each.
    """
    spark = df.sparkSession
    buckets = placed or int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = Observation()
    measures = {name: column.alias(name) for name, column in (measures or {"rows": F.count("*")}).items()}
    (
        (df if placed else df.repartition(buckets, "engine_id"))
        .observe(seen, *measures.values())
        .write.bucketBy(buckets, "engine_id")
        .sortBy(*C.KEYS, "cycle")
        .option("path", path)
        .saveAsTable(table)
    )
    return seen.get


def refresh(df: DataFrame, table: str, location: str) -> None:
    """Replace a table's whole contents by writing a new version and switching to it.

    ``location`` is a path not in use. Readers see the old version until the
    switch; a job that fails before it leaves the table as it was.
    """
    spark = df.sparkSession
    df.write.mode("errorifexists").parquet(location)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{location}'")


def write_observed(df: DataFrame, path: str, name: str = "load") -> dict[str, int]:
    """Write a frame and count its rows and engines during the same pass."""
    seen = Observation(name)
    watched = df.observe(
        seen, F.count("*").alias("rows"), F.approx_count_distinct("engine_id").alias("engines_approx")
    )
    watched.write.mode("overwrite").parquet(path)
    return seen.get


def load_report(
    spark: SparkSession, readings: DataFrame, engines: DataFrame, database: str, datasets: tuple[str, ...] = C.DATASETS
) -> DataFrame:
    """Load both tables; engines and readings loaded per dataset and in all, counted while they were written."""
    loaded = [
        append_counted(df, f"{database}.{name}", TABLES[name][1], datasets)
        for name, df in (("engines", engines), ("sensor_readings", readings))
    ]
    rows = [(d, *[counts[d] for counts in loaded]) for d in datasets]
    rows.append(("ALL", *[sum(counts.values()) for counts in loaded]))
    return spark.createDataFrame(rows, "dataset string, engines_loaded bigint, readings_loaded bigint")
