"""Readers for feature frames, the serving table and the column catalogue."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspan import constants as C


def read_features(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = C.FEATURE_SCHEMA
) -> DataFrame:
    """A processed feature frame, from Parquet or CSV with a header."""
    reader = spark.read if fmt == "parquet" else spark.read.schema(schema).option("header", True)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no processed features at {path}: build the feature frame first") from e
        raise


def read_serving(
    spark: SparkSession, source: str, columns: list[str] | None = None, is_table: bool = False
) -> DataFrame:
    """The serving table, reduced to some columns; one consistent snapshot, no paging."""
    df = spark.table(source) if is_table else spark.read.parquet(source)
    return df.select(*columns) if columns else df


def read_serving_jdbc(
    spark: SparkSession, url: str, table: str, low: int, high: int, partitions: int, **options: str
) -> DataFrame:
    """The serving table from a database, read in parallel ranges of engine ids."""
    return spark.read.jdbc(
        url,
        table,
        column="engine_id",
        lowerBound=low,
        upperBound=high,
        numPartitions=partitions,
        properties=options,
    )


def by_cycle_descending(df: DataFrame) -> DataFrame:
    """Newest cycles first; the engine key splits the many rows that share a cycle."""
    return df.orderBy(F.desc("cycle"), *C.KEYS)


def column_catalog(spark: SparkSession) -> DataFrame:
    """Position, name, description and unit of the raw columns."""
    schema = "position int, column_name string, description string, unit string"
    return spark.createDataFrame(list(C.COLUMN_CATALOG), schema)


def labelled(spark: SparkSession, df: DataFrame, name_column: str = "sensor_name") -> DataFrame:
    """Add description and unit to rows that name a sensor (26 catalogue rows)."""
    catalog = column_catalog(spark).withColumnRenamed("column_name", name_column)
    return df.join(F.broadcast(catalog), name_column, "left")
