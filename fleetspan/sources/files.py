"""File inventory."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan import constants as C

EXPECTED_FILES = [
    f"{kind}_{dataset}.txt" for kind in ("train", "test", "RUL") for dataset in C.DATASETS
]


def file_inventory(
    spark: SparkSession, folder: str, expected: list[str] = EXPECTED_FILES, pattern: str = "*"
) -> DataFrame:
    """Size of each expected file, and whether it is there; contents are not read."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("size_bytes"))
    )
    wanted = spark.createDataFrame([(name,) for name in expected], "file_name string")
    return wanted.join(found, "file_name", "left").withColumn("is_found", F.col("size_bytes").isNotNull())
