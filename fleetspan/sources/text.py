"""Readers for headerless sensor text and one-column label files."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspan import constants as C
from fleetspan.functions import scalars

# ``train_FD001.txt`` may be one file or a folder of part files.
_DATASET = r"_(FD\d{3})\.txt"


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return (
        spark.read.text(paths)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
        .where(F.trim("value") != "")
    )


def _fields(line: Column) -> Column:
    """The words of a line; one with nothing but single blanks between them is split without a regular expression."""
    trimmed = F.trim(line)
    runs = reduce(or_, [F.contains(trimmed, F.lit(s)) for s in ("  ", "\t", "\n", "\x0b", "\f", "\r")])
    return F.when(runs, scalars.words(line)).otherwise(F.split(trimmed, " "))


def read_readings(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whitespace-separated sensor lines as typed columns, tagged by dataset.

    Lines are split with the file, so a large file is read by many tasks.
    Trailing blanks are ignored; a field that is no number becomes null.
    """
    cells = [
        F.try_element_at("fields", F.lit(i + 1)).try_cast(field.dataType).alias(field.name, metadata=field.metadata)
        for i, field in enumerate(C.RAW_SCHEMA.fields)
    ]
    return (
        _lines(spark, paths)
        .select(F.regexp_extract("file", _DATASET, 1).alias("dataset"), _fields(F.col("value")).alias("fields"))
        .select("dataset", *cells)
    )


def read_labels(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One true remaining life per line; the engine id is the line's position.

    Lines are numbered inside each file split, and splits are offset by the
    line counts of the splits before them, so one large file is still read in
    parallel. The offsets table has one row per split. The part files of a
    folder count as one file, in name order.
    """
    dataset = F.regexp_extract("file", _DATASET, 1).alias("dataset")
    lines = _lines(spark, paths).select(dataset, "file", "block", "value")
    in_split = Window.partitionBy("file", "block").orderBy("_arrival")
    numbered = lines.withColumn("_arrival", F.monotonically_increasing_id()).withColumn(
        "_line", F.row_number().over(in_split)
    )
    earlier = (
        Window.partitionBy("dataset").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        lines.groupBy("dataset", "file", "block")
        .agg(F.count("*").alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select("file", "block", "_offset")
    )
    return numbered.join(offsets, ["file", "block"]).select(
        "dataset",
        (F.col("_offset") + F.col("_line")).cast("int").alias("engine_id"),
        F.trim("value").try_cast("int").alias("true_rul"),
    )


def fleet_glob(folder: str, kind: str) -> str:
    """Pattern over all datasets of a kind (``train``, ``test`` or ``RUL``)."""
    return f"{folder}/{kind}_FD[0-9][0-9][0-9].txt"


def read_fleet(spark: SparkSession, folder: str, kind: str = "train") -> DataFrame:
    """All datasets found in a folder; an absent one is simply not matched."""
    reader = read_labels if kind == "RUL" else read_readings
    return reader(spark, fleet_glob(folder, kind))
