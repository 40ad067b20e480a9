"""Vectors as a Spark table: one row for each different vector, with the ids that have it."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(column: str):
    """Neither null nor empty nor zero, and without null or non-finite components."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(column).isNotNull() & ~bad & F.exists(column, lambda x: x != 0), F.lit(False))


def rows_of(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, vector (doubles, no negative zeros; null if unusable) and node, a hash of the vector."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    vector = F.when(usable("vector"), F.transform("vector", lambda x: x + F.lit(0.0)))
    return rows.select("vec_id", vector.alias("vector")).withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))
