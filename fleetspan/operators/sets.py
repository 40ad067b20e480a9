"""Concatenation and whole-frame helpers."""

from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenate frames by column name."""
    return reduce(DataFrame.unionByName, frames)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def keep_present(df: DataFrame, columns: list[str]) -> list[str]:
    """The wanted columns this frame has: optional columns are decided by schema."""
    return [c for c in columns if c in df.columns]


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The frame itself, or an error with a message if it is empty."""
    if df.isEmpty():
        raise ValueError(message)
    return df
