"""Casts, rounding flavours, text and format helpers as column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def half_up(value: Column, digits: int = 0) -> Column:
    """SQL rounding: ties away from zero."""
    return F.round(value, digits)


def half_even(value: Column, digits: int = 0) -> Column:
    """pandas and Python rounding: ties to the even digit."""
    return F.bround(value, digits)


def truncated(value: Column, to: str = "int") -> Column:
    """Drop the fraction."""
    return value.cast(to)


def to_number(value: Column, to: str = "double") -> Column:
    """Numeric value of a text, null where the text is no number."""
    return F.trim(value.cast("string")).try_cast(to)


def to_flag(value: Column) -> Column:
    """Boolean value; null and unreadable text become false."""
    return F.coalesce(value.cast("string").try_cast("boolean"), F.lit(False))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in every float column; other columns are untouched."""
    floats = {
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, (T.DoubleType, T.FloatType))
    }
    return df.select(
        *[
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c)
            for c in df.columns
        ]
    )


def contains_any(text: Column, terms: list[str]) -> Column:
    """Case-insensitive test for any of the terms."""
    lowered = F.lower(text)
    hit = F.lit(False)
    for term in terms:
        hit = hit | lowered.contains(term.lower())
    return hit


def words(text: Column) -> Column:
    """Split on runs of whitespace, ignoring blanks at either end."""
    return F.split(F.trim(text), r"\s+")


def engine_label(engine_id: Column, status: Column) -> Column:
    return F.concat(F.lit("Engine "), engine_id.cast("string"), F.lit(" — "), status)


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def lookup(mapping: Column, key: Column, default: str = "") -> Column:
    return F.coalesce(F.try_element_at(mapping, key), F.lit(default))


# The three report time formats
STAMP_PAGE = "dd MMM yyyy, HH:mm 'UTC'"
STAMP_MAIL = "yyyy-MM-dd HH:mm"
STAMP_FILE = "yyyyMMdd_HHmm"


def stamp(pattern: str, at: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if at is None else at, pattern)
