"""Lenient number parsing; under ANSI mode a plain cast would fail the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_double(col: Column, default: float = 0.0) -> Column:
    """The value as double, or ``default`` for null and unparsable text."""
    return F.coalesce(col.cast("string").try_cast("double"), F.lit(default))


def digits_to_double(col: Column) -> Column:
    """Keep digits and dots only (a sign is lost), then parse."""
    return F.regexp_replace(col.cast("string"), "[^0-9.]", "").try_cast("double")


def percent_to_double(col: Column) -> Column:
    return F.replace(col.cast("string"), F.lit("%"), F.lit("")).try_cast("double")


def grouped_to_int(col: Column) -> Column:
    return F.replace(col.cast("string"), F.lit(","), F.lit("")).try_cast("int")


def clamp(col: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col))
