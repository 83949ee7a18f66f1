"""Conversions that yield NULL on malformed text, whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_or_null(text: Column) -> Column:
    return F.try_to_date(text)


def double_or_null(text: Column) -> Column:
    return text.try_cast("double")


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def is_finite(value: Column) -> Column:
    """True for a number that is neither NULL, NaN nor infinite."""
    return F.coalesce(F.abs(value) < F.lit(float("inf")), F.lit(False))
