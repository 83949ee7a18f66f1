"""Day arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(first: Column, last: Column) -> Column:
    """Array of all days, both ends included; NULL when last lies before first."""
    return F.when(last >= first, F.sequence(first, last, F.expr("INTERVAL 1 DAY")))


def bucket_number(day: Column, first: Column, width: int = 7) -> Column:
    """1 for the first `width` days from `first`, 2 for the next ones, and so on.

    In a gap-free calendar this equals the row position divided by the width, without
    numbering rows globally.
    """
    return (F.floor(F.datediff(day, first) / width) + 1).cast("int")
