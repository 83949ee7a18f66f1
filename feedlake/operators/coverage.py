"""Which days are missing, and which ranges to request for them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import names
from feedlake.functions.calendar import bucket_number, days_between
from feedlake.functions.convert import iso_date

DAYS_PER_REQUEST = 7


def calendar(spark: SparkSession, first: date | Column, last: date | Column) -> DataFrame:
    """Column `all_dates` with every day from first to last; empty when last < first."""
    one = spark.range(1)
    return one.select(F.explode(days_between(_day(first), _day(last))).alias("all_dates"))


def calendar_of(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """The calendar between two columns of a frame, such as a min and a max."""
    days = days_between(F.col(first).cast("date"), F.col(last).cast("date"))
    return bounds.select(F.explode(days).alias("all_dates"))


def _day(value: date | Column) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("date")


def ranges_in_names(objects: DataFrame) -> DataFrame:
    """`object_name` -> `start_date`, `end_date`; both NULL for a name that has no range."""
    name = F.col("object_name")
    found = F.struct(names.start_of(name).alias("_start"), names.end_of(name).alias("_end"))
    readable = F.col("_start").isNotNull() & F.col("_end").isNotNull()
    # behind a generator the name is searched once, not for every later use of a date
    return objects.select("*", F.inline(F.array(found))).select(
        *objects.columns,
        F.when(readable, F.col("_start")).alias("start_date"),
        F.when(readable, F.col("_end")).alias("end_date"),
    )


def readable_names(ranges: DataFrame) -> DataFrame:
    return ranges.filter(F.col("start_date").isNotNull())


def rejected_names(ranges: DataFrame) -> DataFrame:
    return ranges.filter(F.col("start_date").isNull())


def covered_days(ranges: DataFrame) -> DataFrame:
    """Every day of every range; overlapping ranges repeat their days."""
    days = days_between(F.col("start_date"), F.col("end_date"))
    return ranges.select(F.explode(days).alias("all_dates"))


def missing_days(days: DataFrame, covered: DataFrame | None) -> DataFrame:
    """Calendar days without coverage."""
    if covered is None:
        return days
    return days.join(covered.select("all_dates").distinct(), "all_dates", "left_anti")


def missing_ranges(
    days: DataFrame, covered: DataFrame | None, first: Column, width: int = DAYS_PER_REQUEST
) -> DataFrame:
    """`start_date`, `end_date` (ISO text) of the missing days per group of `width` days.

    Groups are anchored at `first`, the earliest day, not at the first gap; a range is the
    hull of the missing days of its group, and a fully covered group has none.
    """
    return (
        missing_days(days, covered)
        .groupBy(bucket_number(F.col("all_dates"), first, width).alias("_group"))
        .agg(F.min("all_dates").alias("_first"), F.max("all_dates").alias("_last"))
        .select(iso_date(F.col("_first")).alias("start_date"), iso_date(F.col("_last")).alias("end_date"))
    )


def ranges_to_request(objects: DataFrame, earliest: date, as_of: date) -> DataFrame:
    """Landed objects (`object_name`) -> ranges still to fetch up to `as_of`, inclusive.

    Many objects share a range, so ranges are made distinct (with map-side combine) before
    they are turned into days, and are clipped to the calendar: the days exploded are
    bounded by distinct ranges times calendar length, not by the number of objects.
    """
    spark = objects.sparkSession
    ranges = readable_names(ranges_in_names(objects)).select(
        F.greatest(F.col("start_date"), F.lit(earliest)).alias("start_date"),
        F.least(F.col("end_date"), F.lit(as_of)).alias("end_date"),
    )
    covered = covered_days(ranges.distinct())
    return missing_ranges(calendar(spark, earliest, as_of), covered, F.lit(earliest))
