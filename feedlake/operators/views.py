"""Dashboard queries over gold: everything is reduced before it reaches a client."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.convert import is_finite
from feedlake.sources.tables import DAY, grain_of, partition_column


def date_bounds(gold: DataFrame) -> DataFrame:
    """First and last day, the bounds of a date picker.

    Of a table partitioned by month or year only the first and last partition are read: their
    values come first, from the partition column alone.
    """
    grain = grain_of(gold.columns, "observation_date")
    if grain != DAY:
        part = partition_column("observation_date", grain)
        first, last = gold.agg(F.min(part)).scalar(), gold.agg(F.max(part)).scalar()
        gold = gold.filter((F.col(part) == first) | (F.col(part) == last))
    return gold.agg(
        F.min("observation_date").alias("first_date"), F.max("observation_date").alias("last_date")
    )


def on_date(gold: DataFrame, day: date) -> DataFrame:
    """Rows of one day; a table partitioned by a coarser grain is pruned by that as well."""
    grain = grain_of(gold.columns, "observation_date")
    rows = gold.filter(F.col("observation_date") == F.lit(day))
    if grain == DAY:
        return rows
    return rows.filter(
        F.col(partition_column("observation_date", grain)) == F.trunc(F.lit(day), grain)
    )


def miss_distances(gold: DataFrame, day: date) -> DataFrame:
    """The bar series of one day: one row per approach, not aggregated."""
    return on_date(gold, day).select("name", "miss_distance_ld")


def histogram(rows: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Exact equal-width histogram: `bin`, `bin_start`, `bin_end`, `n`.

    Bins are half-open, the last one closed; NULL, NaN and infinities are ignored; if all
    values are equal they fall into bin 0. Every bin is listed, empty ones with 0. The
    bounds are scalar subqueries of one global aggregate; counting combines map-side.
    """
    values = rows.select(F.col(column).cast("double").alias("v")).filter(is_finite(F.col("v")))
    bounds = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()

    edges = values.select("v", lo.alias("lo"), ((hi - lo) / bins).alias("w"))
    position = F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("lo"), F.col("w"))), F.lit(0))
    counted = edges.groupBy(F.least(position, F.lit(bins - 1)).alias("bin")).agg(
        F.count("*").alias("found")
    )
    skeleton = rows.sparkSession.range(bins).select(
        F.col("id").alias("bin"), lo.alias("lo"), ((hi - lo) / bins).alias("w"), hi.alias("hi")
    )
    return (
        skeleton.filter(F.col("lo").isNotNull())
        .join(counted, "bin", "left")
        .select(
            F.col("bin").cast("int"),
            (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_start"),
            F.when(F.col("bin") == bins - 1, F.col("hi"))
            .otherwise(F.col("lo") + (F.col("bin") + 1) * F.col("w"))
            .alias("bin_end"),
            F.coalesce("found", F.lit(0)).cast("bigint").alias("n"),
        )
    )


def velocity_histogram(gold: DataFrame, day: date, bins: int = 10) -> DataFrame:
    return histogram(on_date(gold, day), "velocity_kps", bins)


def load_counts(silver: DataFrame) -> DataFrame:
    """Rows per day, for the load audit."""
    return silver.groupBy("observation_date").agg(F.count("*").alias("row_count"))
