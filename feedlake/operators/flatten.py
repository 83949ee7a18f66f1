"""Document -> day -> asteroid -> close approach: one lazy plan, no shuffle.

The three generators and all projections run in the stage that parses the documents, so the
parallelism is that of the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.convert import date_or_null, double_or_null
from feedlake.sources.schemas import (
    APPROACH_PATHS,
    ASTEROID_PATHS,
    DATE_COLUMNS,
    DISTANCE_COLUMNS,
    GOLD_COLUMNS,
    SILVER_COLUMNS,
    VELOCITY_COLUMNS,
)


def explode_days(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per day key: `observation_date` (text) and `asteroids`.

    A key given twice in one JSON object reaches Spark as two map entries; as in any JSON
    object the last one counts. The test compares the handful of keys of one document.
    """
    keys = F.reverse(F.map_keys("near_earth_objects")).alias("_keys")
    entry = F.posexplode("near_earth_objects").alias("_position", "observation_date", "asteroids")
    last = F.size("_keys") - F.array_position("_keys", F.col("observation_date"))
    # keys first: otherwise every day row would carry the whole map through the generator
    return (
        documents.select(*carry, "near_earth_objects", keys)
        .select(*carry, "_keys", entry)
        .filter(F.col("_position") == last)
        .drop("_keys", "_position")
    )


def explode_asteroids(days: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per asteroid and day; a day without asteroids disappears."""
    return days.select(*carry, "observation_date", F.explode("asteroids").alias("asteroid"))


def explode_approaches(
    asteroids: DataFrame, columns: Sequence[str] = SILVER_COLUMNS, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per close approach; an asteroid without approaches disappears."""
    fields = [
        F.col(f"asteroid.{path}").alias(name)
        for name, path in ASTEROID_PATHS.items()
        if name in columns
    ]
    return asteroids.select(
        *carry,
        "observation_date",
        *fields,
        F.explode("asteroid.close_approach_data").alias("approach"),
    )


def project_approaches(
    approaches: DataFrame, columns: Sequence[str] = SILVER_COLUMNS, carry: Sequence[str] = ()
) -> DataFrame:
    """Lift the approach's fields, in silver order; everything still as it was in the feed."""
    return approaches.select(
        *carry,
        *[
            F.col(f"approach.{APPROACH_PATHS[name]}").alias(name) if name in APPROACH_PATHS
            else F.col(name)
            for name in SILVER_COLUMNS
            if name in columns
        ],
    )


def convert_types(rows: DataFrame) -> DataFrame:
    """Text to date and double in place, NULL where the text is malformed."""
    numbers = VELOCITY_COLUMNS + DISTANCE_COLUMNS
    return rows.withColumns(
        {c: date_or_null(F.col(c)) for c in DATE_COLUMNS if c in rows.columns}
        | {c: double_or_null(F.col(c)) for c in numbers if c in rows.columns}
    )


def flatten(
    documents: DataFrame, columns: Sequence[str] = SILVER_COLUMNS, carry: Sequence[str] = ()
) -> DataFrame:
    """Valid documents to typed silver rows; `carry` names document columns to keep."""
    days = explode_days(documents, carry)
    asteroids = explode_asteroids(days, carry)
    approaches = explode_approaches(asteroids, columns, carry)
    return convert_types(project_approaches(approaches, columns, carry))


def analytics(silver: DataFrame) -> DataFrame:
    """The gold projection."""
    return silver.select(*GOLD_COLUMNS)
