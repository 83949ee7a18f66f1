"""Declared schema of the feed and the column lists derived from it.

The schema is a nested dict: a name maps to a type, a dict is a struct and a one-element list
an array. It is handed to Spark as a DDL string, cut down to the fields a query needs:
Catalyst does not prune fields through map -> array -> struct, so a narrow read schema is what
keeps the JSON parser from materialising unused fields.
"""

from __future__ import annotations

from collections.abc import Iterable

# Field names and types of the public feed format.
VELOCITY = {
    "kilometers_per_hour": "STRING",
    "kilometers_per_second": "STRING",
    "miles_per_hour": "STRING",
}
MISS_DISTANCE = {
    "astronomical": "STRING",
    "kilometers": "STRING",
    "lunar": "STRING",
    "miles": "STRING",
}
APPROACH = {
    "close_approach_date": "STRING",
    "close_approach_date_full": "STRING",
    "epoch_date_close_approach": "BIGINT",
    "miss_distance": MISS_DISTANCE,
    "orbiting_body": "STRING",
    "relative_velocity": VELOCITY,
}
DIAMETER_RANGE = {"estimated_diameter_min": "DOUBLE", "estimated_diameter_max": "DOUBLE"}
DIAMETER = {
    "feet": DIAMETER_RANGE,
    "kilometers": DIAMETER_RANGE,
    "meters": DIAMETER_RANGE,
    "miles": DIAMETER_RANGE,
}
ASTEROID = {
    "absolute_magnitude_h": "DOUBLE",
    "close_approach_data": [APPROACH],
    "estimated_diameter": DIAMETER,
    "id": "STRING",
    "is_potentially_hazardous_asteroid": "BOOLEAN",
    "is_sentry_object": "BOOLEAN",
    "name": "STRING",
    "nasa_jpl_url": "STRING",
    "neo_reference_id": "STRING",
    "sentry_data": "STRING",
}

# Silver column -> path below the asteroid.
ASTEROID_PATHS = {
    "asteroid_id": "id",
    "neo_reference_id": "neo_reference_id",
    "name": "name",
    "nasa_jpl_url": "nasa_jpl_url",
    "absolute_magnitude_h": "absolute_magnitude_h",
    "diameter_min_km": "estimated_diameter.kilometers.estimated_diameter_min",
    "diameter_max_km": "estimated_diameter.kilometers.estimated_diameter_max",
    "diameter_min_m": "estimated_diameter.meters.estimated_diameter_min",
    "diameter_max_m": "estimated_diameter.meters.estimated_diameter_max",
    "diameter_min_mi": "estimated_diameter.miles.estimated_diameter_min",
    "diameter_max_mi": "estimated_diameter.miles.estimated_diameter_max",
    "diameter_min_ft": "estimated_diameter.feet.estimated_diameter_min",
    "diameter_max_ft": "estimated_diameter.feet.estimated_diameter_max",
    "is_potentially_hazardous": "is_potentially_hazardous_asteroid",
    "is_sentry_object": "is_sentry_object",
}
# Silver column -> path below the close approach.
APPROACH_PATHS = {
    "close_approach_date": "close_approach_date",
    "close_approach_date_full": "close_approach_date_full",
    "epoch_date_close_approach": "epoch_date_close_approach",
    "velocity_kps": "relative_velocity.kilometers_per_second",
    "velocity_kph": "relative_velocity.kilometers_per_hour",
    "velocity_mph": "relative_velocity.miles_per_hour",
    "miss_distance_au": "miss_distance.astronomical",
    "miss_distance_ld": "miss_distance.lunar",
    "miss_distance_km": "miss_distance.kilometers",
    "miss_distance_mi": "miss_distance.miles",
    "orbiting_body": "orbiting_body",
}

# The column names of the tables.
DATE_COLUMNS = ["observation_date", "close_approach_date"]
VELOCITY_COLUMNS = ["velocity_kps", "velocity_kph", "velocity_mph"]
DISTANCE_COLUMNS = ["miss_distance_au", "miss_distance_ld", "miss_distance_km", "miss_distance_mi"]

SILVER_COLUMNS = ["observation_date", *ASTEROID_PATHS, *APPROACH_PATHS]
GOLD_COLUMNS = ["observation_date", "name", "velocity_kps", "miss_distance_ld"]

# What the silver table keeps of a row's origin, to tell which of two versions came later.
ORIGIN_COLUMNS = ["landed_at", "object_name"]

# The key two loads of the same approach share. The narrower pair (day, asteroid) does not
# identify a row: an asteroid can pass more than once a day.
FEED_KEYS = ["observation_date", "asteroid_id"]
APPROACH_KEYS = [*FEED_KEYS, "epoch_date_close_approach"]


def _ddl(spec, keep: set[str] | None, at: str = "") -> str:
    if isinstance(spec, str):
        return spec
    if isinstance(spec, list):
        return f"ARRAY<{_ddl(spec[0], keep, at)}>"
    fields = [
        f"{name}: {_ddl(inner, keep, f'{at}{name}.')}"
        for name, inner in spec.items()
        if keep is None or f"{at}{name}" in keep
    ]
    return f"STRUCT<{', '.join(fields)}>"


def feed_ddl(columns: Iterable[str] | None = None) -> str:
    """DDL type of one feed document, narrowed to what the silver `columns` need.

    The approach array itself always stays: it decides how many rows there are.
    """
    keep = None
    if columns is not None:
        wanted = set(columns)
        paths = [p for c, p in ASTEROID_PATHS.items() if c in wanted]
        paths += [f"close_approach_data.{p}" for c, p in APPROACH_PATHS.items() if c in wanted]
        if not any(p.startswith("close_approach_data.") for p in paths):
            paths.append("close_approach_data.orbiting_body")
        keep = {".".join(p.split(".")[:n]) for p in paths for n in range(1, p.count(".") + 2)}
    return (
        "STRUCT<element_count: INT, "
        f"near_earth_objects: MAP<STRING, ARRAY<{_ddl(ASTEROID, keep)}>>>"
    )
