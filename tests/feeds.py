"""Small hand-made feeds for the tests."""

import json
import os
from pathlib import Path


def approach(day="2025-05-01", epoch=1746057600000, kps="12.5", **changes):
    return {
        "close_approach_date": day,
        "close_approach_date_full": f"{day} 12:00",
        "epoch_date_close_approach": epoch,
        "miss_distance": {"astronomical": "0.1", "kilometers": "15000000", "lunar": "39.1", "miles": "9300000"},
        "orbiting_body": "Earth",
        "relative_velocity": {
            "kilometers_per_hour": "45000",
            "kilometers_per_second": kps,
            "miles_per_hour": "28000",
        },
    } | changes


def asteroid(key="1", approaches=None, **changes):
    size = {"estimated_diameter_min": 1.5, "estimated_diameter_max": 3.0}
    return {
        "absolute_magnitude_h": 22.1,
        "close_approach_data": [approach()] if approaches is None else approaches,
        "estimated_diameter": {u: size for u in ("feet", "kilometers", "meters", "miles")},
        "id": key,
        "is_potentially_hazardous_asteroid": False,
        "is_sentry_object": False,
        "name": f"({key})",
        "nasa_jpl_url": f"https://example.test/{key}",
        "neo_reference_id": key,
    } | changes


def document(days, **extra):
    return json.dumps({"element_count": len(days), "near_earth_objects": days} | extra)


def land(directory, name, text, at=None):
    """An object as another client would land it: one document, one file, time stamp `at`."""
    Path(directory).mkdir(parents=True, exist_ok=True)
    Path(directory, name).write_text(text, encoding="utf-8")
    if at is not None:
        os.utime(Path(directory, name), (at, at))
