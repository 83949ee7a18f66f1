"""Object names carry the days a document covers: ``<prefix>-<start>_<end>.json``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions.convert import iso_date

# The start day stands before "_", the end day before ".". There is no year 0.
DAY_PATTERN = r"((?!0000)\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01]))"
START_PATTERN = DAY_PATTERN + "_"
END_PATTERN = DAY_PATTERN + r"\."


def _first_day(name: Column, pattern: str) -> Column:
    return F.try_to_date(F.regexp_extract(name, pattern, 1))


def start_of(name: Column) -> Column:
    """Start day in a name; NULL if there is none or it is no calendar day."""
    return _first_day(name, START_PATTERN)


def end_of(name: Column) -> Column:
    """End day in a name; NULL if there is none or it is no calendar day."""
    return _first_day(name, END_PATTERN)


def file_name(start: Column, end: Column, prefix: str = "neo") -> Column:
    return F.format_string(prefix + "-%s_%s.json", iso_date(start), iso_date(end))


def object_name(start: Column, end: Column, prefix: str = "neo") -> Column:
    return F.concat(F.lit("bronze/"), file_name(start, end, prefix))


def without_part(name: Column) -> Column:
    """The name without that of a part file, which the writer draws at random."""
    return F.regexp_replace(name, r"/part-[^/]*$", "")


def name_in_path(path: Column) -> Column:
    """The two last path segments, so that days in the path above them do not count.

    Covers an object of its own (``bronze/neo-<start>_<end>.json``) as well as a part file
    below a directory of that name.
    """
    return F.regexp_replace(F.substring_index(path, "/", -2), "^object_name=", "")
