from datetime import date, timedelta

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.operators.coverage import (
    calendar,
    covered_days,
    missing_ranges,
    ranges_in_names,
    ranges_to_request,
    readable_names,
    rejected_names,
)

FIRST = date(2025, 5, 1)


def objects(spark, names):
    return spark.createDataFrame([(n,) for n in names], "object_name string")


def requested(spark, names, last, first=FIRST):
    return sorted(map(tuple, ranges_to_request(objects(spark, names), first, last).collect()))


def test_calendar(spark):
    found = [r.all_dates for r in calendar(spark, FIRST, date(2025, 5, 3)).orderBy("all_dates").collect()]
    assert found == [FIRST, date(2025, 5, 2), date(2025, 5, 3)]
    assert calendar(spark, FIRST, FIRST).count() == 1
    assert calendar(spark, FIRST, date(2025, 4, 30)).count() == 0


NAMES = {
    "bronze/neo-2025-05-01_2025-05-07.json": ("2025-05-01", "2025-05-07"),
    "2024-01-01_2024-01-02.x/neo-2025-05-01_2025-05-07.json": ("2024-01-01", "2024-01-02"),
    "bronze/neo-12025-05-01_2025-05-07.json": ("2025-05-01", "2025-05-07"),
    "bronze/neo-latest.json": None,
    "bronze/neo-2025-13-01_2025-13-07.json": None,
    "bronze/neo-2025-02-30_2025-03-02.json": None,
    "bronze/neo-2025-05-01.json": None,
    "bronze/neo-0000-05-01_0000-05-02.json": None,
    "": None,
}


def test_ranges_in_names(spark):
    ranges = ranges_in_names(objects(spark, NAMES))
    found = {
        r.object_name: (str(r.start_date), str(r.end_date)) if r.start_date else None
        for r in ranges.collect()
    }
    assert found == NAMES
    good = sum(v is not None for v in NAMES.values())
    assert readable_names(ranges).count() == good
    assert rejected_names(ranges).count() == len(NAMES) - good


def test_covered_days_repeat(spark):
    ranges = ranges_in_names(objects(spark, ["a-2025-05-01_2025-05-03.json", "a-2025-05-03_2025-05-04.json"]))
    days = [str(r.all_dates) for r in covered_days(ranges).orderBy("all_dates").collect()]
    assert days == ["2025-05-01", "2025-05-02", "2025-05-03", "2025-05-03", "2025-05-04"]


def test_reversed_range_covers_nothing(spark):
    ranges = ranges_in_names(objects(spark, ["a-2025-05-03_2025-05-01.json"]))
    assert covered_days(ranges).count() == 0


def test_nothing_covered(spark):
    assert requested(spark, [], date(2025, 5, 16)) == [
        ("2025-05-01", "2025-05-07"), ("2025-05-08", "2025-05-14"), ("2025-05-15", "2025-05-16"),
    ]


def test_all_covered(spark):
    assert requested(spark, ["neo-2025-04-01_2025-06-01.json"], date(2025, 5, 16)) == []


def test_range_is_the_hull_of_a_group(spark):
    names = ["neo-2025-05-02_2025-05-05.json", "neo-2025-05-07_2025-05-08.json"]
    assert requested(spark, names, date(2025, 5, 9)) == [
        ("2025-05-01", "2025-05-06"), ("2025-05-09", "2025-05-09"),
    ]


def test_groups_are_anchored_at_the_first_day(spark):
    assert requested(spark, ["neo-2025-05-01_2025-05-03.json"], date(2025, 5, 10)) == [
        ("2025-05-04", "2025-05-07"), ("2025-05-08", "2025-05-10"),
    ]


def test_last_before_first(spark):
    assert requested(spark, [], date(2025, 4, 1)) == []


def test_without_coverage(spark):
    found = missing_ranges(calendar(spark, FIRST, date(2025, 5, 8)), None, F.lit(FIRST)).collect()
    assert len(found) == 2


def by_hand(spans, last):
    """Group positions by 7, drop covered days, take min and max: in pandas, for comparison."""
    days = pd.Series(pd.date_range(FIRST, last).date)
    covered = {s + timedelta(i) for s, n in spans for i in range(n)}
    missing = days[~days.isin(covered)]
    return sorted(
        (min(g).isoformat(), max(g).isoformat()) for _, g in missing.groupby(missing.index // 7)
    )


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    spans=st.lists(st.tuples(st.integers(-10, 60), st.integers(1, 9)), max_size=12),
    length=st.integers(0, 55),
)
def test_ranges_equal_those_found_by_hand(spark, spans, length):
    last = FIRST + timedelta(length)
    spans = [(FIRST + timedelta(at), n) for at, n in spans]
    names = [f"neo-{s.isoformat()}_{(s + timedelta(n - 1)).isoformat()}.json" for s, n in spans]
    found = requested(spark, names, last)
    assert found == by_hand(spans, last)
    assert all((date.fromisoformat(b) - date.fromisoformat(a)).days < 7 for a, b in found)
