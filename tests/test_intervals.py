"""Kept intervals against days, footers and the SQL surface."""

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feeds import approach, asteroid, document, land
from feedlake.operators import coverage, intervals
from feedlake.plans import jobs, surface
from feedlake.sources import footers, tables

FIRST = date(2023, 12, 20)
RANGES = "start_date date, end_date date"


def days_of(rows):
    return {a + timedelta(i) for a, b in rows if a is not None and b is not None for i in range((b - a).days + 1)}


spans = st.lists(st.tuples(st.integers(0, 60), st.integers(-1, 30)), max_size=8).map(
    lambda found: [(FIRST + timedelta(a), FIRST + timedelta(a + n)) for a, n in found]
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spans)
def test_intervals_are_the_days(spark, rows):
    found = sorted(map(tuple, intervals.merge_intervals(spark.createDataFrame(rows, RANGES)).collect()))
    assert days_of(found) == days_of(rows)
    for (_, end), (start, _) in zip(found, found[1:], strict=False):
        assert start > end + timedelta(1) or start == date(start.year, 1, 1)


def test_kept_intervals_give_the_ranges_of_days(spark, tmp_path):
    loads = [[(0, 3), (8, 8), (370, 380)], [(4, 4), (2, 6), (30, 29)], [], [(9, 400)]]
    table, seen = f"{tmp_path}/covered", []
    last = FIRST + timedelta(420)
    for load in loads:
        rows = [(FIRST + timedelta(a), FIRST + timedelta(b)) for a, b in load]
        seen += rows
        intervals.cover(spark, table, spark.createDataFrame([*rows, (None, FIRST)], RANGES))
        kept = intervals.covered(spark, table, FIRST, last)
        assert days_of(kept.collect()) == days_of(seen)
        by_days = coverage.missing_ranges(
            coverage.calendar(spark, FIRST, last), coverage.covered_days(spark.createDataFrame(seen, RANGES)), F.lit(FIRST)
        )
        assert sorted(intervals.ranges_to_request(kept, FIRST, last).collect()) == sorted(by_days.collect())
    assert intervals.ranges_to_request(kept, last, FIRST).count() == 0
    inner = (FIRST + timedelta(1), FIRST + timedelta(2))
    assert intervals.ranges_to_request(intervals.covered(spark, table, *inner), *inner).count() == 0


def test_no_intervals_yet(spark, tmp_path):
    kept = intervals.covered(spark, f"{tmp_path}/none", FIRST, FIRST + timedelta(8))
    assert [tuple(r) for r in intervals.ranges_to_request(kept, FIRST, FIRST + timedelta(8)).orderBy("start_date").collect()] == [
        ("2023-12-20", "2023-12-26"), ("2023-12-27", "2023-12-28"),
    ]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Two loads by month, with kept coverage."""
    root = str(tmp_path_factory.mktemp("lake"))
    for day in ("2025-05-01", "2025-06-10"):
        found = [asteroid(k, [approach(day, 1, kps=str(i))]) for i, k in enumerate("abc")]
        land(f"{root}/bronze", f"neo-{day}_{day}.json", document({day: found}))
        jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/rejected", f"{root}/ledger", "b", tables.MONTH, kept=f"{root}/covered")
    jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", grain=tables.MONTH)
    return root


def test_loads_keep_coverage(spark, lake):
    wanted = (date(2025, 5, 1), date(2025, 5, 9))
    listed = jobs.bronze_ranges(spark, f"{lake}/bronze", *wanted).collect()
    assert sorted(listed) == sorted(jobs.bronze_ranges(spark, f"{lake}/bronze", *wanted, kept=f"{lake}/covered").collect())
    assert len(listed) == 2


def test_footers_answer_bounds_and_counts(spark, lake):
    wanted = footers.footers(spark, f"{lake}/gold").agg(F.min("observation_date"), F.count("*"))
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(observation_date), COUNT(*)]" in plan
    assert tuple(footers.bounds(spark, f"{lake}/gold", "observation_date").head()) == (date(2025, 5, 1), date(2025, 6, 10), 6)
    counts = footers.partition_counts(spark, f"{lake}/gold", "observation_date_month").collect()
    assert sorted(map(tuple, counts)) == [(date(2025, 5, 1), 3), (date(2025, 6, 1), 3)]
    assert tuple(jobs.gold_views(spark, f"{lake}/gold", date(2025, 5, 1))["bounds"].head()) == (date(2025, 5, 1), date(2025, 6, 10))
    # the caller's settings stay
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_bounds_without_statistics(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1), (date(2025, 1, 1), 2)], "day date, part int")
    rows.write.partitionBy("part").parquet(f"{tmp_path}/t")
    assert tuple(footers.bounds(spark, f"{tmp_path}/t", "day").head()) == (date(2025, 1, 1), date(2025, 1, 1), 2)


def test_created_tables_are_counted_as_written(spark, tmp_path):
    rows = spark.createDataFrame([(date(2025, 1, i + 1), i) for i in range(7)], "day date, n int")
    assert tables.create_table(rows, f"{tmp_path}/t", "day") == 7
    assert tables.create_table(rows.limit(0), f"{tmp_path}/empty", "day") == 0


def test_sql_reads_one_partition(spark, lake):
    surface.register(spark, f"{lake}/silver", f"{lake}/gold")
    query = spark.sql("SELECT name, velocity_kps FROM velocities(DATE'2025-06-10') WHERE velocity_kps > 0")
    assert "(observation_date_month#" in (plan := query._jdf.queryExecution().executedPlan().toString()) and "2025-06-01" in plan
    assert sorted(map(tuple, query.collect())) == [("(b)", 1.0), ("(c)", 2.0)]
    assert spark.sql("SELECT count(*) FROM approaches(DATE'2025-05-01')").head()[0] == 3
    assert spark.sql("SELECT count(*) FROM miss_distances(DATE'2024-05-01')").head()[0] == 0
