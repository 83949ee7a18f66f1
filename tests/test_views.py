from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.operators.views import (
    date_bounds,
    histogram,
    load_counts,
    miss_distances,
    velocity_histogram,
)
from feedlake.sources import tables

DAY = date(2025, 5, 1)
GOLD = "observation_date date, name string, velocity_kps double, miss_distance_ld double"


def gold(spark):
    other = date(2025, 6, 3)
    rows = [(DAY, "a", 1.0, 10.0), (DAY, "b", 11.0, 20.0), (DAY, "a", 2.5, None), (other, "c", 5.0, 1.0)]
    return spark.createDataFrame(rows, GOLD)


def counts(df):
    return [r.n for r in df.orderBy("bin").collect()]


def values(spark, numbers):
    return spark.createDataFrame([(v,) for v in numbers], "v double")


def test_bounds_and_series(spark):
    assert tuple(date_bounds(gold(spark)).head()) == (DAY, date(2025, 6, 3))
    found = miss_distances(gold(spark), DAY)
    assert found.columns == ["name", "miss_distance_ld"]
    assert sorted(map(str, map(tuple, found.collect()))) == ["('a', 10.0)", "('a', None)", "('b', 20.0)"]
    assert {(r.observation_date, r.row_count) for r in load_counts(gold(spark)).collect()} == {
        (DAY, 3), (date(2025, 6, 3), 1),
    }


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    rows, seen = tables.counted(gold(spark))
    tables.create_table(rows, f"{tmp_path}/gold", "observation_date")
    assert seen.get == {"row_count": 4}


def test_stored_views_read_only_their_partitions(spark, tmp_path):
    table = f"{tmp_path}/gold"
    days = [date(2025, m, d) for m in range(1, 7) for d in (2, 20)]
    rows = spark.createDataFrame([(d, "a", float(d.day), 1.0) for d in days], GOLD)
    tables.create_table(rows, table, "observation_date", tables.MONTH)
    stored = tables.read_table(spark, table)
    bounds = date_bounds(stored)
    assert tuple(bounds.head()) == (date(2025, 1, 2), date(2025, 6, 20))
    bounds.collect()
    plan = bounds._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((observation_date_month" in plan
    one_day = miss_distances(stored, date(2025, 3, 2))
    assert one_day.count() == 1
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(observation_date_month" in plan and "2025-03-01" in plan


def test_histogram_scans_for_its_bounds_once(spark):
    found = histogram(gold(spark), "velocity_kps")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReusedSubquery" in plan.split("Initial Plan")[0]


def test_histogram_of_one_day(spark):
    found = velocity_histogram(gold(spark), DAY)
    assert counts(found) == [1, 1, 0, 0, 0, 0, 0, 0, 0, 1]
    edges = found.orderBy("bin").collect()
    assert (edges[0].bin_start, edges[-1].bin_end) == (1.0, 11.0)
    assert velocity_histogram(gold(spark), date(2030, 1, 1)).count() == 0


def test_histogram_equals_numpy(spark):
    numbers = np.random.default_rng(7).normal(size=3000)
    assert counts(histogram(values(spark, numbers.tolist()), "v", 12)) == np.histogram(numbers, 12)[0].tolist()


@pytest.mark.parametrize(
    ("numbers", "expected"),
    [
        ([4.0, 4.0, 4.0], [3, 0, 0, 0]),
        ([0.0, 1.0, 2.0, 3.0, 4.0], [1, 1, 1, 2]),
        ([0.0, None, float("nan"), float("inf"), float("-inf"), 4.0], [1, 0, 0, 1]),
        ([None, float("nan")], []),
        ([], []),
    ],
)
def test_histogram_conventions(spark, numbers, expected):
    assert counts(histogram(values(spark, numbers), "v", 4)) == expected


def test_histogram_joins_no_rows_with_bounds(spark, sf_dir):
    from feedlake.plans.queries import histogram_all_days

    plan = histogram_all_days(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("grain", [tables.DAY, tables.MONTH, tables.YEAR])
def test_one_day_prunes_partitions(spark, tmp_path, grain):
    tables.create_table(gold(spark), f"{tmp_path}/gold", "observation_date", grain)
    stored = tables.read_table(spark, f"{tmp_path}/gold")
    found = miss_distances(stored, DAY)
    assert found.count() == 3
    scan = found._jdf.queryExecution().executedPlan().toString()
    column = tables.partition_column("observation_date", grain)
    assert f"PartitionFilters: [isnotnull({column}" in scan
    assert "velocity_kps" not in scan.split("ReadSchema")[1]
    assert found.filter(F.col("name") == "b").count() == 1
