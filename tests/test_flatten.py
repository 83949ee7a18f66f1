from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feeds import approach, asteroid, document
from feedlake.operators.flatten import analytics, explode_asteroids, explode_days, flatten
from feedlake.sources.documents import parse_documents, valid_documents
from feedlake.sources.schemas import GOLD_COLUMNS, SILVER_COLUMNS


def parsed(spark, *texts, columns=None):
    documents = spark.createDataFrame([(t,) for t in texts], "document string")
    return valid_documents(parse_documents(documents, columns))


def rows(spark, *texts):
    return flatten(parsed(spark, *texts)).collect()


def test_schema(spark):
    kinds = {f.name: f.dataType for f in flatten(parsed(spark, document({}))).schema.fields}
    assert list(kinds) == SILVER_COLUMNS
    doubles = [c for c in kinds if c.startswith(("diameter", "velocity", "miss")) or c == "absolute_magnitude_h"]
    assert {kinds[c] for c in doubles} == {T.DoubleType()}
    assert kinds["observation_date"] == kinds["close_approach_date"] == T.DateType()
    assert kinds["epoch_date_close_approach"] == T.LongType()
    assert kinds["is_sentry_object"] == kinds["is_potentially_hazardous"] == T.BooleanType()
    assert kinds["close_approach_date_full"] == T.StringType()


def test_one_row_per_approach(spark):
    text = document(
        {
            "2025-05-01": [asteroid("1", [approach(), approach(kps="3")]), asteroid("2")],
            "2025-05-02": [asteroid("1")],
        }
    )
    found = rows(spark, text, text)
    assert len(found) == 8
    row = next(r for r in found if r.asteroid_id == "1" and r.velocity_kps == 3.0)
    assert row.observation_date == date(2025, 5, 1) and row.close_approach_date == date(2025, 5, 1)
    assert (row.diameter_min_km, row.diameter_max_ft) == (1.5, 3.0)
    assert (row.miss_distance_au, row.miss_distance_ld) == (0.1, 39.1)
    assert (row.miss_distance_km, row.miss_distance_mi) == (15e6, 9.3e6)
    assert (row.velocity_kph, row.velocity_mph) == (45000.0, 28000.0)


@pytest.mark.parametrize(
    "days",
    [
        {},
        {"2025-05-01": []},
        {"2025-05-01": None},
        {"2025-05-01": [asteroid(approaches=[])]},
        {"2025-05-01": [asteroid(close_approach_data=None)]},
        {"2025-05-01": [{k: v for k, v in asteroid().items() if k != "close_approach_data"}]},
        {"2025-05-01": [None]},
    ],
)
def test_empty_levels_give_no_rows(spark, days):
    assert rows(spark, document(days)) == []


def test_absent_structs_are_null(spark):
    bare = {"close_approach_data": [{}, None]}
    found = rows(spark, document({"2025-05-01": [bare]}))
    assert len(found) == 2
    for row in found:
        assert row.observation_date == date(2025, 5, 1)
        assert set(row[1:]) == {None}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_text_becomes_null(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        bad = approach(
            day="2025-02-30",
            kps="abc",
            miss_distance={"astronomical": "", "kilometers": "1e3", "lunar": " 2 ", "miles": "NaN"},
        )
        row = rows(spark, document({"someday": [asteroid(approaches=[bad])]}))[0]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert row.observation_date is None and row.close_approach_date is None
    assert row.velocity_kps is None and row.miss_distance_au is None
    assert (row.miss_distance_km, row.miss_distance_ld) == (1000.0, 2.0)
    assert row.miss_distance_mi != row.miss_distance_mi


def test_repeated_day_key_last_one_counts(spark):
    one = document({"2025-05-01": [asteroid("old")], "2025-05-02": [asteroid("other")]})
    text = one[:-2] + ', "2025-05-01": ' + document({"x": [asteroid("new")]}).split('"x": ')[1]
    assert sorted(r.asteroid_id for r in rows(spark, text)) == ["new", "other"]


def test_narrow_read_gives_the_same_columns(spark):
    text = document({"2025-05-01": [asteroid("1"), asteroid("2", [approach(kps="x")])]})
    narrow = flatten(parsed(spark, text, columns=GOLD_COLUMNS), GOLD_COLUMNS)
    assert narrow.columns == GOLD_COLUMNS
    assert sorted(map(str, narrow.collect())) == sorted(map(str, analytics(flatten(parsed(spark, text))).collect()))


def test_row_count_is_the_sum_of_array_sizes(spark, sf_dir):
    from feedlake.plans.synthetic import feed_documents

    feed = valid_documents(parse_documents(feed_documents(spark, sf_dir)))
    asteroids = explode_asteroids(explode_days(feed))
    sizes = asteroids.agg(F.sum(F.coalesce(F.size("asteroid.close_approach_data"), F.lit(0)))).head()[0]
    assert flatten(feed).count() == sizes > 0


def test_flatten_does_not_shuffle(spark, tmp_path):
    spark.createDataFrame([(document({}),)], "document string").write.parquet(str(tmp_path / "d"))
    documents = spark.read.parquet(str(tmp_path / "d"))
    plan = flatten(valid_documents(parse_documents(documents)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "BatchEval" not in plan
    # the map of days must not travel with each of its rows
    posexplode = next(line for line in plan.splitlines() if "posexplode" in line)
    assert posexplode.count("near_earth_objects") == 1
