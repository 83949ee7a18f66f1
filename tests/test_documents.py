import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from feeds import asteroid, document, land
from feedlake.functions import names
from feedlake.sources.documents import (
    RejectedDocuments,
    encode_documents,
    keep_documents,
    land_documents,
    list_objects,
    parse_documents,
    read_documents,
    read_objects,
    rejected_documents,
    require_valid,
    valid_documents,
)
from feedlake.sources.schemas import SILVER_COLUMNS, feed_ddl

GOOD = document({"2025-05-01": [asteroid()]})

STATUS = [
    (GOOD, "valid"),
    ('{"near_earth_objects":{}}', "valid"),
    (' \n{"near_earth_objects":\n{}}\n', "valid"),
    ('{"near_earth_objects":{"2025-05-01":[]},"unknown":{"a":[1]}}', "valid"),
    ('{"element_count":1}', "no_days"),
    ('{"near_earth_objects":null}', "no_days"),
    ("null", "no_days"),
    ('{"near_earth_objects":[]}', "malformed"),
    ('{"near_earth_objects":"x"}', "malformed"),
    (f"[{GOOD}]", "malformed"),
    ("[]", "malformed"),
    ("5", "malformed"),
    ("", "malformed"),
    (None, "malformed"),
    (GOOD[:-5], "malformed"),
    (GOOD + " junk", "malformed"),
    (GOOD + GOOD, "malformed"),
    (f"{GOOD},{GOOD}", "malformed"),
    (GOOD + "]}", "malformed"),
    ("{'near_earth_objects':{}}", "malformed"),
    ('{"near_earth_objects":{"2025-05-01":"x"}}', "malformed"),
    (document({"2025-05-01": [asteroid(absolute_magnitude_h="big")]}), "malformed"),
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, document string")


def test_status_of_documents(spark):
    parsed = parse_documents(frame(spark, [t for t, _ in STATUS]))
    found = {r.i: r.status for r in parsed.select("i", "status").collect()}
    assert found == {i: s for i, (_, s) in enumerate(STATUS)}


def test_valid_and_rejected_are_a_partition(spark):
    parsed = parse_documents(frame(spark, [t for t, _ in STATUS]))
    rejected = {r.i: r.document for r in rejected_documents(parsed).collect()}
    assert rejected == {i: t for i, (t, s) in enumerate(STATUS) if s != "valid"}
    assert valid_documents(parsed).count() == len(STATUS) - len(rejected)


def test_strict_mode(spark):
    assert require_valid(parse_documents(frame(spark, [GOOD]))).count() == 1
    with pytest.raises(RejectedDocuments, match="malformed"):
        require_valid(parse_documents(frame(spark, [GOOD, "{"])))


def test_one_range_is_landed_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("feedlake.sources.documents.FILE_DOCUMENTS", 4)
    texts = [GOOD, "{", *(f"text {i}" for i in range(8))]
    days = [F.lit(date(2025, 5, 1)).alias(d) for d in ("start_date", "end_date")]
    land_documents(frame(spark, texts).coalesce(1).select("document", *days), str(tmp_path))
    assert len(list(tmp_path.glob("*/*.gz"))) == 3
    assert sorted(r.document for r in read_documents(spark, str(tmp_path)).collect()) == sorted(texts)


def test_whole_number_in_a_double_field(spark):
    text = document({"2025-05-01": [asteroid(absolute_magnitude_h=22)]})
    row = valid_documents(parse_documents(frame(spark, [text]))).head()
    assert row.near_earth_objects["2025-05-01"][0].absolute_magnitude_h == 22.0


def test_text_is_parsed_once(spark):
    plan = valid_documents(parse_documents(frame(spark, [GOOD])))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json(") == 1


def test_narrow_schema_has_only_the_fields_asked_for():
    ddl = feed_ddl(["name", "miss_distance_ld", "diameter_min_km"])
    assert ddl == (
        "STRUCT<element_count: INT, near_earth_objects: MAP<STRING, ARRAY<STRUCT<"
        "close_approach_data: ARRAY<STRUCT<miss_distance: STRUCT<lunar: STRING>>>, "
        "estimated_diameter: STRUCT<kilometers: STRUCT<estimated_diameter_min: DOUBLE>>, "
        "name: STRING>>>>"
    )
    assert "close_approach_data: ARRAY<STRUCT<orbiting_body: STRING>>" in feed_ddl(["name"])
    assert len(SILVER_COLUMNS) == 27


def test_full_schema_declares_every_field(spark):
    schema = spark.createDataFrame([], f"d {feed_ddl()}").schema["d"].dataType
    rock = schema["near_earth_objects"].dataType.valueType.elementType
    assert [f.name for f in schema.fields] == ["element_count", "near_earth_objects"]
    assert len(rock.fields) == 10 and rock["sentry_data"].nullable
    assert len(rock["close_approach_data"].dataType.elementType.fields) == 6


def test_landed_documents_come_back_unchanged(spark, tmp_path):
    texts = [GOOD, json.dumps(json.loads(GOOD), indent=2), "{broken\nover lines", GOOD]
    rows = [(t, "2025-05-01", "2025-05-07" if i < 3 else "2025-05-02") for i, t in enumerate(texts)]
    landed = spark.createDataFrame(rows, "document string, start_date string, end_date string").select(
        "document", F.to_date("start_date").alias("start_date"), F.to_date("end_date").alias("end_date")
    )
    landing = str(tmp_path / "bronze")
    land_documents(landed, landing)
    found = read_documents(spark, landing)
    assert sorted(r.document for r in found.collect()) == sorted(texts)
    ranges = found.select(
        names.start_of(F.col("object_name")).cast("string"), names.end_of(F.col("object_name")).cast("string")
    )
    assert sorted(map(tuple, ranges.distinct().collect())) == [
        ("2025-05-01", "2025-05-02"), ("2025-05-01", "2025-05-07"),
    ]


def test_landed_files_are_packed_and_read_by_tasks(spark, tmp_path):
    texts = [document({"2025-05-01": [asteroid()] * 40})] * 200
    landed = spark.createDataFrame([(t, "2025-05-01") for t in texts], "document string, day string").select(
        "document", F.to_date("day").alias("start_date"), F.to_date("day").alias("end_date")
    )
    landing = str(tmp_path / "bronze")
    land_documents(landed, landing)
    objects = list_objects(spark, landing)
    assert objects.agg(F.sum("length")).head()[0] < sum(map(len, texts)) / 5
    read = read_objects(objects, landing)
    assert [r.document for r in read.collect()] == texts and read.filter("error IS NOT NULL").isEmpty()


def test_kept_documents_are_not_read_in_columns(spark, tmp_path):
    rows = [(date(2025, 5, 1), None, GOOD), (None, date(2025, 5, 7), "{broken\nover lines"), (None, None, None), (None, None, "")]
    documents = spark.createDataFrame(rows, "start_date date, end_date date, document string")
    kept = keep_documents(documents, str(tmp_path / "kept"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(rows, key=str)
    assert "Batched: true" not in kept._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_objects_of_other_clients(spark, tmp_path):
    landing = tmp_path / "2020-01-01_dump" / "bronze"
    land(landing, "neo-2025-05-01_2025-05-07.json", json.dumps(json.loads(GOOD), indent=1))
    land(landing / "deep", "neo-2025-05-08_2025-05-14.json", GOOD)
    objects = list_objects(spark, str(landing))
    assert sorted(r.object_name for r in objects.collect()) == [
        "bronze/neo-2025-05-01_2025-05-07.json", "deep/neo-2025-05-08_2025-05-14.json",
    ]
    assert valid_documents(parse_documents(read_documents(spark, str(landing)))).count() == 2


def test_listing_reads_no_content(spark, tmp_path):
    land(tmp_path / "bronze", "neo-2025-05-01_2025-05-07.json", GOOD)
    plan = list_objects(spark, str(tmp_path / "bronze"))._jdf.queryExecution().executedPlan().toString()
    assert "landed_objects" in plan and "FileScan" not in plan


def test_nothing_landed_yet(spark, tmp_path):
    assert list_objects(spark, str(tmp_path / "absent")).count() == 0


def test_encoding_round_trip(spark):
    parsed = valid_documents(parse_documents(frame(spark, [GOOD])))
    again = parse_documents(encode_documents(parsed.select("i", "near_earth_objects")))
    assert again.select("near_earth_objects").head() == parsed.select("near_earth_objects").head()
