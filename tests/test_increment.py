from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feeds import approach, asteroid, document, land
from feedlake.plans import jobs, synthetic
from feedlake.sources import tables
from feedlake.sources.documents import land_documents, list_objects, read_documents
from feedlake.sources.schemas import SILVER_COLUMNS
from feedlake.streaming.increment import oldest_first, pending_objects, read_rejected

WEEK1, WEEK2 = "neo-2025-05-01_2025-05-07.json", "neo-2025-05-08_2025-05-14.json"


def week(first, *keys, kps="1"):
    return document({first: [asteroid(k, [approach(first, 1, kps)]) for k in keys]})


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.landing = f"{self.root}/bronze"
        self.label, self.ledger, self.checkpoint = "b", "ledger", "checkpoint"

    def report(self):
        return jobs.bronze_to_silver(
            self.spark, self.landing, f"{self.root}/silver", f"{self.root}/rejected",
            f"{self.root}/{self.ledger}", self.label,
        )

    def batch(self):
        return self.report().partitions

    def whole(self):
        rows = tables.read_table(self.spark, f"{self.root}/silver")
        return sorted(map(str, rows.select(*SILVER_COLUMNS).collect()))

    def stream(self, **options):
        jobs.bronze_to_silver_stream(
            self.spark, self.landing, f"{self.root}/silver", f"{self.root}/rejected",
            f"{self.root}/{self.checkpoint}", **options,
        )

    def silver(self):
        rows = tables.read_table(self.spark, f"{self.root}/silver")
        return sorted((str(r.observation_date), r.asteroid_id, r.velocity_kps) for r in rows.collect())

    def rejected(self):
        rows = read_rejected(self.spark, f"{self.root}/rejected")
        return sorted((r.status, r.document, r.asteroid_id) for r in rows.collect())


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


@pytest.mark.parametrize("way", ["batch", "stream"])
def test_increments(lake, way):
    load = getattr(lake, way)
    land(lake.landing, WEEK1, week("2025-05-01", "1", "2"))
    load()
    assert lake.silver() == [("2025-05-01", "1", 1.0), ("2025-05-01", "2", 1.0)]
    land(lake.landing, WEEK2, week("2025-05-08", "1"))
    land(lake.landing, "neo-2025-05-01_2025-05-02.json", week("2025-05-01", "2", "3", kps="9"))
    load()
    after = [
        ("2025-05-01", "1", 1.0), ("2025-05-01", "2", 9.0), ("2025-05-01", "3", 9.0), ("2025-05-08", "1", 1.0),
    ]
    assert lake.silver() == after
    load()
    assert lake.silver() == after


def test_batch_reads_pending_objects_only(lake, spark):
    land(lake.landing, WEEK1, week("2025-05-01", "1"))
    lake.batch()
    # of the same second as the first: told apart by the ledger, not by time
    land(lake.landing, WEEK2, week("2025-05-08", "1"))
    assert lake.batch() == [date(2025, 5, 8)]
    assert lake.batch() == []
    assert spark.read.parquet(f"{lake.root}/ledger").count() == 2


@pytest.mark.parametrize("way", ["batch", "stream"])
def test_rejects_are_kept_aside(lake, way):
    land(lake.landing, WEEK1, week("2025-05-01", "1"))
    land(lake.landing, WEEK2, "{broken")
    land(lake.landing, "neo-2025-05-15_2025-05-21.json", '{"element_count":0}')
    land(lake.landing, "neo-2025-05-22_2025-05-28.json", document({"someday": [asteroid("7")]}))
    getattr(lake, way)()
    assert lake.silver() == [("2025-05-01", "1", 1.0)]
    assert lake.rejected() == [
        ("malformed", "{broken", None), ("no_days", '{"element_count":0}', None), ("no_key", None, "7"),
    ]


def test_only_rejects(lake):
    land(lake.landing, WEEK1, "[]")
    lake.stream()
    assert [r[0] for r in lake.rejected()] == ["malformed"]
    land(lake.landing, WEEK2, week("2025-05-08", "1"))
    lake.stream()
    assert lake.silver() == [("2025-05-08", "1", 1.0)]
    assert len(lake.rejected()) == 1


@pytest.mark.parametrize("way", ["batch", "stream"])
def test_last_landed_wins_within_a_batch(lake, way):
    land(lake.landing, "neo-2025-05-01_2025-05-03.json", week("2025-05-01", "1", kps="5"), at=1000)
    land(lake.landing, WEEK1, week("2025-05-01", "1", kps="2"), at=1001)
    land(lake.landing, "neo-2025-05-01_2025-05-02.json", week("2025-05-01", "1", kps="8"), at=1002)
    getattr(lake, way)()
    assert lake.silver() == [("2025-05-01", "1", 8.0)]


def test_of_one_instant_the_later_end_day_wins(lake):
    for name, kps in ((WEEK1, "2"), ("neo-2025-05-01_2025-05-09.json", "9"), ("neo-2025-05-01_2025-05-02.json", "8")):
        land(lake.landing, name, week("2025-05-01", "1", kps=kps), at=1000)
    lake.stream(max_files_per_trigger=1)
    assert lake.silver() == [("2025-05-01", "1", 9.0)]


def test_older_object_loaded_later_overwrites_nothing(lake):
    land(lake.landing, WEEK1, week("2025-05-01", "1", kps="5"), at=2000)
    lake.batch()
    land(lake.landing, "neo-2025-05-01_2025-05-09.json", week("2025-05-01", "1", "2", kps="7"), at=1000)
    lake.batch()
    assert lake.silver() == [("2025-05-01", "1", 5.0), ("2025-05-01", "2", 7.0)]


@pytest.mark.parametrize("way", ["batch", "stream"])
def test_no_object_is_too_old(lake, way):
    land(lake.landing, WEEK1, week("2025-05-01", "1"), at=1_750_000_000)
    getattr(lake, way)()
    land(lake.landing, WEEK2, week("2025-05-08", "2"), at=1_750_000_000 - 9 * 86_400)
    land(lake.landing, "neo-2025-05-15_2025-05-21.json", week("2025-05-15", "3"), at=1_750_000_000 - 9 * 31_536_000)
    getattr(lake, way)()
    assert [r[1] for r in lake.silver()] == ["1", "2", "3"]


@pytest.mark.parametrize("way", ["batch", "stream"])
def test_rejects_of_all_loads_stay(lake, spark, way):
    lake.label = "same"
    for name, text in ((WEEK1, "{bad1"), (WEEK2, "{bad2")):
        land(lake.landing, name, text)
        getattr(lake, way)()
    assert [r[1] for r in lake.rejected()] == ["{bad1", "{bad2"]
    lake.ledger = lake.checkpoint = "another"
    getattr(lake, way)()
    assert [r[1] for r in lake.rejected()] == ["{bad1", "{bad2"]


@pytest.mark.parametrize("way", ["batch", "stream"])
def test_objects_of_no_bytes_are_rejected_once(lake, spark, way):
    land(lake.landing, WEEK1, week("2025-05-01", "1"))
    land(lake.landing, WEEK2, "")
    for _ in range(2):
        getattr(lake, way)()
    assert lake.rejected() == [("empty", "", None)]
    ranges = jobs.bronze_ranges(spark, lake.landing, date(2025, 5, 1), date(2025, 5, 14))
    assert ranges.count() == 0


def test_crash_between_delete_and_move_loses_nothing(lake, spark, monkeypatch):
    from feedlake.sources import tables as module

    land(lake.landing, WEEK1, week("2025-05-01", "1"))
    lake.batch()
    land(lake.landing, WEEK2, week("2025-05-01", "2"))

    with monkeypatch.context() as patch:
        patch.setattr(module, "finish_merges", lambda *a: None)
        real = module.overwrite_partitions

        def half(*args):
            real(*args)
            files, root = module._folder(spark, f"{lake.root}/silver/observation_date=2025-05-01")
            files.delete(root, True)
            raise RuntimeError("lost")

        patch.setattr(module, "overwrite_partitions", half)
        with pytest.raises(RuntimeError, match="lost"):
            lake.batch()
    lake.batch()
    assert [r[1] for r in lake.silver()] == ["1", "2"]


def test_merge_that_never_became_ready_is_dropped(lake, spark):
    land(lake.landing, WEEK1, week("2025-05-01", "1"))
    lake.batch()
    before = lake.silver()
    left = f"{lake.root}/silver/{tables.MERGES}/x/observation_date=2025-05-01"
    tables.read_table(spark, f"{lake.root}/silver").drop("observation_date").limit(0).write.parquet(left)
    tables.finish_merges(spark, f"{lake.root}/silver")
    assert lake.silver() == before
    assert not list(Path(lake.root, "silver", tables.MERGES).iterdir())


def test_only_pending_files_are_read(lake, spark):
    from feedlake.sources.documents import read_objects

    for i in range(5):
        land(lake.landing, f"neo-2025-05-0{i + 1}_2025-05-0{i + 1}.json", week(f"2025-05-0{i + 1}", "1"))
    lake.batch()
    land(lake.landing, WEEK2, week("2025-05-08", "2"), at=1000)
    objects, done = list_objects(spark, lake.landing), tables.open_table(spark, f"{lake.root}/ledger")
    documents = read_objects(pending_objects(objects, done), lake.landing)
    assert [r.object_name for r in documents.collect()] == [f"bronze/{WEEK2}"]


def test_loads_report_their_rows(lake, spark, caplog):
    land(lake.landing, WEEK1, week("2025-05-01", "1", "2"))
    assert lake.report().rows == 2
    assert "no pending objects" not in caplog.text
    assert lake.report().rows == 0
    assert "no pending objects" in caplog.text


def test_landed_files_number_as_the_ranges(spark, sf_dir, tmp_path):
    from feedlake.plans import synthetic
    from feedlake.sources.documents import land_documents

    documents = synthetic.feed_documents(spark, sf_dir).repartition(40)
    land_documents(documents, f"{tmp_path}/bronze")
    ranges = documents.select("start_date").distinct().count()
    assert list_objects(spark, f"{tmp_path}/bronze").count() <= ranges + 40


def test_gathered_documents_are_landed_where_they_are(spark, sf_dir, tmp_path):
    from feedlake.plans import synthetic
    from feedlake.sources.documents import land_documents

    documents = tables.keep(synthetic.feed_documents(spark, sf_dir), f"{tmp_path}/kept")
    land_documents(synthetic.feed_documents(spark, sf_dir), f"{tmp_path}/bronze", gathered=True)
    objects = list_objects(spark, f"{tmp_path}/bronze")
    ranges = documents.select("start_date").distinct().count()
    assert ranges <= objects.count() <= ranges + documents.count() / synthetic.TOGETHER
    assert read_documents(spark, f"{tmp_path}/bronze").count() == documents.count()


def test_failed_load_leaves_objects_pending(lake, spark, monkeypatch):
    from feedlake.streaming import increment

    land(lake.landing, WEEK1, week("2025-05-01", "1"))

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(increment, "upsert_table", fail)
        with pytest.raises(RuntimeError, match="lost"):
            lake.batch()
    assert not tables.table_exists(spark, f"{lake.root}/ledger")
    lake.batch()
    assert lake.silver() == [("2025-05-01", "1", 1.0)]


def test_stream_in_several_batches_equals_batch(spark, tmp_path):
    one, two = Lake(spark, tmp_path / "one"), Lake(spark, tmp_path / "two")
    for i in range(5):
        day = f"2025-05-{1 + 7 * (i % 4):02d}"
        for lake in (one, two):
            land(lake.landing, f"neo-{day}_2025-06-{i + 1:02d}.json", week(day, str(i), "x", kps=str(i)))
    one.stream(max_files_per_trigger=2, grain=tables.MONTH)
    two.batch()
    assert len(one.silver()) == 9
    assert one.whole() == two.whole()


def test_arrival_order_whatever_the_batch_size(spark, tmp_path):
    lakes = [Lake(spark, tmp_path / n) for n in ("batch", "whole", "single")]
    for i, end in enumerate(("09", "07", "08", "06")):
        for lake in lakes:
            land(lake.landing, f"neo-2025-05-01_2025-05-{end}.json", week("2025-05-01", str(i), "x", kps=str(i)), at=1000 + i)
        if i == 1:
            lakes[0].batch()
    lakes[0].batch()
    lakes[1].stream()
    lakes[2].stream(max_files_per_trigger=1)
    assert lakes[0].whole() == lakes[1].whole() == lakes[2].whole()
    assert ("2025-05-01", "x", 3.0) in lakes[0].silver()


def test_pending_and_order(spark, tmp_path):
    for name in (WEEK2, WEEK1):
        land(tmp_path / "bronze", name, "{}")
    objects = list_objects(spark, str(tmp_path / "bronze"))
    assert pending_objects(objects, None).count() == 2
    done = objects.filter(F.col("object_name").endswith(WEEK1))
    left = pending_objects(objects, done.union(done))
    assert left.columns == objects.columns
    assert [r.object_name for r in left.collect()] == [f"bronze/{WEEK2}"]
    times = [r.landed_at for r in oldest_first(objects).collect()]
    assert times == sorted(times)


def test_layers_end_to_end(lake, spark):
    gold = f"{lake.root}/gold"
    land(lake.landing, WEEK1, week("2025-05-01", "1", "2", kps="4"))
    ranges = jobs.bronze_ranges(spark, lake.landing, date(2025, 5, 1), date(2025, 5, 10))
    assert [tuple(r) for r in ranges.collect()] == [
        ("2025-05-08", "2025-05-10", "bronze/neo-2025-05-08_2025-05-10.json")
    ]
    assert lake.batch() is None
    assert jobs.silver_to_gold(spark, f"{lake.root}/silver", gold).partitions is None
    land(lake.landing, "neo-2025-05-08_2025-05-10.json", week("2025-05-08", "1", kps="6"))
    assert jobs.bronze_ranges(spark, lake.landing, date(2025, 5, 1), date(2025, 5, 10)).count() == 0
    touched = lake.batch()
    assert touched == [date(2025, 5, 8)]
    assert jobs.silver_to_gold(spark, f"{lake.root}/silver", gold, touched).partitions == touched
    everything = jobs.silver_to_gold(spark, f"{lake.root}/silver", gold).partitions
    assert sorted(everything) == [date(2025, 5, 1), date(2025, 5, 8)]
    views = jobs.gold_views(spark, gold, date(2025, 5, 1))
    assert tuple(views["bounds"].head()) == (date(2025, 5, 1), date(2025, 5, 8))
    assert views["miss_distances"].count() == 2
    assert sum(r.n for r in views["velocities"].collect()) == 2


def test_a_first_load_in_order_stores_its_increment_once(spark, sf_dir, tmp_path, monkeypatch):
    laid_out, kept = [], []
    monkeypatch.setattr(tables, "_laid_out", lambda rows, by, grain, together=False, own=tables._laid_out: laid_out.append(together) or own(rows, by, grain, together))
    monkeypatch.setattr(tables, "keep", lambda rows, path, *given, own=tables.keep: kept.append(path.rsplit("/", 1)[-1]) or own(rows, path, *given))
    land_documents(synthetic.feed_documents(spark, sf_dir), f"{tmp_path}/bronze", gathered=True)
    names = [f"{tmp_path}/{x}" for x in ("bronze", "silver", "rejected", "ledger")]
    assert jobs.bronze_to_silver(spark, *names, "first", tables.MONTH).rows > 5000
    assert laid_out == [True] and "staged" in kept and "increment" not in kept
