"""Listing, reading and loading of objects one by one."""

import gzip
import io
import os
from pathlib import Path

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feeds import approach, asteroid, document, land
from feedlake.plans import jobs
from feedlake.sources import decode, documents, objects, tables
from feedlake.sources.documents import land_objects, list_objects, read_documents, read_objects
from feedlake.streaming.increment import Bound, attempts_of, failed_objects, read_rejected, with_slices

WEEK1, WEEK2 = "neo-2025-05-01_2025-05-07.json", "neo-2025-05-08_2025-05-14.json"


def week(first, *keys, kps="1"):
    return document({first: [asteroid(k, [approach(first, 1, kps)]) for k in keys]})


def load(spark, root, **options):
    return jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/rejected", f"{root}/ledger", "b", **options)


def silver(spark, root):
    rows = tables.read_table(spark, f"{root}/silver").collect()
    return sorted((r.asteroid_id, r.velocity_kps) for r in rows)


def failures(spark, root):
    rows = failed_objects(spark, attempts_of(f"{root}/ledger")).collect()
    return sorted((Path(r.file_path).name, r.attempts) for r in rows)


@given(st.lists(st.sampled_from([b"", b"a", b"bcd", b"x" * 9]), max_size=8), st.booleans(), st.integers(1, 7), st.integers(1, 5))
def test_pieces_give_every_document_once(parts, ended, size, chunk):
    content = b"\x1e".join(parts) + (b"\x1e" if ended and parts else b"")
    wanted = content.split(b"\x1e")
    if not wanted[-1]:
        wanted.pop()
    whole = io.BytesIO(content)
    assert list(decode.records(whole.read)) == wanted
    found = []
    for start in range(0, max(len(content), 1), size):
        file = io.BytesIO(content)
        file.seek(max(start - 1, 0))
        found += decode.records(lambda _, f=file: f.read(chunk), start, size)
    assert found == wanted


def test_listing_names_every_object_once(spark, tmp_path):
    root = tmp_path / "a b%20c" / "bronze"
    for name in ("neo 1%.json", "deep/er/é+x.json", "object_name=neo-2025-05-01_2025-05-07.json/part-0"):
        land((root / name).parent, Path(name).name, "x", at=1000)
    land(root, "none.json", "")
    for name in ("_SUCCESS", ".part.crc", "_temporary/0/x", "y._COPYING_"):
        land((root / name).parent, Path(name).name, "x")
    listed = list_objects(spark, str(root))
    found = {r.file_path: (r.object_name, r.length) for r in listed.collect()}
    at = f"file:{root}"
    assert found == {
        f"{at}/neo 1%.json": ("bronze/neo 1%.json", 1),
        f"{at}/deep/er/é+x.json": ("er/é+x.json", 1),
        f"{at}/object_name=neo-2025-05-01_2025-05-07.json/part-0": ("neo-2025-05-01_2025-05-07.json/part-0", 1),
        f"{at}/none.json": ("bronze/none.json", 0),
    }
    # the reader of whole folders spells paths and times alike
    read = read_documents(spark, str(root)).select("file_path", "landed_at")
    assert read.join(listed, ["file_path", "landed_at"]).count() == 3
    assert list_objects(spark, f"file://{root}/").exceptAll(listed).count() == 0


def test_a_store_pyarrow_does_not_know(spark, tmp_path, monkeypatch):
    land(tmp_path / "bronze", WEEK1, week("2025-05-01", "1"))
    land(tmp_path / "bronze/deep", WEEK2 + ".gz", "not packed")
    land(tmp_path / "bronze", "none.json", "")
    usual = sorted(map(tuple, list_objects(spark, f"{tmp_path}/bronze").collect()))
    monkeypatch.setattr(objects, "reachable", lambda root: False)
    assert sorted(map(tuple, list_objects(spark, f"{tmp_path}/bronze").collect())) == usual
    assert list_objects(spark, f"{tmp_path}/nothing").count() == 0
    load(spark, tmp_path)
    assert silver(spark, tmp_path) == [("1", 1.0)]
    assert failures(spark, tmp_path) == [(WEEK2 + ".gz", 1)]


def test_large_objects_are_read_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "PIECE", 50)
    texts = [f"{i}:" + "é" * (i % 40) for i in range(60)]
    land(tmp_path / "bronze", "many.json", "\x1e".join(texts))
    listed = list_objects(spark, f"{tmp_path}/bronze")
    read = read_objects(listed, f"{tmp_path}/bronze")
    assert sorted(r.document for r in read.collect()) == sorted(texts)
    assert read.rdd.getNumPartitions() > 1


def test_packed_objects_and_broken_ones(spark, tmp_path):
    good = week("2025-05-01", "1")
    whole = gzip.compress("\x1e".join([good, week("2025-05-01", *map(str, range(100, 400)))]).encode())
    rows = [
        ("good.json", good.encode()), ("packed.json.gz", gzip.compress(week("2025-05-02", "2").encode())),
        ("cut.json.gz", whole[: len(whole) - 40]), ("fake.json.gz", b"{}"),
    ]
    land_objects(spark.createDataFrame(rows, "object_name string, content binary"), f"{tmp_path}/bronze")
    load(spark, tmp_path)
    # nothing of an object that is cut off, though its first document could be read
    assert silver(spark, tmp_path) == [("1", 1.0), ("2", 1.0)]
    assert failures(spark, tmp_path) == [("cut.json.gz", 1), ("fake.json.gz", 1)]
    load(spark, tmp_path)
    assert failures(spark, tmp_path) == [("cut.json.gz", 2), ("fake.json.gz", 2)]
    rejected = read_rejected(spark, f"{tmp_path}/rejected")
    assert sorted((r.status, Path(r.file_path).name) for r in rejected.collect()) == [
        ("unreadable", "cut.json.gz"), ("unreadable", "fake.json.gz"),
    ]
    (tmp_path / "bronze/cut.json.gz").write_bytes(whole)
    load(spark, tmp_path)
    assert len(silver(spark, tmp_path)) == 302
    assert failures(spark, tmp_path) == [("fake.json.gz", 3)]


def test_stream_tries_broken_objects_again(spark, tmp_path):
    def stream():
        jobs.bronze_to_silver_stream(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/rejected", f"{tmp_path}/ledger")

    land(tmp_path / "bronze", "neo.json.gz", "broken")
    land(tmp_path / "bronze", WEEK1, week("2025-05-01", "1"))
    stream()
    assert silver(spark, tmp_path) == [("1", 1.0)] and failures(spark, tmp_path) == [("neo.json.gz", 1)]
    stream()
    assert failures(spark, tmp_path) == [("neo.json.gz", 2)]
    (tmp_path / "bronze/neo.json.gz").write_bytes(gzip.compress(week("2025-05-02", "2").encode()))
    stream()
    assert silver(spark, tmp_path) == [("1", 1.0), ("2", 1.0)] and failures(spark, tmp_path) == []


def test_stream_state_does_not_grow_with_objects(spark, tmp_path):
    sizes = []
    for lake, count in (("few", 1), ("many", 200)):
        root = tmp_path / lake
        for i in range(count):
            land(root / "bronze", f"neo-2025-05-01_2025-05-01-{i}.json", week("2025-05-01", str(i)), at=1000 + i)
        jobs.bronze_to_silver_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/rejected", f"{root}/c")
        assert len(silver(spark, root)) == count
        files = [p for kind in ("offsets", "commits", "sources") for p in (root / "c").glob(f"{kind}/**/*") if p.is_file() and p.suffix != ".crc"]
        sizes.append(sum(p.stat().st_size for p in files))
    assert abs(sizes[1] - sizes[0]) < 100


@pytest.mark.parametrize("bound", [Bound(bytes=7), Bound(objects=3), Bound(bytes=10, objects=2), Bound(bytes=10**9)])
def test_slices_take_the_oldest_first(spark, tmp_path, bound):
    rows = [(f"p{i:02d}", i // 5, (i * 7) % 11) for i in range(30)]
    frame = spark.createDataFrame(rows, "file_path string, landed_at long, length long")
    found = with_slices(frame, bound, ["landed_at", "file_path"], f"{tmp_path}/w").orderBy("landed_at", "file_path").collect()
    numbers = [r.slice for r in found]
    assert numbers == sorted(numbers) and set(numbers) == set(range(numbers[-1] + 1))
    for number in set(numbers):
        own = [r.length for r in found if r.slice == number]
        assert bound.objects is None or len(own) <= bound.objects
        # but for its last object a load stays below the bound
        assert bound.bytes is None or sum(own[:-1]) < bound.bytes


def test_bounded_loads_take_failed_objects_last(spark, tmp_path):
    land(tmp_path / "bronze", "old.json.gz", "broken", at=1)
    load(spark, tmp_path)
    for i in range(5):
        land(tmp_path / "bronze", f"neo-2025-05-0{i + 1}_2025-05-0{i + 1}.json", week("2025-05-01", str(i), "x", kps=str(i)), at=1000 + i)
    seen = []
    real = documents.read_objects

    def spying(listed, landing):
        seen.append(sorted(Path(r.file_path).name for r in listed.collect()))
        return real(listed, landing)

    from feedlake.streaming import increment

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(increment, "read_objects", spying)
        load(spark, tmp_path, bound=Bound(objects=2))
    assert [len(s) for s in seen] == [2, 2, 2] and "old.json.gz" in seen[2]
    assert seen[0] == ["neo-2025-05-01_2025-05-01.json", "neo-2025-05-02_2025-05-02.json"]
    assert len(silver(spark, tmp_path)) == 6 and ("x", 4.0) in silver(spark, tmp_path)
    assert failures(spark, tmp_path) == [("old.json.gz", 2)]


def test_bounds_must_be_positive():
    with pytest.raises(ValueError, match="positive"):
        Bound(bytes=0)


def test_landing_replaces_and_packs(spark, tmp_path):
    rows = spark.createDataFrame([("x/a.json", "1"), ("b.json.gz", "2"), ("c.json", None)], "object_name string, content string")
    assert land_objects(rows, f"{tmp_path}/bronze", pack=True) == 3
    assert land_objects(rows.filter("object_name = 'x/a.json'").withColumn("content", F.lit("new")), f"{tmp_path}/bronze") == 1
    read = read_objects(list_objects(spark, f"{tmp_path}/bronze"), f"{tmp_path}/bronze").collect()
    assert sorted((os.path.basename(r.file_path), r.document) for r in read) == [("a.json", "new"), ("b.json.gz", "2")]
