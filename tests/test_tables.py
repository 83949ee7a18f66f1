from datetime import date

import pytest
from pyspark.sql import functions as F

from feedlake.operators import upsert
from feedlake.operators.upsert import _among, _row_bytes, upsert_table
from feedlake.sources import tables

ROWS = "d date, k int, v string"
D1, D2, D3 = date(2025, 5, 1), date(2025, 5, 2), date(2025, 6, 1)


def frame(spark, rows, schema=ROWS):
    return spark.createDataFrame(rows, schema)


def stored(spark, table):
    return sorted(map(str, map(tuple, tables.read_table(spark, table).select("d", "k", "v").collect())))


def files_of(spark, table, condition):
    rows = tables.read_table(spark, table).filter(condition)
    return {r[0] for r in rows.select("_metadata.file_path").distinct().collect()}


def expected(*rows):
    return sorted(map(str, rows))


@pytest.fixture(params=["path", "name"])
def table(request, spark, tmp_path):
    if request.param == "path":
        return f"{tmp_path}/t"
    space = "s" + tmp_path.name.replace("-", "_")
    tables.create_namespace(spark, space, f"{tmp_path}/space")
    tables.create_namespace(spark, space, f"{tmp_path}/space")
    return f"{space}.t"


@pytest.mark.parametrize("grain", [tables.DAY, tables.MONTH])
def test_create_then_merge_touched_partitions_only(spark, tmp_path, table, grain):
    assert not tables.table_exists(spark, table)
    first = frame(spark, [(D1, 1, "a"), (D1, 2, "a"), (D3, 1, "a"), (None, 9, "n")])
    assert upsert_table(spark, first, table, ["d", "k"], "d", grain).partitions is None
    assert tables.table_exists(spark, table)
    files = files_of(spark, table, "d = date'2025-06-01'")

    second = frame(spark, [(D1, 2, "b"), (D2, 7, "b")])
    for _ in range(2):
        touched = upsert_table(spark, second, table, ["d", "k"], "d").partitions
        assert sorted(touched) == ([D1, D2] if grain == tables.DAY else [D1])
        assert stored(spark, table) == expected(
            (D1, 1, "a"), (D1, 2, "b"), (D2, 7, "b"), (D3, 1, "a"), (None, 9, "n")
        )
    assert files_of(spark, table, "d = date'2025-06-01'") == files


def test_null_partition_is_found_again(spark, table):
    upsert_table(spark, frame(spark, [(None, 1, "a"), (D1, 1, "a")]), table, ["d", "k"], "d")
    touched = upsert_table(spark, frame(spark, [(None, 1, "b")]), table, ["d", "k"], "d").partitions
    assert touched == [None]
    assert stored(spark, table) == expected((None, 1, "a"), (None, 1, "b"), (D1, 1, "a"))


@pytest.mark.parametrize("limit", [0, 10**9])
def test_small_and_large_increments_merge_alike(spark, table, limit, monkeypatch):
    monkeypatch.setattr(upsert, "BROADCAST_BYTES", limit)
    upsert_table(spark, frame(spark, [(D1, 1, "a"), (D3, 1, "a")]), table, ["d", "k"], "d")
    upsert_table(spark, frame(spark, [(D1, 1, "b"), (D1, 2, "b")]), table, ["d", "k"], "d")
    assert stored(spark, table) == expected((D1, 1, "b"), (D1, 2, "b"), (D3, 1, "a"))


def test_size_of_rows(spark):
    rows = frame(spark, [(D1, 1, "abc"), (None, None, None)])
    assert [r[0] for r in rows.select(_row_bytes(rows)).collect()] == [51, 48]
    wide = frame(spark, [(["x" * 100],)], "a array<string>")
    assert wide.select(_row_bytes(wide)).head()[0] > 100


def test_only_a_null_partition(spark, table):
    for value in ("a", "b"):
        upsert_table(spark, frame(spark, [(None, 1, value)]), table, ["d", "k"], "d")
    assert stored(spark, table) == expected((None, 1, "a"), (None, 1, "b"))


def test_first_load_keeps_repeated_keys(spark, table):
    upsert_table(spark, frame(spark, [(D1, 1, "a"), (D1, 1, "b")]), table, ["d", "k"], "d")
    upsert_table(spark, frame(spark, [(D1, 1, "c")]), table, ["d", "k"], "d")
    assert stored(spark, table) == expected((D1, 1, "c"), (D1, 1, "c"))


def test_failed_merge_changes_nothing(spark, table):
    upsert_table(spark, frame(spark, [(D1, 1, "a")]), table, ["d", "k"], "d")
    with pytest.raises(Exception, match="more than one source row"):
        upsert_table(spark, frame(spark, [(D1, 1, "b"), (D1, 1, "c")]), table, ["d", "k"], "d")
    assert stored(spark, table) == expected((D1, 1, "a"))


def test_empty_increment(spark, table):
    upsert_table(spark, frame(spark, [(D1, 1, "a")]), table, ["d", "k"], "d")
    assert upsert_table(spark, frame(spark, []), table, ["d", "k"], "d") == upsert.Load(0, [])
    assert stored(spark, table) == expected((D1, 1, "a"))


def test_merge_reads_touched_partitions_only(spark, tmp_path):
    table = f"{tmp_path}/t"
    tables.create_table(frame(spark, [(D1, 1, "a"), (D3, 1, "a")]), table, "d")
    target = tables.read_table(spark, table).filter(_among("d", [D1]))
    scan = target._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "2025-05-01" in scan.split("PartitionFilters")[1]


def test_refusals(spark, table):
    with pytest.raises(ValueError, match="partition column"):
        upsert_table(spark, frame(spark, []), table, ["k"], "d")
    with pytest.raises(TypeError, match="date"):
        tables.create_table(frame(spark, [], "d string, k int"), table, "d")


def test_catalogs(spark):
    assert not tables.has_row_level_catalog(spark, "a.b")
    assert not tables.has_row_level_catalog(spark, "a.b.c")
    assert not tables.has_row_level_catalog(spark, "/a.b.c/d")
    assert not tables.has_row_level_catalog(spark, "spark_catalog.b.c")
    conf = tables.catalog_conf("lake", "/shared/lake")
    assert conf["spark.sql.catalog.lake.warehouse"] == "/shared/lake"
    spark.conf.set("spark.sql.catalog.lake", conf["spark.sql.catalog.lake"])
    try:
        assert tables.has_row_level_catalog(spark, "lake.b.c")
    finally:
        spark.conf.unset("spark.sql.catalog.lake")


def test_object_store_settings():
    conf = tables.catalog_conf(
        "lake", "s3://lake", endpoint="http://store:9000", io_impl="org.apache.iceberg.aws.s3.S3FileIO",
        path_style=True, credentials_provider="some.Provider", default=True,
    )
    assert conf["spark.sql.catalog.lake.s3.endpoint"] == conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.sql.catalog.lake.s3.path-style-access"] == "true"
    assert conf["spark.sql.defaultCatalog"] == "lake"
    assert not [k for k in tables.catalog_conf("lake", "/shared") if "s3" in k or "default" in k]


def test_scratch_without_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://cluster:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.scratch(Session, "x")
    assert tables.scratch(Session, "x", "/given").startswith("/given/x-")
    Session.sparkContext.master = "local[2]"
    assert "feedlake-" in tables.scratch(Session, "x")


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = tables.scratch(spark, "x"), tables.scratch(spark, "x")
    assert first.startswith(shared) and first != second


def test_rows_that_lie_together_are_not_exchanged(spark, tmp_path):
    days = spark.range(0, 800, 1, 4).select(F.date_add(F.lit(D1), (F.col("id") / 4).cast("int")).alias("d"), "id")
    days.write.parquet(f"{tmp_path}/ordered")
    days.repartition(40, "id").write.parquet(f"{tmp_path}/dealt")
    ordered, dealt = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("ordered", "dealt"))
    assert tables.gathered(ordered, "d", tables.MONTH) and not tables.gathered(dealt, "d", tables.MONTH)
    assert "Exchange" not in tables._laid_out(ordered, "d", tables.MONTH, True)._jdf.queryExecution().executedPlan().toString()
    assert tables.create_table(ordered, f"{tmp_path}/t", "d", tables.MONTH, together=True) == 800
    stored = tables.read_table(spark, f"{tmp_path}/t").select("d", "id")
    assert sorted(stored.collect()) == sorted(days.collect())
