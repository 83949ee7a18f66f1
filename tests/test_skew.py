"""A third of all rows under one key: the hot partition is split and results stay whole."""

import pytest
from pyspark.sql import functions as F

from feedlake.operators.flatten import flatten
from feedlake.operators.newest import newest_per_key
from feedlake.operators.upsert import merge_upsert
from feedlake.plans import synthetic
from feedlake.sources.documents import parse_documents

ROWS = 40_000


@pytest.fixture
def small_splits(spark):
    """Thresholds of adaptive execution scaled down to test data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32768",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "65536",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot(spark, share, rows=ROWS):
    key = F.when(F.col("id") % share == 0, -1).otherwise(F.col("id"))
    return spark.range(0, rows, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("unique", [True, False])
def test_hot_key_in_the_target(spark, small_splits, unique):
    target = hot(spark, 3)
    source = spark.range(-1, 2 * ROWS, 5, 4).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    merged = merge_upsert(target, source, ["k"], unique_source=unique).persist()
    known = target.select("k").distinct().join(source, "k", "left_semi").count()
    assert merged.count() == ROWS + source.count() - known
    assert merged.filter("k = -1 and v = 'new'").count() == target.filter("k = -1").count()
    assert merged.filter("v = 'new'").select("k").distinct().count() == source.count()
    merged.unpersist()
    run = merge_upsert(target, source, ["k"], unique_source=unique)
    run.collect()
    assert "SortMergeJoin(skew=true)" in final_plan(run)


def test_hot_new_key_in_the_source(spark, small_splits):
    source = hot(spark, 3)
    target = spark.range(0, ROWS, 7, 4).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    merged = merge_upsert(target, source, ["k"])
    kept = target.join(source.select("k").distinct(), "k", "left_anti").count()
    assert len(merged.collect()) == ROWS + kept
    assert "SortMergeJoin(skew=true)" in final_plan(merged)


def test_null_keys_take_part_in_no_join(spark, small_splits):
    nulled = hot(spark, 3).withColumn("k", F.expr("nullif(k, -1)"))
    merged = merge_upsert(nulled, nulled, ["k"])
    rows = merged.groupBy(F.col("k").isNull().alias("none")).count().collect()
    nulls = nulled.filter("k is null").count()
    assert {r.none: r["count"] for r in rows} == {True: 2 * nulls, False: ROWS - nulls}


def test_small_source_moves_no_target_row(spark, tmp_path):
    hot(spark, 3).write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    source = hot(spark, 10_000, 50).filter("k >= 0")
    merged = merge_upsert(target, source, ["k"], unique_source=True, small_source=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3
    assert merged.count() == ROWS + sum(i % 3 == 0 for i in range(1, 50))


def test_newest_of_a_hot_key(spark):
    newest = newest_per_key(hot(spark, 3), ["k"], ["v"])
    assert newest.count() == newest.select("k").distinct().count()
    assert newest.filter("k = -1").head().v == hot(spark, 3).filter("k = -1").agg(F.max("v")).head()[0]


def test_an_order_in_pieces_is_one_asteroid_a_day(spark, sf_dir, tmp_path):
    from feedlake.plans.queries import feed_explode_days, load_audit_counts

    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    copies = lines.limit(1).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("copy")
    lines.unionByName(copies).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = feed_explode_days(spark, str(tmp_path))
    assert found.count() == orders.count() == found.distinct().count()
    counts = load_audit_counts(spark, str(tmp_path)).agg(F.sum("row_count")).head()[0]
    assert counts == orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).count() + 3000


def test_hot_order_in_the_feed(spark, small_splits, sf_dir, tmp_path):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    copies = spark.range(0, 24_000, 1, 8).drop("id").crossJoin(lines.limit(1))
    lines.unionByName(copies).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    documents = synthetic.feed_documents(spark, str(tmp_path)).select("document")
    texts = [r.document for r in documents.collect()]
    assert "SortMergeJoin(skew=true)" in final_plan(documents)
    assert max(map(len, texts)) < 4 * synthetic.DOCUMENT_ROWS * 1000
    parsed = parse_documents(spark.createDataFrame([(t,) for t in texts], "document string"))
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).count()
    assert flatten(parsed, ["asteroid_id"]).count() == joined + 24_000

