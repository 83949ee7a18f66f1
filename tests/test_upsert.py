import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedlake.operators.newest import newest_per_key
from feedlake.operators.upsert import (
    DUPLICATE_MATCH,
    merge_into,
    merge_key_violations,
    merge_upsert,
    repeated_keys,
    upsert_table,
)
from feedlake.sources import tables

SCHEMA = "k int, a string, b string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_matched_unmatched_and_kept(spark):
    target = frame(spark, [(1, "a", "b"), (2, "a", "b")])
    source = frame(spark, [(2, "x", "y"), (3, "x", "y")])
    merged = merge_upsert(target, source, ["k"])
    assert merged.columns == ["k", "a", "b"]
    assert result(merged) == [(1, "a", "b"), (2, "x", "y"), (3, "x", "y")]


def test_columns_the_source_lacks(spark):
    target = frame(spark, [(1, "a", "b"), (2, "a", "b")])
    source = frame(spark, [("x", 2), ("x", 3)], "b string, k int")
    assert result(merge_upsert(target, source, ["k"])) == [(1, "a", "b"), (2, "a", "x"), (3, None, "x")]


def test_null_overwrites(spark):
    merged = merge_upsert(frame(spark, [(1, "a", "b")]), frame(spark, [(1, None, "y")]), ["k"])
    assert result(merged) == [(1, None, "y")]


def test_null_keys_never_match(spark):
    target = frame(spark, [(None, "a", "b"), (1, "a", "b")])
    source = frame(spark, [(None, "x", "y"), (None, "x", "y")])
    assert result(merge_upsert(target, source, ["k"])) == [
        (1, "a", "b"), (None, "a", "b"), (None, "x", "y"), (None, "x", "y"),
    ]


def test_partly_null_key(spark):
    rows = [(1, None, "b"), (1, "a", "b")]
    merged = merge_upsert(frame(spark, rows), frame(spark, [(1, None, "y"), (1, "a", "y")]), ["k", "a"])
    assert result(merged) == [(1, "a", "y"), (1, None, "b"), (1, None, "y")]


def test_key_stored_twice_is_updated_twice(spark):
    target = frame(spark, [(1, "a", "b"), (1, "c", "d")])
    assert result(merge_upsert(target, frame(spark, [(1, "x", "y")]), ["k"])) == [(1, "x", "y")] * 2


def test_two_source_rows_for_one_target_row_fail(spark):
    target = frame(spark, [(1, "a", "b")])
    source = frame(spark, [(1, "x", "y"), (1, "x", "z"), (2, "x", "y"), (2, "x", "z")])
    for action in (lambda m: m.collect(), lambda m: m.count()):
        with pytest.raises(PySparkException, match=DUPLICATE_MATCH):
            action(merge_upsert(target, source, ["k"]))
    assert [tuple(r) for r in merge_key_violations(target, source, ["k"]).collect()] == [(1, 2)]
    assert repeated_keys(source, ["k"]).count() == 2


def test_two_source_rows_for_no_target_row_are_inserted(spark):
    source = frame(spark, [(2, "x", "y"), (2, "x", "z")])
    merged = merge_upsert(frame(spark, [(1, "a", "b")]), source, ["k"])
    assert result(merged) == [(1, "a", "b"), (2, "x", "y"), (2, "x", "z")]


def test_all_columns_are_keys(spark):
    target = frame(spark, [(1, "a", "b")])
    source = frame(spark, [(1, "a", "b"), (2, "a", "b")])
    assert result(merge_upsert(target, source, ["k", "a", "b"])) == [(1, "a", "b"), (2, "a", "b")]


def test_source_takes_target_types(spark):
    source = frame(spark, [(1, "x"), (5, "y")], "k bigint, a string")
    merged = merge_upsert(frame(spark, [(1, "a", "b")]), source, ["k"])
    assert merged.schema.simpleString() == "struct<k:int,a:string,b:string>"


def test_unknown_columns_are_refused(spark):
    target = frame(spark, [(1, "a", "b")])
    with pytest.raises(ValueError, match="zz"):
        merge_upsert(target, frame(spark, [(1, "a")], "k int, zz string"), ["k"])
    with pytest.raises(ValueError, match="keys"):
        merge_upsert(target, frame(spark, [("a",)], "a string"), ["k"])


def test_no_join_pairs_all_rows(spark, sf_dir):
    from feedlake.plans.queries import upsert_merge

    plan = upsert_merge(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "FullOuter" not in plan


KEY = st.one_of(st.none(), st.integers(0, 6))
ROWS = st.lists(st.tuples(KEY, st.sampled_from(["p", "q", None])), max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=ROWS, source=ROWS)
def test_merge_equals_a_loop(spark, target, source):
    seen = set()
    source = [r for r in source if r[0] is None or not (r[0] in seen or seen.add(r[0]))]
    values = {k: v for k, v in source if k is not None}
    held = {k for k, _ in target}
    expected = [(k, values[k] if k in values else v) for k, v in target]
    expected += [(k, v) for k, v in source if k is None or k not in held]
    t, s = frame(spark, target, "k int, v string"), frame(spark, source, "k int, v string")
    once = merge_upsert(t, s, ["k"])
    assert result(once) == sorted(expected, key=str)
    keyed = s.filter("k is not null")
    twice = merge_upsert(merge_upsert(t, keyed, ["k"]), keyed, ["k"])
    assert result(twice) == result(merge_upsert(t, keyed, ["k"]))


def test_newest_per_key(spark):
    rows = [(1, "2025-01-01", "z"), (1, "2025-01-02", "a"), (1, None, "y"), (2, None, "b"), (2, None, "c")]
    df = frame(spark, rows, "k int, at string, v string")
    assert result(newest_per_key(df, ["k"], ["at"])) == [(1, "2025-01-02", "a"), (2, None, "c")]


def test_newest_combines_before_the_exchange(spark, sf_dir):
    from feedlake.plans.queries import newest_row_per_key

    plan = newest_row_per_key(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_merge_statement_is_resolved_but_needs_a_catalog_that_supports_it(spark):
    frame(spark, [(1, "a", "b")]).write.mode("overwrite").saveAsTable("plain_parquet")
    with pytest.raises(PySparkException, match="(?i)merge"):
        merge_into(frame(spark, [(1, "x", "y")]), "plain_parquet", ["k"])


def test_only_rows_of_repeated_keys_are_grouped(spark, tmp_path, monkeypatch):
    from feedlake.operators import newest

    rows = [(k, day, at, f"v{at}") for k in range(40) for day in ("x", "y") for at in range(1 + (k % 10 == 0) + (k == 0))]
    rows += [(None, "x", 1, "a"), (None, "x", 2, "b"), (7, None, 1, "c")] + [(3, "z", 5, "same")] * 2
    df = spark.createDataFrame(rows, "k int, day string, at int, v string")
    want = sorted(map(tuple, newest.newest_per_key(df, ["k", "day"], ["at"]).collect()), key=str)
    found = newest.newest_of_repeated(df, ["k", "day"], ["at"], str(tmp_path / "a"))
    assert sorted(map(tuple, found.collect()), key=str) == want
    # ten keys that repeat, and those alone
    assert spark.read.parquet(str(tmp_path / "a")).count() == 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "Union" in plan
    monkeypatch.setattr(newest, "BROADCAST_KEYS", 2)
    found = newest.newest_of_repeated(df, ["k", "day"], ["at"], str(tmp_path / "b"))
    assert sorted(map(tuple, found.collect()), key=str) == want


@pytest.mark.parametrize("ordered", [True, False])
def test_rows_dealt_by_partition_merge_like_joined_ones(spark, ordered):
    from datetime import date

    from feedlake.operators.upsert import _merge_dealt

    day = lambda n: date(2024, 1 + n % 3, 1 + n % 20)
    schema = "day date, k int, at int, v string, w string"
    # repeated and NULL keys stay as they are in the target
    rows = [(day(k), k, k % 5, f"old{k}", "w") for k in range(60)] + [(day(1), 1, 9, "again", None), (None, 2, 1, "n", "w"), (day(4), None, 1, "n", "w")] * 2
    target = frame(spark, rows, schema)
    source = frame(spark, [(day(k), k, 3, None if k % 2 else f"new{k}") for k in range(0, 120, 4)] + [(day(1), 1, 3, "new")], "day date, k int, at int, v string")
    wins = (lambda column: F.struct(column("at"))) if ordered else None
    want = merge_upsert(target, source, ["day", "k"], unique_source=True, precedence=wins)
    found = _merge_dealt(target, source, ["day", "k"], F.trunc("day", "month"), 3, 3, wins)
    assert found.columns == target.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") <= 2


def test_a_large_unique_increment_is_dealt_once(spark, tmp_path, monkeypatch):
    from datetime import date

    from feedlake.operators import upsert

    rows = [(date(2024, 1 + k % 2, 1 + k % 9), k, f"v{k}") for k in range(50)]
    whole = frame(spark, rows, "day date, k int, v string")
    upsert_table(spark, whole, f"{tmp_path}/t", ["day", "k"], "day", tables.MONTH)
    monkeypatch.setattr(upsert, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(upsert, "merge_upsert", None)
    new = whole.filter("k % 3 = 0").withColumn("v", F.lit("new"))
    load = upsert_table(spark, new, f"{tmp_path}/t", ["day", "k"], "day", unique_source=True)
    assert load.rows == 17
    stored = {r.k: r.v for r in tables.read_table(spark, f"{tmp_path}/t").collect()}
    assert stored == {k: "new" if k % 3 == 0 else f"v{k}" for k in range(50)}
