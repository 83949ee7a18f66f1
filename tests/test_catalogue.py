"""Every registered query against DuckDB on the same files."""

import glob
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from feedlake.plans.oracles import ORACLES
from feedlake.plans.queries import CATALOGUE as QUERIES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(file).stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, oracle, sf_dir, name):
    ours = QUERIES[name](spark, sf_dir).toArrow()
    theirs = oracle.sql(ORACLES[name]).to_arrow_table()
    columns = sorted(ours.column_names)
    assert columns == sorted(theirs.column_names)
    assert [ours.schema.field(c).type for c in columns] == [theirs.schema.field(c).type for c in columns]
    assert ours.num_rows == theirs.num_rows > 0
    oracle.register("ours", ours)
    oracle.register("theirs", theirs)
    chosen = ", ".join(columns)
    for a, b in (("ours", "theirs"), ("theirs", "ours")):
        extra = f"SELECT {chosen} FROM {a} EXCEPT ALL SELECT {chosen} FROM {b}"
        assert oracle.execute(extra).fetchall() == []


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).columns == ["observation_date", "name", "velocity_kps", "miss_distance_ld"]
