"""The stages and the registered queries."""

import glob
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline as pipeline
from feedlake.llm import queries

DATA = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert 0 < docs.count() <= before
        before = docs.count()
    packed = pipeline.STAGES[-1][1](spark, docs, DATA)
    assert packed.select("doc_id").distinct().count() == before


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for file in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(file).stem} AS SELECT * FROM '{file}'")
    ours, theirs = queries.QUERIES[name](spark, DATA).toArrow(), con.sql(queries.ORACLES[name]).to_arrow_table()
    columns = sorted(ours.column_names)
    assert columns == sorted(theirs.column_names)
    assert [ours.schema.field(c).type for c in columns] == [theirs.schema.field(c).type for c in columns]
    rows = lambda t: sorted(map(str, t.select(columns).to_pylist()))
    assert rows(ours) == rows(theirs) != []
