"""Counts and bounds of stored parquet tables from their file footers, without reading data.

Spark's second parquet reader pushes count, min and max into the footers; the first, which is
used elsewhere because it knows files' origins, does not. The two settings that choose it are
made in a session of their own, so the caller's stay as they are.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.sources import tables

# fixed values: settings of Spark
SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footers(spark: SparkSession, table: str) -> DataFrame:
    """The table as the pushing reader sees it, in a session of its own; aggregates over it of
    count, min and max, by its partition column or over all, read footers only."""
    session = spark.newSession()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    return session.read.parquet(tables.location(spark, table))


def bounds(spark: SparkSession, table: str, column: str) -> DataFrame:
    """One row: `first` and `last` value of a data column, and `row_count`.

    Files without statistics of the column, as those that hold NULL only, cannot be answered
    from footers; then the column is read.
    """
    wanted = [F.min(column).alias("first"), F.max(column).alias("last"), F.count("*").alias("row_count")]
    schema = tables.read_table(spark, table).agg(*wanted).schema
    try:
        row = footers(spark, table).agg(*wanted).head()
    except (PySparkException, Py4JJavaError):
        row = tables.read_table(spark, table).agg(*wanted).head()
    return spark.createDataFrame([row], schema)


def partition_counts(spark: SparkSession, table: str, partition: str) -> DataFrame:
    """`partition`, `row_count` of every partition; as many rows as there are partitions.

    Rows come to the driver, which has listed as many folders to plan the query.
    """
    counted = footers(spark, table).groupBy(partition).agg(F.count("*").alias("row_count"))
    kind = tables.read_table(spark, table).schema[partition].dataType.simpleString()
    return spark.createDataFrame(counted.collect(), f"`{partition}` {kind}, row_count BIGINT")
