"""What several operators share: tables in the shared folder, and connected components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.sources.tables import scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The ASCII white space of the contracts: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; how rows are held out. NULL ids give NULL."""
    return F.crc32(F.col(column).cast("string")) % divisor


class Scratch:
    """Tables written to the shared folder, which cut lineage and outlive an executor.

    Each lies below one folder of its own; `drop` removes those that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self._count = spark, scratch(spark, name), 0

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{name}"

    def keep(self, rows: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """`rows` written once and read back."""
        at = self.path(name)
        writer = rows.write.partitionBy(partition_by) if partition_by else rows.write
        writer.parquet(at)
        return self.spark.read.schema(_stored_schema(rows, partition_by)).parquet(at)

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            for file in frame.inputFiles()[:1]:
                self.delete(f"{self.root}/{file.split(self.root.split(':')[-1] + '/')[-1].split('/')[0]}")

    def delete(self, path: str) -> None:
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def _stored_schema(rows: DataFrame, partition_by: str | None):
    schema = rows.schema
    if partition_by:
        kept = [f for f in schema.fields if f.name != partition_by]
        schema = type(schema)([*kept, schema[partition_by]])
    return schema


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """`node`, `component` (smallest node reachable) of every node of `edges` (a, b: long).

    Each round hooks a node to its smallest neighbour, follows the pointers to their roots by
    doubling, and replaces the end points of every edge by their roots; what lies within one
    tree disappears. Trees at least halve the number of roots that still have edges, so there
    are as many rounds as the logarithm of the largest component. Minima combine before they
    are shuffled, and the joins have plain exchanges on both sides, so that adaptive execution
    can split a hub.
    """
    spark = edges.sparkSession
    rounds: list[DataFrame] = []
    left = scratch.keep(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    while not left.isEmpty():
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        root = scratch.keep(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")),
            "hooked",
        )
        root = _to_roots(root, scratch)
        rounds.append(root)
        ends = left
        for end in ("a", "b"):
            to = root.select(F.col("node").alias(end), F.col("root").alias("to"))
            ends = ends.join(to, end).drop(end).withColumnRenamed("to", end)
        left = scratch.keep(
            ends.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
            "contracted",
        )
    if not rounds:
        return spark.createDataFrame([], "node long, component long")
    labels = rounds[0].select("node", F.col("root").alias("component"))
    for root in rounds[1:]:
        to = root.select(F.col("node").alias("component"), F.col("root").alias("to"))
        labels = labels.join(to, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
    return scratch.keep(labels, "components")


def _to_roots(pointers: DataFrame, scratch: Scratch) -> DataFrame:
    """Pointer doubling until every node points to a root."""
    while True:
        up = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
        further = pointers.join(up, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
        further = scratch.keep(further, "doubled")
        if further.filter("moved").isEmpty():
            return further.select("node", "root")
        pointers = further.select("node", "root")


def add_columns(rows: DataFrame, **columns: Column) -> DataFrame:
    """`rows` with `columns`; of equal names, whatever their case, the new column stays."""
    named = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in named]
    return rows.select(*kept, *(c.alias(name) for name, c in columns.items()))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
