"""Line deduplication against levelled sorted runs of line hashes.

The index is a list of runs. A run holds each line key once, as a 128-bit hash with the
document that owns the line, in buckets sorted by the hash. A new batch reduces its lines to
one row for each key, anti-joins them with every run (bucket by bucket, the runs are not
shuffled) and adds what is left as a run of level 0. As soon as a level holds `fanout` runs
they are merged into one run of the next level, so a batch meets at most `fanout - 1` runs a
level. No Python runs on the way.

Who owns a key: the earliest batch that has it and, within a batch, the smallest document id.
A line stays in the document that owns its key and goes everywhere else.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.common import BLANKS, Scratch, add_columns, lower_ascii

MIN_CHARS = 10
#: Documents without an id count as one document behind all others.
NO_ID = 2**63 - 1


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """`doc`, `version` (hash of the text), `pos`, `h1`, `h2` of every line with a long enough key."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("version"),
        F.posexplode(split_lines(F.col("text"))).alias("pos", "line"),
    ).withColumn("key", line_key(F.col("line")))
    return rows.filter(F.char_length("key") >= min_chars).select(
        "doc", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2")
    )


class LineRuns:
    """The levelled runs. Tables are external, below `scratch`; `close` forgets and deletes them."""

    def __init__(self, spark: SparkSession, scratch: Scratch, fanout: int = 4):
        self.spark, self.scratch, self.fanout = spark, scratch, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self._paths: dict[str, str] = {}

    def add(self, lines: DataFrame) -> None:
        """Add a batch: keys that no run has become a run of level 0."""
        fresh = lines.groupBy("h1", "h2").agg(F.min("doc").alias("doc"))
        for run in self.runs():
            fresh = fresh.join(self.spark.table(run), ["h1", "h2"], "left_anti")
        self._push(fresh, 0)

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def owners(self) -> DataFrame:
        """`h1`, `h2`, `doc` of every key seen so far."""
        tables = [self.spark.table(run) for run in self.runs()]
        rows = tables[0]
        for other in tables[1:]:
            rows = rows.unionByName(other)
        return rows

    def close(self) -> None:
        for run in list(self._paths):
            self._forget(run)
        self.levels = []

    def _push(self, rows: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._write(rows))
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            rows = self.spark.table(merged[0])
            for other in merged[1:]:
                rows = rows.unionByName(self.spark.table(other))
            self._push(rows, level + 1)
            for run in merged:
                self._forget(run)

    def _write(self, rows: DataFrame) -> str:
        name, at = f"line_run_{uuid.uuid4().hex}", self.scratch.path("run")
        laid_out = rows.select("h1", "h2", "doc").repartition(self.buckets, "h1", "h2")
        (
            laid_out.write.format("parquet")
            .bucketBy(self.buckets, "h1", "h2")
            .sortBy("h1", "h2")
            .option("path", at)
            .saveAsTable(name)
        )
        self._paths[name] = at
        return name

    def _forget(self, run: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run}")
        self.scratch.delete(self._paths.pop(run))


def dedup_lines(docs: DataFrame, batches: int = 4, fanout: int = 3, min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` without the long lines that an earlier document has, and `n_lines`, `n_dropped`.

    The documents enter the index in `batches` ranges of their id, smallest ids first, so the
    smallest id that holds a key owns it. `text` becomes the lines that stay, joined by a line
    feed; `n_lines` and `n_dropped` count lines before and dropped (long). Input columns of
    those two names are replaced, all others stay.

    NULL or empty text is one empty line, which is too short to be dropped. Rows that share a
    doc_id are one document and keep each other's lines; rows without an id are one document
    behind all others. An empty table gives an empty table.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "line-dedup")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.select(F.percentile_approx(doc, shares, 10_000)).head()[0] if shares else []
    batch = sum((F.when(F.col("doc") > c, 1).otherwise(0) for c in cuts or []), F.lit(0))
    lines = scratch.keep(hashed_lines(docs, min_chars).withColumn("batch", batch), "lines", "batch")
    runs = LineRuns(spark, scratch, fanout)
    for number in range(len(cuts or []) + 1):
        runs.add(lines.filter(F.col("batch") == number))
    dropped = (
        lines.drop("batch")
        .join(runs.owners(), ["h1", "h2", "doc"], "left_anti")
        .groupBy("doc", "version")
        .agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    )
    dropped = scratch.keep(dropped, "dropped")
    runs.close()
    scratch.drop(lines)
    rows = docs.select(F.struct("*").alias("row"), doc.alias("doc"), F.xxhash64("text").alias("version"))
    rows = rows.join(dropped, ["doc", "version"], "left").select("row", "gone", split_lines(F.col("row.text")).alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    out = rows.select(
        "row.*",
        F.when(F.col("gone").isNull(), F.coalesce("row.text", F.lit(""))).otherwise(text).alias("__text"),
        F.size("lines").cast("long").alias("__lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("__dropped"),
    )
    named = add_columns(out, text=F.col("__text"), n_lines=F.col("__lines"), n_dropped=F.col("__dropped"))
    named = named.drop("__text", "__lines", "__dropped")
    order = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return named.select(*(F.col(f"`{c}`") for c in [*order, "n_lines", "n_dropped"]))
