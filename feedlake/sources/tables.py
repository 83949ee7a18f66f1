"""Tables: a name in the session's catalog, or a path when the name contains a slash.

Tables are parquet, partitioned by a date column or by its month or year, and are rewritten
partition by partition: dynamic overwrite is stored as an option of the table, so no session
setting is touched. Names below another configured catalog (such as an Iceberg one) use that
catalog's own row-level commands.

The grain is chosen at creation. By day a merge rewrites least; it suits tables that hold
around a gigabyte a day or more. By month or year a sparse table does not end up in thousands
of tiny files; the partition is then a column of its own, such as `observation_date_month`.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DYNAMIC = {"partitionOverwriteMode": "dynamic"}
#: How tables and intermediate data are packed.
STORED = {"compression": "zstd"}
DAY, MONTH, YEAR = "day", "month", "year"
# Below a table: merges that are not finished, and the mark of those that can be.
MERGES, READY = "_merges", "_READY"


def is_path(table: str) -> bool:
    return "/" in table


def has_row_level_catalog(spark: SparkSession, table: str) -> bool:
    """True for catalog.namespace.table of a catalog other than the session's own."""
    parts = table.split(".")
    return (
        not is_path(table)
        and len(parts) > 2
        and parts[0] != "spark_catalog"
        and spark.conf.get(f"spark.sql.catalog.{parts[0]}", None) is not None
    )


def catalog_conf(
    catalog: str,
    warehouse: str,
    *,
    endpoint: str | None = None,
    io_impl: str | None = None,
    path_style: bool | None = None,
    credentials_provider: str | None = None,
    default: bool = False,
) -> dict[str, str]:
    """Session settings for an Iceberg catalog kept in a directory or object store.

    To be set before the session starts, with the Iceberg runtime on the class path. An object
    store is told by its endpoint, the class that reads and writes it, whether buckets stand in
    the path, and the class that finds credentials; secrets themselves never go in here.
    `default` makes the catalog the one of names without a catalog.
    """
    # fixed values: setting keys and class names of Spark, Iceberg and Hadoop
    at = f"spark.sql.catalog.{catalog}"
    settings = {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        at: "org.apache.iceberg.spark.SparkCatalog",
        f"{at}.type": "hadoop",
        f"{at}.warehouse": warehouse,
        f"{at}.io-impl": io_impl,
        f"{at}.s3.endpoint": endpoint,
        f"{at}.s3.path-style-access": None if path_style is None else str(path_style).lower(),
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": None if path_style is None else str(path_style).lower(),
        "spark.hadoop.fs.s3a.aws.credentials.provider": credentials_provider,
        "spark.sql.defaultCatalog": catalog if default else None,
    }
    return {k: v for k, v in settings.items() if v is not None}


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def open_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The table, or None when it does not exist; lists its files once.

    A merge that a crash has interrupted is finished first.
    """
    finish_merges(spark, table)
    if not is_path(table):
        return spark.table(table) if spark.catalog.tableExists(table) else None
    try:
        return spark.read.parquet(table)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table_exists(spark: SparkSession, table: str) -> bool:
    return open_table(spark, table) is not None


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table) if is_path(table) else spark.table(table)


def partition_column(partition_by: str, grain: str) -> str:
    return partition_by if grain == DAY else f"{partition_by}_{grain}"


def grain_of(columns: list[str], partition_by: str) -> str:
    """Grain of an existing table."""
    coarse = [g for g in (MONTH, YEAR) if partition_column(partition_by, g) in columns]
    return coarse[0] if coarse else DAY


def partition_value(partition_by: str, grain: str) -> Column:
    day = F.col(partition_by)
    return day if grain == DAY else F.trunc(day, grain)


def gathered(stored: DataFrame, partition_by: str, grain: str) -> bool:
    """Whether files of `stored` hold rows of few partitions each: of one more at most, on average.

    Then rows can be written where they are, and their files number as those read and the
    partitions do. One pass over the partition column.
    """
    pairs = stored.select(F.col("_metadata.file_path").alias("file"), partition_value(partition_by, grain).alias("part"))
    found = pairs.distinct().agg(F.count("*"), F.count_distinct("file"), F.count_distinct("part")).head()
    return found[0] <= 2 * max(found[1], found[2])


def _laid_out(rows: DataFrame, partition_by: str, grain: str, together: bool = False) -> DataFrame:
    """Rows brought together by partition, large ones being split into several tasks.

    Those that are `together` as it is stay in their tasks. Within a file rows are in date
    order, so that row group statistics skip by day.
    """
    if not isinstance(rows.schema[partition_by].dataType, T.DateType):
        raise TypeError(f"partition column {partition_by} must be a date")
    column = partition_column(partition_by, grain)
    rows = rows.withColumn(column, partition_value(partition_by, grain))
    rows = rows if together else rows.hint("rebalance", column)
    return rows.sortWithinPartitions(*dict.fromkeys([column, partition_by]))


def counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, counted while some later action runs over all of them.

    Read `row_count` from the observation after that action; no second job is needed. Counted
    just before a write they are exact: what a lost executor repeats of the write's own stage
    counts once.
    """
    observation = Observation(f"rows-{uuid.uuid4().hex}")
    return rows.observe(observation, F.count(F.lit(1)).alias("row_count")), observation


def create_table(
    rows: DataFrame, table: str, partition_by: str, grain: str = DAY, together: bool = False
) -> int:
    """First load; returns the number of rows, counted as they are written.

    Rows that are `together`, see `gathered`, are not exchanged.
    """
    if has_row_level_catalog(rows.sparkSession, table):
        days = {DAY: F.partitioning.days, MONTH: F.partitioning.months, YEAR: F.partitioning.years}
        rows, observation = counted(rows)
        rows.writeTo(table).partitionedBy(days[grain](partition_by)).create()
        return observation.get["row_count"]
    laid_out, observation = counted(_laid_out(rows, partition_by, grain, together))
    writer = (
        laid_out.write.format("parquet")
        .options(**DYNAMIC, **STORED)
        .partitionBy(partition_column(partition_by, grain))
    )
    if is_path(table):
        # a load without rows leaves a path without files, which still counts as absent
        writer.mode("append").save(table)
    else:
        writer.saveAsTable(table)
    return observation.get["row_count"]


def overwrite_partitions(
    rows: DataFrame, table: str, partition_by: str, grain: str = DAY, together: bool = False
) -> None:
    """Replace exactly the partitions that occur in `rows`; they may be read from the table.

    The new partitions are written whole below the table, in a folder readers skip, and marked
    ready; only then each takes the place of the old one. Whatever a crash leaves half done is
    finished by `finish_merges`, or thrown away if it never became ready, so no stored row
    depends on the increment being loaded again. One writer at a time; a reader may miss a
    partition while it is exchanged.
    """
    spark = rows.sparkSession
    staged = f"{location(spark, table)}/{MERGES}/{uuid.uuid4().hex}"
    column = partition_column(partition_by, grain)
    laid_out = _laid_out(rows, partition_by, grain, together)
    if not is_path(table):
        laid_out = laid_out.select(*spark.table(table).columns)
    laid_out.write.format("parquet").options(**STORED).partitionBy(column).save(staged)
    files, root = _folder(spark, staged)
    files.create(_child(spark, root, READY)).close()
    finish_merges(spark, table)


def finish_merges(spark: SparkSession, table: str) -> None:
    """Move the partitions of merges that were ready into the table; drop those that were not."""
    place = location(spark, table)
    if place is None:
        return
    files, root = _folder(spark, place)
    merges = _child(spark, root, MERGES)
    if not files.exists(merges):
        return
    moved = False
    for merge in list(_folders(files, merges)):
        if files.exists(_child(spark, merge, READY)):
            for part in list(_folders(files, merge)):
                target = _child(spark, root, part.getName())
                files.delete(target, True)
                if not files.rename(part, target):
                    raise OSError(f"{part} could not be moved to {target}")
                moved = True
        files.delete(merge, True)
    if moved and not is_path(table):
        spark.catalog.recoverPartitions(table)
    if moved:
        spark.catalog.refreshByPath(place)


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _child(spark: SparkSession, folder, name: str):
    # a name with a colon, as in a time, must not be taken for a scheme
    return spark._jvm.org.apache.hadoop.fs.Path(folder, f"./{name}")


def _folders(files, folder) -> Iterator:
    """The partition folders of a merge, or the merges; at most as many as the table has."""
    for status in files.listStatus(folder):
        if status.isDirectory():
            yield status.getPath()


def keep(rows: DataFrame, path: str, file_rows: int = 0) -> DataFrame:
    """`rows` written once and read back, with their schema even where there are none.

    `file_rows` is the most a file holds, if not 0.
    """
    rows.write.options(**STORED, maxRecordsPerFile=file_rows).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data."""
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def location(spark: SparkSession, table: str) -> str | None:
    """Folder of a table; None if there is none, or if another catalog keeps it."""
    if is_path(table):
        return table.rstrip("/")
    if has_row_level_catalog(spark, table) or not spark.catalog.tableExists(table):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.head().data_type.rstrip("/")


def scratch(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A fresh folder path below `root`, or the shared folder the cluster names for checkpoints.

    Where neither is given, a temporary folder takes its place on a local master; executors of
    a cluster would not share it, so there this is an error.
    """
    base = root or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="feedlake-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
