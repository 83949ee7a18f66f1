"""Feed documents: landing, listing, reading and validating.

A landed object is a text file holding one document, or several ended by the ASCII record
separator. That character can never stand raw inside JSON, so one reader serves both
layouts, documents may contain line breaks, and large plain files of many documents stay
splittable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import names
from feedlake.sources import decode, objects
from feedlake.sources.schemas import feed_ddl

RECORD_SEPARATOR, FIELD_SEPARATOR = "\u001e", "\u001f"
VALID, MALFORMED, NO_DAYS, EMPTY, UNREADABLE = "valid", "malformed", "no_days", "empty", "unreadable"
#: Bytes of an object read in one piece; a piece goes on to the end of its last document.
PIECE = 64 * 1024 * 1024
#: Names of packed objects, which are read whole.
PACKED = r"\.(gz|bz2|zst|lz4)$"
#: Bytes of text that a byte of a packed object stands for, where reading is dealt to tasks.
UNPACKED = 8
#: Documents of a packed file at most, as one task reads it whole.
FILE_DOCUMENTS = 1 << 16
#: How text files are packed; the fastest level would halve the time for a third more bytes.
GZIP = {"compression": "gzip"}
ORIGIN = ["file_path", "object_name", "landed_at"]
READ = "file_path STRING, object_name STRING, landed_at TIMESTAMP, document STRING, error STRING"


class RejectedDocuments(ValueError):
    """Raised in strict mode when a document does not have the structure of the feed."""


def land_documents(documents: DataFrame, landing: str, prefix: str = "neo", gathered: bool = False) -> None:
    """Append raw documents (`document`, `start_date`, `end_date`) unchanged.

    Files are packed, which JSON shrinks much by; every reader here unpacks them, each file in
    one task, so a file holds FILE_DOCUMENTS at most.

    The range goes into the directory name, in the form objects landed by others use for
    their file name, so one parser serves both. Rows are brought together by range first, small
    ranges sharing a task and large ones split by adaptive execution, so files number as the
    ranges and the bytes ask for and not as tasks times ranges. `gathered` tells that few tasks
    hold documents of one range as it is; then they are written where they are.
    """
    rows = documents.select(
        F.col("document").alias("value"),
        names.file_name(F.col("start_date"), F.col("end_date"), prefix).alias("object_name"),
    )
    (
        (rows if gathered else rows.hint("rebalance", "object_name"))
        .write.mode("append")
        .partitionBy("object_name")
        .option("lineSep", RECORD_SEPARATOR)
        .option("maxRecordsPerFile", FILE_DOCUMENTS)
        .options(**GZIP)
        .text(landing)
    )


def keep_documents(documents: DataFrame, path: str) -> DataFrame:
    """`start_date`, `end_date`, `document` written once and read back, row by row.

    Columnar readers take thousands of rows at once, of documents more than a task's memory holds.
    """
    days = ["start_date", "end_date"]
    line = F.concat_ws(FIELD_SEPARATOR, *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in days), "document")
    documents.select(line).write.option("lineSep", RECORD_SEPARATOR).options(**GZIP).text(path)
    fields = F.split("value", FIELD_SEPARATOR, 3)
    lines = documents.sparkSession.read.option("lineSep", RECORD_SEPARATOR).text(path).select(fields.alias("fields"))
    return lines.select(
        *(F.nullif(F.col("fields")[n], F.lit("")).cast("date").alias(c) for n, c in enumerate(days)),
        F.get("fields", F.lit(2)).alias("document"),
    )


def land_objects(contents: DataFrame, landing: str, pack: bool = False) -> int:
    """Put every row as an object of its own: `object_name` (below `landing`), `content`.

    Bytes land unchanged, or packed as the name says with `pack`; an object of that name is
    replaced. Tasks write, so contents never pass through the driver. Returns their number.
    """
    spark = contents.sparkSession
    root = objects.qualified(spark, landing)
    if not objects.reachable(root):
        raise ValueError(f"objects cannot be put into {root} one by one; use land_documents")
    rows = contents.select("object_name", F.col("content").cast("binary").alias("content"))
    if pack:
        rows = rows.mapInArrow(decode.packer(), "object_name STRING, content BINARY")
    return rows.mapInArrow(decode.writer(root), "object_name STRING").count()


def list_objects(spark: SparkSession, landing: str) -> DataFrame:
    """All objects below a directory: `file_path`, `object_name`, `landed_at`, `length`.

    Listed in tasks, empty objects included; no content is read. A directory that does not
    exist yet holds no objects.
    """
    return named(objects.listing(spark, landing))


def stream_objects(spark: SparkSession, landing: str, settle: float = objects.SETTLE) -> DataFrame:
    """The same as a stream of arrivals; a replaced object arrives again."""
    return named(objects.arrivals(spark, landing, settle))


def named(listed: DataFrame) -> DataFrame:
    path = F.col("file_path")
    return listed.select(path, names.name_in_path(path).alias("object_name"), "landed_at", "length")


def read_objects(listed: DataFrame, landing: str) -> DataFrame:
    """Documents of listed objects: `document`, `file_path`, `object_name`, `landed_at`, `error`.

    Objects are dealt to tasks in pieces of PIECE bytes, by count and bytes, and opened there, so
    neither their names pass through the driver nor does one large object go into one task. Tasks
    take ranges of names, in order, so a task's documents are of few days where names tell these.
    What cannot be opened or unpacked gives a row with `error` in place of its remaining
    documents, and no other object is touched by that. Documents of such an object may stand
    among the rows as well; leave them out by `file_path`.
    """
    spark = listed.sparkSession
    root = objects.qualified(spark, landing)
    if not objects.reachable(root):
        return _read_by_spark(listed, landing)
    packed = F.lower("file_path").rlike(PACKED)
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(PIECE))
    pieces = listed.filter(F.col("length") > 0).select(
        *ORIGIN,
        F.explode(F.when(packed, F.array(F.lit(0).cast("bigint"))).otherwise(starts)).alias("start"),
        F.when(~packed, PIECE).alias("size"),
    )
    text = F.col("length") * F.when(packed, UNPACKED).otherwise(1)
    total, count = listed.select(F.coalesce(F.sum(text), F.lit(0)), F.count("*")).head()
    tasks = max(1, min(count + total // PIECE, max(spark.sparkContext.defaultParallelism, total // PIECE)))
    order = ["object_name", "file_path", "start"]
    opened = pieces.repartitionByRange(int(tasks), *order).sortWithinPartitions(*order)
    return opened.mapInArrow(decode.reader(root), READ).select("document", *ORIGIN, "error")


def _read_by_spark(listed: DataFrame, landing: str) -> DataFrame:
    """For stores pyarrow does not know: Spark reads the bytes of everything since the oldest
    object asked for, one object a row, and tasks unpack them."""
    spark = listed.sparkSession
    oldest = listed.select(F.date_format(F.to_utc_timestamp(F.min("landed_at"), F.current_timezone()) - F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss")).head()[0]
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("timeZone", "UTC")
    files = reader.option("modifiedAfter", oldest or "1970-01-01T00:00:00").load(landing)
    content = files.select(objects.canonical(F.col("path")).alias("file_path"), "content")
    held = content.join(listed.filter(F.col("length") > 0).select(*ORIGIN), "file_path")
    return held.select(*ORIGIN, "content").mapInArrow(decode.unpacker(), READ).select("document", *ORIGIN, "error")


def read_documents(
    spark: SparkSession,
    landing: str | list[str],
    modified_after: str | None = None,
    modified_before: str | None = None,
) -> DataFrame:
    """Raw documents of a folder or of given files, with their origin.

    `modified_after` and `modified_before` (UTC) already prune at listing.
    """
    reader = (
        spark.read.option("lineSep", RECORD_SEPARATOR)
        .option("recursiveFileLookup", True)
        .option("timeZone", "UTC")
    )
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    if modified_before is not None:
        reader = reader.option("modifiedBefore", modified_before)
    return reader.text(landing).select(F.col("value").alias("document"), *_origin())


def stream_documents(
    spark: SparkSession, landing: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same frame as an unbounded one; Spark's file source takes the oldest files first.

    No file is too old to be taken: copies and restored backups keep old time stamps. The
    price is that the source remembers the name of every file it has taken.
    """
    reader = (
        spark.readStream.option("lineSep", RECORD_SEPARATOR)
        .option("recursiveFileLookup", True)
        .option("maxFileAge", "100000d")
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(landing).select(F.col("value").alias("document"), *_origin())


def _origin() -> list[Column]:
    path = objects.canonical(F.col("_metadata.file_path"))
    return [
        path.alias("file_path"),
        names.name_in_path(path).alias("object_name"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    ]


def parse_documents(documents: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Add `near_earth_objects` and `status` to a frame with a text column `document`.

    The text is parsed as the only element of an array that has a closing mark behind it: this
    way a list, several documents in one text and trailing junk do not pass as a document,
    which the JSON parser would otherwise accept.

    `columns` narrows the fields parsed. Type errors in fields left out then go unnoticed, so
    validate with the full schema first.
    """
    wrapped = F.concat(F.lit('{"feed":['), F.col("document"), F.lit('],"closed":true}'))
    schema = f"feed ARRAY<{feed_ddl(columns)}>, closed BOOLEAN, _corrupt STRING"
    options = {"columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}
    # Inlined as a one-row array: expressions are not merged across a generator, so the text
    # is parsed once and not again for every reference to one of its fields.
    parsed = documents.select("*", F.inline(F.array(F.from_json(wrapped, schema, options))))
    whole = F.col("_corrupt").isNull() & F.col("closed") & (F.size("feed") == 1)
    days = F.get("feed", F.lit(0)).getField("near_earth_objects")
    return parsed.select(
        *documents.columns,
        days.alias("near_earth_objects"),
        F.when(~F.coalesce(whole, F.lit(False)), MALFORMED)
        .when(days.isNull(), NO_DAYS)
        .otherwise(VALID)
        .alias("status"),
    )


def valid_documents(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status") == VALID)


def rejected_documents(parsed: DataFrame) -> DataFrame:
    """Documents to keep aside, with their raw text and the reason."""
    return parsed.filter(F.col("status") != VALID).drop("near_earth_objects")


def require_valid(parsed: DataFrame) -> DataFrame:
    """Strict mode: raise if any document is rejected. Runs a job."""
    worst = rejected_documents(parsed).select("status").head(1)
    if worst:
        raise RejectedDocuments(f"a document is not a feed document: {worst[0].status}")
    return valid_documents(parsed)


def encode_documents(documents: DataFrame) -> DataFrame:
    """Replace `near_earth_objects` by the JSON text `document`."""
    kept = [c for c in documents.columns if c != "near_earth_objects"]
    return documents.select(*kept, F.to_json(F.struct("near_earth_objects")).alias("document"))
