"""The query catalogue: every operator over whole tables, each named as in `oracles`."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import names
from feedlake.operators import coverage, intervals, views
from feedlake.operators.flatten import analytics, explode_asteroids, explode_days, flatten
from feedlake.operators.newest import newest_per_key
from feedlake.operators.upsert import merge_key_violations, merge_upsert, upsert_table
from feedlake.plans import jobs, surface, synthetic
from feedlake.sources import footers, tables
from feedlake.sources.documents import (
    keep_documents,
    land_documents,
    land_objects,
    list_objects,
    parse_documents,
    valid_documents,
)
from feedlake.sources.schemas import (
    DATE_COLUMNS,
    DISTANCE_COLUMNS,
    FEED_KEYS,
    GOLD_COLUMNS,
    SILVER_COLUMNS,
    VELOCITY_COLUMNS,
)
from feedlake.streaming.increment import Bound, attempts_of, failed_objects, pending_objects, read_rejected

NAMESPACE = "feedlake_queries"
CALENDAR = (date(1992, 1, 1), date(2002, 12, 31))
VIEW_DAY = date(1995, 2, 18)


# -- feed -------------------------------------------------------------------------------


def _feed(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    return valid_documents(parse_documents(synthetic.feed_documents(spark, sf_dir), columns))


def feed_explode_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and asteroids, each once, however many pieces an order with many lines is cut into."""
    feed = _feed(spark, sf_dir, ["asteroid_id"])
    return (
        explode_asteroids(explode_days(feed))
        .select("observation_date", F.col("asteroid.id").alias("asteroid_id"))
        .distinct()
    )


def feed_flatten_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(_feed(spark, sf_dir))


def feed_malformed_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    converted = DATE_COLUMNS + VELOCITY_COLUMNS + DISTANCE_COLUMNS
    return flatten(_feed(spark, sf_dir, converted), converted).agg(
        F.count("*").alias("row_count"), *[F.count(c).alias(f"n_{c}") for c in converted]
    )


def _damaged(document: Column, how: Column) -> Column:
    """Seven ways to break a document, and 0 for none."""
    return (
        F.when(how == 0, document)
        .when(how == 1, F.substr(document, F.lit(1), F.length(document) - 3))
        .when(how == 2, F.replace(document, F.lit("near_earth_objects"), F.lit("objects")))
        .when(how == 3, F.concat(F.lit("["), document, F.lit("]")))
        .when(how == 4, F.lit('{"near_earth_objects":[]}'))
        .when(how == 5, F.concat(document, F.lit(" junk")))
        .when(how == 6, F.lit('{"near_earth_objects":null}'))
        .otherwise(F.concat(document, F.lit(","), document))
    )


def feed_validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = F.col("o_orderkey") % 8
    documents = synthetic.order_documents(spark, sf_dir).select(
        how.alias("damage"), _damaged(F.col("document"), how).alias("document")
    )
    return (
        parse_documents(documents).groupBy("damage", "status").agg(F.count("*").alias("n"))
    )


def gold_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics(flatten(_feed(spark, sf_dir, GOLD_COLUMNS), GOLD_COLUMNS))


def load_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.load_counts(flatten(_feed(spark, sf_dir, []), ["observation_date"]))


# -- coverage ---------------------------------------------------------------------------


def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = synthetic.orders(spark, sf_dir).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    return coverage.calendar_of(bounds, "first", "last")


def _order_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object per order, named after its week; some names hold no range."""
    week = synthetic.week_of(F.col("day"))
    good = F.concat(
        F.format_string("bronze/%s/", F.col("o_orderkey")),
        names.file_name(synthetic.week_start(week), synthetic.week_end(week)),
    )
    bad = F.format_string
    key = F.col("o_orderkey")
    return synthetic.orders(spark, sf_dir).select(
        F.when(key % 11 == 0, bad("bronze/%s/neo-latest.json", key))
        .when(key % 13 == 0, bad("bronze/%s/neo-1995-13-01_1995-13-07.json", key))
        .when(key % 17 == 0, bad("bronze/%s/neo-1995-02-24_1995-02-30.json", key))
        .otherwise(good)
        .alias("object_name")
    )


def coverage_from_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.ranges_in_names(_order_objects(spark, sf_dir))


def coverage_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = coverage.readable_names(coverage.ranges_in_names(_order_objects(spark, sf_dir)))
    return coverage.covered_days(ranges).groupBy("all_dates").agg(F.count("*").alias("objects"))


def missing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order lands an object for its day, on Sundays one without a range."""
    day = F.col("day")
    objects = synthetic.orders(spark, sf_dir).select(
        F.when(F.dayofweek(day) == 1, "bronze/neo-sunday.json")
        .otherwise(names.object_name(day, day))
        .alias("object_name")
    )
    return coverage.ranges_to_request(objects, *CALENDAR)


def missing_ranges_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranges from kept intervals, into which the objects come in three loads."""
    table = f"{tables.scratch(spark, 'intervals')}/covered"
    day = F.col("day")
    ranges = synthetic.orders(spark, sf_dir).filter(F.dayofweek(day) != 1)
    for turn in range(3):
        part = ranges.filter(F.col("o_orderkey") % 3 == turn)
        intervals.cover(spark, table, part.select(day.alias("start_date"), day.alias("end_date")))
    return intervals.ranges_to_request(intervals.covered(spark, table, *CALENDAR), *CALENDAR)


def covered_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal intervals of the objects' weeks, some of which are left out."""
    ranges = coverage.readable_names(coverage.ranges_in_names(_order_objects(spark, sf_dir)))
    return intervals.merge_intervals(ranges.filter(F.dayofyear("start_date") % 5 != 0))


# -- upsert -----------------------------------------------------------------------------


def _target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synthetic.orders(spark, sf_dir).select(*synthetic.ORDER_FIELDS)


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders under twice their key: half of them meet an order, the others are new."""
    return _target(spark, sf_dir).withColumns(
        {"o_orderkey": F.col("o_orderkey") * 2, "o_totalprice": F.col("o_totalprice") * 2}
    )


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_upsert(_target(spark, sf_dir), _source(spark, sf_dir), ["o_orderkey"])


def upsert_partial_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _source(spark, sf_dir).drop("o_orderstatus", "o_custkey")
    return merge_upsert(_target(spark, sf_dir), source, ["o_orderkey"])


def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = F.when(F.col("o_custkey") % 10 != 0, F.col("o_orderkey"))
    target = _target(spark, sf_dir).withColumn("o_orderkey", some)
    source = _source(spark, sf_dir).withColumn("o_orderkey", some)
    return merge_upsert(target, source, ["o_orderkey"])


def upsert_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An absent table is created from the source, then merged into by the same call."""
    table = f"{NAMESPACE}.orders"
    tables.create_namespace(spark, NAMESPACE, tables.scratch(spark, "created"))
    # an earlier run's table goes, and so does its entry in the catalog
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    keys = ["day", "o_orderkey"]
    upsert_table(spark, _target(spark, sf_dir), table, keys, "day", tables.YEAR)
    raised = _target(spark, sf_dir).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    upsert_table(spark, raised, table, keys, "day")
    return tables.read_table(spark, table).select(*synthetic.ORDER_FIELDS)


def merge_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and asteroids that would be matched by several approaches."""
    target = synthetic.orders(spark, sf_dir).select(
        F.col("day").alias("observation_date"), F.col("o_orderkey").cast("string").alias("asteroid_id")
    )
    lines = synthetic.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("asteroid_id")
    )
    # rebalanced, so that counting does not tie a hot asteroid to the join's partitioning
    source = target.join(lines, "asteroid_id").hint("rebalance")
    return merge_key_violations(target, source, FEED_KEYS)


def newest_row_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_per_key(
        synthetic.table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_shipdate", "l_linenumber"]
    )


# -- hand-over and layers ---------------------------------------------------------------


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order objects which no lineitem with return flag R has entered into the ledger."""

    def named(key: str) -> Column:
        return F.format_string("bronze/order-%s.json", F.col(key)).alias("object_name")

    returned = synthetic.table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    objects = synthetic.table(spark, sf_dir, "orders").select(named("o_orderkey"))
    return pending_objects(objects, returned.select(named("l_orderkey")), ["object_name"])


def _landed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    root = tables.scratch(spark, "feed")
    land_documents(synthetic.feed_documents(spark, sf_dir), f"{root}/bronze", gathered=True)
    return root, f"{root}/bronze"


def landed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land, list, read the ranges back from the names."""
    _, landing = _landed(spark, sf_dir)
    ranges = coverage.ranges_in_names(list_objects(spark, landing))
    return ranges.select("start_date", "end_date").distinct()


def stream_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, landing = _landed(spark, sf_dir)
    jobs.bronze_to_silver_stream(
        spark, landing, f"{root}/silver", f"{root}/rejected", f"{root}/checkpoint", tables.MONTH
    )
    return tables.read_table(spark, f"{root}/silver").select(*SILVER_COLUMNS)


def layers_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze to silver to gold in batch form, the gold job twice."""
    root, landing = _landed(spark, sf_dir)
    silver, gold = f"{root}/silver", f"{root}/gold"
    jobs.bronze_to_silver(
        spark, landing, silver, f"{root}/rejected", f"{root}/ledger", "first", tables.MONTH
    )
    jobs.silver_to_gold(spark, silver, gold, grain=tables.MONTH)
    jobs.silver_to_gold(spark, silver, gold)
    return tables.read_table(spark, gold).select(*jobs.GOLD_TABLE_COLUMNS)


def arrival_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges landed again in two steps with other prices; the last landed version stays."""
    root, landing = _landed(spark, sf_dir)
    load = (landing, f"{root}/silver", f"{root}/rejected", f"{root}/ledger", "same label", tables.MONTH)
    jobs.bronze_to_silver(spark, *load)
    for raised in (3, 5):
        land_documents(synthetic.feed_documents(spark, sf_dir, raised), landing, gathered=True)
    jobs.bronze_to_silver(spark, *load)
    return tables.read_table(spark, f"{root}/silver").select(*SILVER_COLUMNS)


def rejected_by_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of two loads under one label, the second of which is repeated."""
    root = tables.scratch(spark, "rejects")
    how = F.col("o_orderkey") % 8
    damaged = synthetic.order_documents(spark, sf_dir).select(
        how.alias("how"), _damaged(F.col("document"), how).alias("document"),
        F.lit(CALENDAR[0]).alias("start_date"), F.lit(CALENDAR[1]).alias("end_date"),
    )
    for step, ledger in ((F.col("how") < 4, "ledger"), (F.col("how") >= 4, "ledger"), (F.lit(False), "lost")):
        land_documents(damaged.filter(step), f"{root}/bronze")
        jobs.bronze_to_silver(
            spark, f"{root}/bronze", f"{root}/silver", f"{root}/rejected", f"{root}/{ledger}", "label"
        )
    rejected = read_rejected(spark, f"{root}/rejected")
    return rejected.groupBy("status").agg(F.count("*").alias("n"))


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows each job says it has loaded; the second round finds nothing new."""
    root, landing = _landed(spark, sf_dir)
    rows = []
    for turn in (1, 2):
        silver = jobs.bronze_to_silver(
            spark, landing, f"{root}/silver", f"{root}/rejected", f"{root}/ledger", "report", tables.MONTH
        )
        gold = jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", silver.partitions, tables.MONTH)
        rows += [(turn, "silver", silver.rows), (turn, "gold", gold.rows)]
    return spark.createDataFrame(rows, "turn INT, job STRING, row_count BIGINT")


def broken_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain, packed, broken and empty objects, one for each document, in two loads.

    Some of the broken ones are replaced by good ones in between. For each outcome: attempts
    made in vain, weeks whose objects ended so, and silver rows of these weeks.
    """
    root = tables.scratch(spark, "broken")
    landing, week = f"{root}/bronze", synthetic.week_of(F.col("start_date"))
    documents = keep_documents(synthetic.feed_documents(spark, sf_dir), f"{root}/documents")

    def objects(packed: bool, content: Column) -> DataFrame:
        name = names.file_name(F.col("start_date"), F.col("end_date"))
        folder = F.concat(F.md5("document"), F.lit("/"))
        name = F.concat(folder, name, F.lit(".gz")) if packed else F.concat(folder, name)
        return documents.select(F.pmod(week, F.lit(8)).alias("kind"), name.alias("object_name"), content.alias("content"))

    plain, packed = objects(False, F.col("document")), objects(True, F.col("document"))
    land_objects(plain.filter("kind IN (0, 4)"), landing)
    land_objects(packed.filter("kind IN (1, 5)"), landing, pack=True)
    land_objects(packed.filter("kind IN (2, 6)"), landing)
    land_objects(objects(False, F.lit("")).filter("kind IN (3, 7)"), landing)
    silver, rejected, ledger = f"{root}/silver", f"{root}/rejected", f"{root}/ledger"
    for _ in range(2):
        jobs.bronze_to_silver(spark, landing, silver, rejected, ledger, "broken", tables.MONTH)
        land_objects(packed.filter("kind = 2"), landing, pack=True)
    failed = failed_objects(spark, attempts_of(ledger)).select("file_path", "attempts")
    empty = read_rejected(spark, rejected).filter("status = 'empty'").select("file_path", F.lit(True).alias("empty"))
    loaded = spark.read.parquet(ledger).select("file_path", F.lit(True).alias("loaded"))
    seen = coverage.ranges_in_names(list_objects(spark, landing))
    for state in (failed, empty.distinct(), loaded.distinct()):
        seen = seen.join(state, "file_path", "left")
    outcome = F.when(F.col("attempts") > 0, "unreadable").when(F.col("empty"), "empty").when(F.col("loaded"), "loaded")
    weeks = seen.groupBy(week.alias("week")).agg(F.min(outcome).alias("outcome"), F.max("attempts").alias("attempts"))
    rows = tables.read_table(spark, silver).groupBy(synthetic.week_of(F.col("observation_date")).alias("week")).agg(F.count("*").alias("n"))
    return weeks.join(rows, "week", "left").groupBy("outcome").agg(
        F.coalesce(F.max("attempts"), F.lit(0)).alias("attempts"),
        F.count("*").alias("weeks"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("silver_rows"),
    )


def bounded_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges landed in three versions, loaded oldest first by a quarter of their bytes at a time."""
    root, landing = _landed(spark, sf_dir)
    for raised in (3, 5):
        land_documents(synthetic.feed_documents(spark, sf_dir, raised), landing, gathered=True)
    total = list_objects(spark, landing).agg(F.sum("length")).head()[0]
    jobs.bronze_to_silver(
        spark, landing, f"{root}/silver", f"{root}/rejected", f"{root}/ledger", "bounded", tables.MONTH,
        Bound(bytes=-(-total // 4)),
    )
    return tables.read_table(spark, f"{root}/silver").select(*SILVER_COLUMNS)


# -- views ------------------------------------------------------------------------------


def _gold(spark: SparkSession, sf_dir: str) -> str:
    """A gold table written by the jobs, partitioned by month."""
    root, landing = _landed(spark, sf_dir)
    jobs.bronze_to_silver(
        spark, landing, f"{root}/silver", f"{root}/rejected", f"{root}/ledger", "views", tables.MONTH
    )
    jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", grain=tables.MONTH)
    return f"{root}/gold"


def stored_date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.gold_views(spark, _gold(spark, sf_dir), VIEW_DAY)["bounds"]


def stored_miss_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.gold_views(spark, _gold(spark, sf_dir), VIEW_DAY)["miss_distances"]


def stored_velocity_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.gold_views(spark, _gold(spark, sf_dir), VIEW_DAY)["velocities"]


def stored_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every month of the stored gold table, from file footers."""
    return footers.partition_counts(spark, _gold(spark, sf_dir), "observation_date_month")


def sql_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and gold of one day by SQL text alone."""
    root, landing = _landed(spark, sf_dir)
    silver, gold = f"{root}/silver", f"{root}/gold"
    jobs.bronze_to_silver(spark, landing, silver, f"{root}/rejected", f"{root}/ledger", "sql", tables.MONTH)
    jobs.silver_to_gold(spark, silver, gold, grain=tables.MONTH)
    surface.register(spark, silver, gold)
    return spark.sql(f"""
        SELECT a.asteroid_id, a.epoch_date_close_approach, m.name, m.miss_distance_ld
        FROM approaches(DATE'{VIEW_DAY}') a
        JOIN miss_distances(DATE'{VIEW_DAY}') m ON a.name = m.name AND a.miss_distance_ld <=> m.miss_distance_ld""")


def view_date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.date_bounds(synthetic.approach_rows(spark, sf_dir))


def view_miss_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.miss_distances(synthetic.approach_rows(spark, sf_dir), VIEW_DAY)


def view_velocity_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.velocity_histogram(synthetic.approach_rows(spark, sf_dir), VIEW_DAY)


def histogram_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.histogram(synthetic.approach_rows(spark, sf_dir), "miss_distance_ld", 25)


CATALOGUE = {
    "feed_explode_days": feed_explode_days,
    "feed_flatten_silver": feed_flatten_silver,
    "feed_malformed_to_null": feed_malformed_to_null,
    "feed_validate_split": feed_validate_split,
    "gold_project": gold_project,
    "load_audit_counts": load_audit_counts,
    "calendar_days": calendar_days,
    "coverage_from_names": coverage_from_names,
    "coverage_days": coverage_days,
    "missing_ranges": missing_ranges,
    "missing_ranges_kept": missing_ranges_kept,
    "covered_intervals": covered_intervals,
    "upsert_merge": upsert_merge,
    "upsert_partial_columns": upsert_partial_columns,
    "upsert_null_keys": upsert_null_keys,
    "upsert_create": upsert_create,
    "merge_key_violations": merge_violations,
    "newest_per_key": newest_row_per_key,
    "pending_objects": pending,
    "landed_objects": landed_objects,
    "stream_increment": stream_increment,
    "layers_to_gold": layers_to_gold,
    "arrival_order": arrival_order,
    "rejected_documents": rejected_by_two_loads,
    "load_report": load_report,
    "broken_objects": broken_objects,
    "bounded_loads": bounded_loads,
    "stored_date_bounds": stored_date_bounds,
    "stored_miss_distance": stored_miss_distance,
    "stored_velocity_histogram": stored_velocity_histogram,
    "stored_row_counts": stored_row_counts,
    "sql_surface": sql_surface,
    "view_date_bounds": view_date_bounds,
    "view_miss_distance": view_miss_distance,
    "view_velocity_histogram": view_velocity_histogram,
    "histogram_all_days": histogram_all_days,
}
