"""A feed made from the order tables, for queries that are checked against SQL.

One order is one asteroid, its lineitems are its close approaches, its order date is the day.
Documents hold orders of one 7-day window counted from `ANCHOR`. The values are those of
FIXTURES.md section 2.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.convert import iso_date
from feedlake.sources.documents import encode_documents

ANCHOR = date(1992, 1, 1)
# Size of a document and of the part of one order that stays together, in approaches.
DOCUMENT_ROWS = 512
ORDER_ROWS = 64
# Documents of a week that one task builds.
TOGETHER = 64

ORDER_FIELDS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "day",
]
LINE_FIELDS = [
    "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str, raised: int | None = None) -> DataFrame:
    """All orders; with `raised`, those whose key it divides, at a price higher by it."""
    rows = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    if raised is None:
        return rows
    rows = rows.filter(F.col("o_orderkey") % raised == 0)
    return rows.withColumn("o_totalprice", F.col("o_totalprice") + raised)


def week_of(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit(ANCHOR)) / 7).cast("int")


def week_start(week: Column) -> Column:
    return F.date_add(F.lit(ANCHOR), (week * 7).cast("int"))


def week_end(week: Column) -> Column:
    return F.date_add(F.lit(ANCHOR), (week * 7 + 6).cast("int"))


def approach() -> Column:
    """Close approach of a lineitem, readings as text and some of them malformed."""
    shipped = F.col("l_shipdate").cast("date")
    return F.struct(
        F.when(F.col("l_linenumber") == 7, "unknown").otherwise(iso_date(shipped)).alias("close_approach_date"),
        F.concat_ws(" ", iso_date(shipped), "l_returnflag").alias("close_approach_date_full"),
        (F.unix_date(shipped).cast("bigint") * 86_400_000).alias("epoch_date_close_approach"),
        F.struct(
            F.col("l_discount").cast("string").alias("astronomical"),
            (F.col("l_quantity") * F.lit(384400.0)).cast("string").alias("kilometers"),
            F.col("l_extendedprice").cast("string").alias("lunar"),
            F.when(
                F.col("l_linestatus") != "O",
                (F.col("l_extendedprice") / F.lit(1.609344)).cast("string"),
            ).alias("miles"),
        ).alias("miss_distance"),
        F.lit("Earth").alias("orbiting_body"),
        F.struct(
            F.when(F.col("l_returnflag") == "R", "n/a")
            .otherwise(F.col("l_extendedprice").cast("string"))
            .alias("kilometers_per_hour"),
            F.col("l_quantity").cast("string").alias("kilometers_per_second"),
            F.col("l_tax").cast("string").alias("miles_per_hour"),
        ).alias("relative_velocity"),
    )


def asteroid(approaches: Column) -> Column:
    price = F.col("o_totalprice")

    def between(low: Column, high: Column, unit: str) -> Column:
        return F.struct(
            low.alias("estimated_diameter_min"), high.alias("estimated_diameter_max")
        ).alias(unit)

    key = F.col("o_orderkey").cast("string")
    return F.struct(
        price.alias("absolute_magnitude_h"),
        approaches.alias("close_approach_data"),
        F.struct(
            between(price * 3, price * 6, "feet"),
            between(price / 1000, price / 500, "kilometers"),
            between(price, price * 2, "meters"),
            between(price / 1609, price / 800, "miles"),
        ).alias("estimated_diameter"),
        key.alias("id"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_potentially_hazardous_asteroid"),
        (F.col("o_orderstatus") == "F").alias("is_sentry_object"),
        F.concat(F.lit("("), key, F.lit(")")).alias("name"),
        F.concat(F.lit("https://example.test/"), key).alias("nasa_jpl_url"),
        F.col("o_custkey").cast("string").alias("neo_reference_id"),
    )


def feed_documents(spark: SparkSession, sf_dir: str, raised: int | None = None) -> DataFrame:
    """`start_date`, `end_date`, `document` (JSON text) of all orders, or of `raised` ones.

    Documents stay near DOCUMENT_ROWS approaches however the data is distributed: a week is
    cut into as many parts as its row count asks for, and where one of its orders has many
    lineitems, orders are cut into pieces. Pieces are drawn from row ids given at the scan,
    which a repeated task gives again, so copies of one row spread as well as different rows
    do. The wide join reads both tables straight from a shuffle, which lets adaptive execution
    split a hot order. All three levels of nesting group within one exchange on the week and the
    block of TOGETHER parts, so a task holds documents of one week together.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    placed = (
        orders(spark, sf_dir, raised)
        .select(*ORDER_FIELDS, F.monotonically_increasing_id().alias("o_id"))
        .withColumn("week", week_of(F.col("day")))
    )
    counts = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    # one row per calendar week, and dates end with the year 9999: 12 MB at the very most
    weeks = F.broadcast(
        placed.join(counts, "o_orderkey", "left")
        .groupBy("week")
        .agg(
            F.ceil(F.sum(F.coalesce("lines", F.lit(1))) / DOCUMENT_ROWS).alias("parts"),
            F.ceil(F.coalesce(F.max("lines"), F.lit(1)) / ORDER_ROWS).alias("pieces"),
        )
    )
    lines = lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        *LINE_FIELDS,
        F.monotonically_increasing_id().alias("l_id"),
    )
    with_lines = placed.join(lines, "o_orderkey")
    without = placed.join(counts, "o_orderkey", "left_anti")
    piece = F.pmod(F.xxhash64("l_id"), F.col("pieces"))
    place = ["week", "block", "part"]
    rows = (
        with_lines.unionByName(without, allowMissingColumns=True)
        .join(weeks, "week")
        .withColumn("part", F.pmod(F.xxhash64("o_id", piece), F.col("parts")))
        .withColumn("block", F.floor(F.col("part") / TOGETHER))
        .select(*place, *ORDER_FIELDS, *LINE_FIELDS)
        .repartition("week", "block")
    )
    # built behind the exchange: the plain columns are much narrower than the readings as text
    reported = F.when(F.col("l_linenumber").isNotNull(), approach())
    approaches = rows.groupBy(*place, *ORDER_FIELDS).agg(F.collect_list(reported).alias("found"))
    found = F.when(F.size("found") > 0, F.col("found"))
    days = approaches.groupBy(*place, "day").agg(F.collect_list(asteroid(found)).alias("asteroids"))
    documents = days.groupBy(*place).agg(
        F.map_from_entries(F.collect_list(F.struct(iso_date(F.col("day")), "asteroids"))).alias(
            "near_earth_objects"
        )
    )
    return encode_documents(
        documents.select(
            week_start(F.col("week")).alias("start_date"),
            week_end(F.col("week")).alias("end_date"),
            "near_earth_objects",
        )
    )


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`o_orderkey`, `document`: one small document per order, without a shuffle."""
    entry = F.create_map(iso_date(F.col("day")), F.array(asteroid(F.lit(None).cast("array<string>"))))
    return encode_documents(
        orders(spark, sf_dir).select("o_orderkey", entry.alias("near_earth_objects"))
    )


def approach_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every approach in the columns of gold, straight from the order tables.

    The gold table itself has fewer rows, as approaches of one key are merged there.
    """
    return (
        orders(spark, sf_dir)
        .join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.col("day").alias("observation_date"),
            F.concat(F.lit("("), F.col("o_orderkey").cast("string"), F.lit(")")).alias("name"),
            F.col("l_quantity").alias("velocity_kps"),
            F.col("l_extendedprice").alias("miss_distance_ld"),
        )
    )
