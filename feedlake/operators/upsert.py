"""Create-or-merge by key.

A full outer join would shuffle the whole target, could not be broadcast and could not be
split when a key is hot. The merge is therefore put together from joins that keep the large
side on the left: a small increment is broadcast and the target is not shuffled at all, and
with a large one adaptive execution can split a hot key. Keys are reduced before they are
compared, and NULL keys, which match nothing, take part in no join.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.sources import tables

LOG = logging.getLogger(__name__)
DUPLICATE_MATCH = "a target row is matched by more than one source row"
# Measured size up to which an increment is broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024
# Rows of a partition that a task merges, about.
MERGE_ROWS = 500_000


# Of a way to name a row's columns, the value by which the larger of two rows stays.
Precedence = Callable[[Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Load:
    """What a load did: rows of the increment, partitions it touched (None: created the table)."""

    rows: int
    partitions: list | None


def has_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL keys held by several rows, with their number `source_rows`."""
    return (
        source.filter(has_key(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("source_rows"))
        .filter(F.col("source_rows") > 1)
    )


def merge_key_violations(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated source keys that match a target row: `merge_upsert` would fail on them."""
    keys = list(keys)
    return repeated_keys(source, keys).join(target.select(*keys).distinct(), keys, "left_semi")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    unique_source: bool = False,
    small_source: bool = False,
    precedence: Precedence | None = None,
) -> DataFrame:
    """The target after merging the source into it, in target column order.

    - matched: all non-key source columns overwrite, with NULL too; other columns stay
    - not matched: inserted by column name, columns the source lacks are NULL
    - target rows without a match are kept
    - a NULL key never matches: such rows are kept and inserted
    - two source rows for one target row fail the query when it runs
    - with `precedence`, a match overwrites only if the source row is not the smaller one

    `unique_source` promises that source keys are neither repeated nor NULL, as after a
    grouping by them, and saves the passes that look for such rows. `small_source` tells that
    the source has been measured and may be broadcast.
    """
    keys = list(keys)
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown or not set(keys) <= set(source.columns):
        raise ValueError(f"columns not in target: {unknown}; keys must be in both: {keys}")
    types = {f.name: f.dataType for f in target.schema}
    source = source.select(*[F.col(c).cast(types[c]).alias(c) for c in source.columns])
    values = [c for c in source.columns if c not in keys]

    keyed = source if unique_source else source.filter(has_key(keys))
    merged = target
    if values:
        incoming = _incoming(keyed, keys, unique_source)
        incoming = F.broadcast(incoming) if small_source else _own_exchange(incoming, unique_source)
        updated = _overwrite(target.filter(has_key(keys)), incoming, keys, values, unique_source, precedence)
        merged = updated.unionByName(target.filter(~has_key(keys)))
    new = _unmatched(target, keyed, keys, unique_source, small_source)
    if not unique_source:
        new = new.unionByName(source.filter(~has_key(keys)))
    return merged.unionByName(new, allowMissingColumns=True)


def _own_exchange(rows: DataFrame, already: bool = False) -> DataFrame:
    """Adaptive execution splits a hot key only where both inputs of a join come straight from
    a shuffle, not from an aggregate or join that happens to be partitioned alike."""
    return rows if already else rows.hint("rebalance")


def _incoming(keyed: DataFrame, keys: list[str], unique_source: bool) -> DataFrame:
    marks = [F.lit(True).alias("_present")]
    if not unique_source:
        repeated = repeated_keys(keyed, keys).select(*keys, F.lit(True).alias("_repeated"))
        rows = keyed.join(_own_exchange(repeated), keys, "left")
        marks.append(F.col("_repeated"))
    else:
        rows = keyed
    return rows.select(*[F.col(c).alias(f"_source_{c}") for c in keyed.columns], *marks)


def _overwrite(
    target: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    values: list[str],
    unique_source: bool,
    precedence: Precedence | None,
) -> DataFrame:
    same_key = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_source_{k}") for k in keys])
    joined = target.join(incoming, same_key, "left")
    if not unique_source:
        # in a filter and not in a column, so that pruning never drops the check
        error = F.raise_error(DUPLICATE_MATCH).cast("boolean")
        joined = joined.filter(F.when(F.col("_repeated"), error).otherwise(True))
    wins = F.col("_present")
    if precedence is not None:
        wins = wins & (precedence(lambda c: F.col(f"_source_{c}")) >= precedence(F.col))
    return joined.select(
        *[
            F.when(wins, F.col(f"_source_{c}")).otherwise(F.col(c)).alias(c)
            if c in values
            else F.col(c)
            for c in target.columns
        ]
    )


def _unmatched(
    target: DataFrame, keyed: DataFrame, keys: list[str], unique_source: bool, small_source: bool
) -> DataFrame:
    """Source rows whose key the target lacks."""
    held = target.select(*keys)
    asked = keyed.select(*keys) if unique_source else keyed.select(*keys).distinct()
    if small_source:
        known = F.broadcast(held.join(F.broadcast(asked), keys, "left_semi").distinct())
    else:
        known = _own_exchange(held.distinct().join(asked, keys, "left_semi"))
    return keyed.join(known, keys, "left_anti")


def _merge_dealt(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    part: Column,
    shares: int,
    parts: int,
    precedence: Precedence | None,
) -> DataFrame:
    """The rows of `merge_upsert` for a unique source, dealt by partition as they are to be written.

    Rows of both sides are exchanged once, by partition and by one of `shares` hashes of the key;
    a window then shows each row what the other side has for its key. A task merges whole
    shares, so a key that many target rows have stays in one; window buffers go to disk.
    """
    types = {f.name: f.dataType for f in target.schema}
    keys, values = list(keys), [c for c in source.columns if c not in keys]
    absent = [F.lit(None).cast(types[c]).alias(c) for c in target.columns if c not in source.columns]
    incoming = source.select(*(F.col(c).cast(types[c]).alias(c) for c in source.columns), *absent)
    both = target.filter(has_key(keys)).withColumn("_new", F.lit(False)).unionByName(incoming.withColumn("_new", F.lit(True)))
    both = both.withColumns({"_part": part, "_share": F.pmod(F.xxhash64(*keys), F.lit(shares))})
    tasks = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = [2 * parts * shares] if parts * shares > tasks else []
    same = Window.partitionBy("_part", "_share", *keys)
    found = F.first(F.when(F.col("_new"), F.struct(*source.columns)), ignorenulls=True).over(same)
    rows = both.repartition(*count, "_part", "_share").withColumns(
        {"_found": found, "_held": F.max(~F.col("_new")).over(same)}
    )
    wins = ~F.col("_new") & F.col("_found").isNotNull()
    if precedence is not None:
        wins = wins & (precedence(lambda c: F.col("_found").getField(c)) >= precedence(F.col))
    merged = rows.filter(~F.col("_new") | ~F.col("_held")).select(
        *(F.when(wins, F.col("_found").getField(c)).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns)
    )
    return merged.unionByName(target.filter(~has_key(keys)))


def upsert_table(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: str = "observation_date",
    grain: str = tables.DAY,
    unique_source: bool = False,
    precedence: Precedence | None = None,
    together: bool = False,
) -> Load:
    """Create the table from the source, or merge the source into the partitions it touches.

    Returns the rows of the source and the touched partition values, None for these after
    creation. The partition column must be a key: then no row can move to another partition,
    and partitions the source does not mention need neither be read nor written. `grain`
    counts at creation only.

    The source is passed several times; store one that is costly to make before the call.
    `unique_source`, `precedence`: see `merge_upsert`; `together`, for a table that is created: see
    `tables.gathered`. A source without rows is warned of.
    """
    if partition_by not in keys:
        raise ValueError(f"partition column {partition_by} must be one of the keys {list(keys)}")
    target = tables.open_table(spark, table)
    if target is None:
        return _reported(Load(tables.create_table(source, table, partition_by, grain, together), None), table)
    row_level = tables.has_row_level_catalog(spark, table)
    if not row_level:
        grain = tables.grain_of(target.columns, partition_by)
    # One value per partition of the increment: the driver holds as many anyway as
    # directories of the table, and only literal values prune the scan at planning.
    parts = (
        source.groupBy(tables.partition_value(partition_by, grain).alias("part"))
        .agg(F.sum(_row_bytes(source)).alias("bytes"), F.count("*").alias("rows"))
        .collect()
    )
    load = Load(sum(row.rows for row in parts), [row.part for row in parts])
    if row_level:
        merge_into(source, table, keys, precedence)
    elif parts:
        column = tables.partition_column(partition_by, grain)
        # a path whose only partition is NULL does not tell that its partitions are dates
        target = target.withColumn(column, F.col(column).cast("date"))
        target = target.filter(_among(column, load.partitions))
        small = sum(row.bytes for row in parts) <= BROADCAST_BYTES
        dealt = unique_source and not small
        if dealt:
            held = {row[0]: row[1] for row in target.groupBy(column).count().collect()}
            largest = max(row.rows + held.get(row.part, 0) for row in parts)
        if column != partition_by:
            target = target.drop(column)
        if dealt:
            part = tables.partition_value(partition_by, grain)
            merged = _merge_dealt(target, source, keys, part, -(-largest // MERGE_ROWS), len(parts), precedence)
        else:
            merged = merge_upsert(target, source, keys, unique_source, small, precedence)
        tables.overwrite_partitions(merged, table, partition_by, grain, dealt)
    return _reported(load, table)


def _reported(load: Load, table: str) -> Load:
    if load.rows:
        LOG.info("%d rows loaded into %s", load.rows, table)
    else:
        LOG.warning("no rows to load into %s", table)
    return load


def _row_bytes(rows: DataFrame) -> Column:
    """Size of a row: the text it holds and 16 bytes a field."""
    width = F.lit(16 * len(rows.columns))
    for field in rows.schema.fields:
        value = F.col(field.name)
        if not isinstance(field.dataType, (T.AtomicType, T.NullType)):
            value = F.to_json(F.struct(value))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        width = width + F.coalesce(F.octet_length(value), F.lit(0))
    return width.cast("bigint")


def _among(column: str, days: list) -> Column:
    known = ", ".join(f"DATE '{d.isoformat()}'" for d in days if d is not None)
    among = F.expr(f"`{column}` IN ({known})") if known else F.lit(False)
    return among | F.col(column).isNull() if None in days else among


def merge_into(
    source: DataFrame, table: str, keys: Sequence[str], precedence: Precedence | None = None
) -> None:
    """The same merge as one MERGE statement, for catalogs whose tables support it."""
    same_key = reduce(
        lambda a, b: a & b, [F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in keys]
    )
    incoming = {c: F.col(f"source.{c}") for c in source.columns}
    updates = {c: v for c, v in incoming.items() if c not in keys}
    merge = source.alias("source").mergeInto(table, same_key)
    if updates and precedence is None:
        merge = merge.whenMatched().update(updates)
    elif updates:
        wins = precedence(lambda c: F.col(f"source.{c}")) >= precedence(lambda c: F.col(f"{table}.{c}"))
        merge = merge.whenMatched(wins).update(updates)
    merge.whenNotMatched().insert(incoming).merge()
