"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted in the cells of source, language and topic. Raking multiplies the weights
of the cells by one factor for each value of a margin, margin after margin, until the weighted
token shares of every margin meet their targets. A document is then kept with the calibrated
probability of its cell, by a hash of its id, so a rerun keeps the same documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import Scratch, add_columns
from feedlake.llm.words import Hasher, mix, slices

MARGINS = ("source", "lang", "topic")
TOPICS = 8
#: Exponent of a value's share of tokens in its default target: 1 leaves the shares, 0 evens them out.
TEMPER = 0.9
TOLERANCE, ROUNDS = 1e-6, 50
#: Cells raked on the driver; more are raked by Spark.
CELLS = 1 << 17
#: Topic words: so many letters at least, or so many bytes beyond ASCII.
TOPIC_BYTES = 6


def with_topics(docs: DataFrame, topics: int = TOPICS) -> DataFrame:
    """`docs` with `n_tokens` (words, long) and `topic` (int).

    Words fall into `topics` lexicons by their hash; the topic is the lexicon with most of the
    document's distinct words, the lowest of equals. A text without words, NULL included, has
    0 tokens and topic 0. Input columns of the two names are replaced.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            tokens, chosen = [], []
            for _, data, offsets in slices(batch.column("text")):
                words, bounds = hasher.words(data, offsets)
                lexicon = (mix(words) % np.uint64(topics)).astype(np.int64)
                for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    tokens.append(end - start)
                    _, first = np.unique(words[start:end], return_index=True)
                    chosen.append(int(np.bincount(lexicon[start:end][first], minlength=topics).argmax()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(tokens, pa.int64()), pa.array(chosen, pa.int32())], names=["row", "tokens", "topic"]
            )

    packed = docs.select(F.struct("*").alias("row"), F.col("text"))
    out = packed.mapInArrow(counted, packed.select("row").schema.add("tokens", "long").add("topic", "integer"))
    rows = out.select("row.*", F.col("tokens").alias("__tokens"), F.col("topic").alias("__topic"))
    return add_columns(rows, n_tokens=F.col("__tokens"), topic=F.col("__topic")).drop("__tokens", "__topic")


def _value(margin: str) -> Column:
    """The value of a margin as text; NULL is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{margin}`").cast("string")), F.lit("NULL"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], scratch: Scratch) -> DataFrame:
    """`cells` (a column for each margin, `tokens`) with `weight` >= 0.

    `targets[margin]` has `value` and `share`. Shares of a margin are taken relative to their
    sum over the values that have tokens; a value without a target keeps no weight. Rounds end
    when no factor differs from 1 by more than TOLERANCE, or after ROUNDS rounds, as margins
    that contradict each other have no solution.

    Up to CELLS cells are raked on the driver, more by Spark; both do the same steps. With a
    few sources, languages and topics there are some hundred cells, whatever the number of
    documents.
    """
    rows = cells.filter("tokens > 0")
    rake_them = _rake_here if rows.limit(CELLS + 1).count() <= CELLS else _rake_spark
    return rake_them(rows, targets, scratch)


def _rake_here(cells: DataFrame, targets: Mapping[str, DataFrame], scratch: Scratch) -> DataFrame:
    found = cells.select(*targets, "tokens").toPandas()
    tokens = found["tokens"].to_numpy(float)
    weights, total = np.ones(len(found)), tokens.sum()
    wanted = []
    for margin, shares in targets.items():
        values, code = np.unique(found[margin].to_numpy(str), return_inverse=True)
        # as many rows as there are values, or targets given
        present = dict(shares.join(cells.select(F.col(margin).alias("value")).distinct(), "value").select("value", "share").collect())
        share = np.array([present.get(v, 0.0) for v in values])
        wanted.append((code, share / (share.sum() or 1.0) * total))
    for _ in range(ROUNDS):
        off = 0.0
        for code, goal in wanted:
            sums = np.bincount(code, weights * tokens, len(goal))
            factor = np.divide(goal, sums, out=np.zeros(len(goal)), where=sums != 0)[code]
            weights *= factor
            off = max(off, float(np.abs(factor - 1)[weights > 0].max(initial=0.0)))
        if off <= TOLERANCE:
            break
    found["weight"] = weights
    schema = cells.select(*targets, "tokens").schema.add("weight", "double")
    return cells.sparkSession.createDataFrame(found, schema) if len(found) else cells.withColumn("weight", F.lit(1.0))


def _rake_spark(cells: DataFrame, targets: Mapping[str, DataFrame], scratch: Scratch) -> DataFrame:
    """Only the factors are reckoned anew: a sum for each value, combined before the shuffle."""
    rows = scratch.keep(cells.withColumn("weight", F.lit(1.0)), "weights")
    wanted = {}
    for margin, shares in targets.items():
        present = rows.select(F.col(margin).alias("value")).distinct().join(shares, "value")
        total = present.agg(F.sum("share")).head()[0] or 1.0
        wanted[margin] = scratch.keep(present.select("value", (F.col("share") / F.lit(total)).alias("share")), "shares")
    tokens = F.lit(float(rows.agg(F.sum("tokens")).head()[0] or 0))
    for _ in range(ROUNDS):
        rows = rows.withColumn("off", F.lit(0.0))
        for margin, shares in wanted.items():
            sums = rows.groupBy(F.col(margin).alias("value")).agg(F.sum(F.col("weight") * F.col("tokens")).alias("sum"))
            factor = F.coalesce(F.try_divide(F.col("share") * tokens, F.col("sum")), F.lit(0.0))
            factors = sums.join(shares, "value", "left").select(F.col("value").alias(margin), factor.alias("factor"))
            rows = rows.join(factors, margin).withColumn("weight", F.col("weight") * F.col("factor"))
            moved = F.when(F.col("weight") > 0, F.abs(F.col("factor") - 1)).otherwise(0.0)
            rows = rows.withColumn("off", F.greatest("off", moved)).drop("factor")
        rows = scratch.keep(rows, "weights")
        if (rows.agg(F.max("off")).head()[0] or 0.0) <= TOLERANCE:
            break
    return rows.drop("off")


def tempered(cells: DataFrame, margin: str, exponent: float) -> DataFrame:
    """Targets of a margin: shares of tokens to the power `exponent`."""
    sums = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    return sums.select("value", F.pow(F.col("tokens").cast("double"), F.lit(exponent)).alias("share"))


def mix_sources(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str | None, float]] | None = None,
    temper: float = TEMPER,
    seed: int = 0,
) -> DataFrame:
    """`docs` with `n_tokens`, `topic`, `weight`, `probability` and `selected`.

    `targets` gives shares of tokens for values of `source`, `lang` or `topic` (None: NULL);
    margins it leaves out get the tempered shares of the table. `weight` is the raked weight
    of the document's cell, `probability` that weight over the largest one, so that selected
    tokens meet the targets in expectation without repeating a document; `selected` is true
    where a hash of doc_id and `seed` lies below the probability.

    Texts without words weigh nothing in the margins; they have weight NULL, probability 0 and
    are not selected. NULL source or lang is a value of its own. Rows of one doc_id share the
    draw. Input columns of the five names are replaced, all others stay.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "mixing")
    rows = with_topics(docs)
    narrow = rows.select(*(_value(m).alias(m) for m in MARGINS), "n_tokens")
    cells = scratch.keep(narrow.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    wanted = {}
    for margin in MARGINS:
        if targets and margin in targets:
            shares = [("NULL" if v is None else f"={v}", float(s)) for v, s in targets[margin].items()]
            wanted[margin] = spark.createDataFrame(shares, "value string, share double")
        else:
            wanted[margin] = scratch.keep(tempered(cells, margin, temper), "targets")
    weights = rake(cells, wanted, scratch)
    # sums differ in their last digits with the order of rows
    weights = scratch.keep(weights.withColumn("weight", F.round("weight", 9)), "rounded")
    largest = weights.agg(F.max("weight")).head()[0]
    weights = scratch.keep(weights.select(*(F.col(m).alias(f"__{m}") for m in MARGINS), F.col("weight").alias("__weight")), "raked")
    keyed = rows.select("*", *(_value(m).alias(f"__{m}") for m in MARGINS))
    out = keyed.join(weights, [f"__{m}" for m in MARGINS], "left").drop(*(f"__{m}" for m in MARGINS))
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(2**53)) / float(2**53)
    counted = F.col("n_tokens") > 0
    probability = F.when(counted & F.col("__weight").isNotNull(), F.round(F.col("__weight") / F.lit(largest), 9)).otherwise(0.0)
    out = add_columns(out, weight=F.when(counted, F.col("__weight")), probability=probability, selected=draw < probability)
    return out.drop("__weight")
