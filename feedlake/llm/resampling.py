"""Importance resampling towards a target distribution, with a distributed quickselect.

Texts are bags of hashed n-grams of words. For each bucket the log ratio of its share in the
target texts to that in the documents is its gain; a document's weight is the mean gain of its
n-grams. A Gumbel draw of its id is added, so that the highest scores are a sample without
replacement in proportion to the weights' exponents.

The highest scores are found without sorting the table. Rows are ordered by (score, id, row).
Random keys of the part still in question are pivots; rows of that part are counted exactly
below, at and above each of them, and only the part between two pivots that holds the last
winner goes on. The winners alone are sorted, by ranges, and ranked.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import Scratch, add_columns
from feedlake.llm.words import Hasher, slices

BUCKETS = 10_000
#: Pivots of a round.
PIVOTS = 31
#: Distinct n-grams a task remembers.
REMEMBERED = 1 << 20


class Buckets:
    """Bucket of every n-gram, reckoned once for each distinct one of a task."""

    def __init__(self, buckets: int, longest: int):
        self.buckets, self.longest, self.hasher = buckets, longest, Hasher()
        self.known: dict[bytes, int] = {}

    def read(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of the n-grams of all texts, the text each is of, and the texts' word counts."""
        hashes, starts, stops, bounds = self.hasher.spans(data, offsets)
        counts = np.diff(bounds)
        text = np.repeat(np.arange(len(counts)), counts)
        _, first, index = np.unique(hashes, return_index=True, return_inverse=True)
        raw = data.tobytes()
        words = [raw[a:b].lower() for a, b in zip(starts[first].tolist(), stops[first].tolist(), strict=True)]
        own, of = [self._of(words)[index]], [text]
        for n in range(2, self.longest + 1):
            whole = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :]) if len(text) >= n else np.zeros(0, int)
            if not len(whole):
                break
            runs, place = np.unique(np.stack([index[whole + i] for i in range(n)]), axis=1, return_inverse=True)
            joined = [b" ".join(words[i] for i in run) for run in runs.T.tolist()]
            own.append(self._of(joined)[place.ravel()])
            of.append(text[whole])
        return np.concatenate(own), np.concatenate(of), counts

    def _of(self, features: list[bytes]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known = {}
        for feature in features:
            if feature not in self.known:
                self.known[feature] = zlib.crc32(feature) % self.buckets
        return np.fromiter(map(self.known.__getitem__, features), np.int64, len(features))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = 1) -> np.ndarray:
    """Occurrences of n-grams (1 to `longest` words) by bucket, over the whole column `text`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, total = Buckets(buckets, longest), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                total += np.bincount(reader.read(data, offsets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counted = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    # at most as many rows as buckets
    for row in counted.collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of add-one shares, rounded down."""
    buckets = len(target)
    ratio = (target + 1.0) * (source.sum() + float(buckets)) / ((source + 1.0) * (target.sum() + float(buckets)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def gumbel(identity: Column, seed: int) -> Column:
    """1000 times a standard Gumbel draw, rounded down, the same for equal ids.

    NULL ids draw as the empty text does.
    """
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("")))
    number = F.conv(F.substr(F.sha2(named, 256), F.lit(1), F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((number + 0.5) / 4294967296.0)))


def weigh(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = 1, seed: int = 2024) -> DataFrame:
    """`docs` with `n_words`, `n_features`, `weight` and `score` (all long).

    `target` has texts in its column `text`. NULL texts have no words and weigh 0, as do texts
    without words. An empty target leaves weights by rarity alone. Input columns of the four
    names are replaced, all others stay.
    """
    gains = bucket_gains(bucket_counts(target, buckets, longest), bucket_counts(docs, buckets, longest))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Buckets(buckets, longest)
        for batch in batches:
            words, features, sums = ([np.zeros(0, np.int64)] for _ in range(3))
            for _, data, offsets in slices(batch.column("text")):
                own, text, counts = reader.read(data, offsets)
                words.append(counts)
                features.append(np.bincount(text, minlength=len(counts)))
                # sums of whole numbers far below 2 ** 53
                sums.append(np.bincount(text, gains[own], len(counts)).astype(np.int64))
            n, total = np.concatenate(features), np.concatenate(sums)
            columns = [np.concatenate(words), n, np.where(n > 0, total // np.maximum(n, 1), 0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(c.astype(np.int64)) for c in columns)], names=["row", "words", "features", "weight"]
            )

    packed = docs.select(F.struct("*").alias("row"), F.col("text"))
    schema = packed.select("row").schema.add("words", "long").add("features", "long").add("weight", "long")
    out = packed.mapInArrow(scored, schema)
    rows = out.select("row.*", *(F.col(c).alias(f"__{c}") for c in ("words", "features", "weight")))
    score = F.col("__weight") + gumbel(F.col("doc_id"), seed)
    own = {"n_words": F.col("__words"), "n_features": F.col("__features"), "weight": F.col("__weight"), "score": score}
    return add_columns(rows, **own).drop("__words", "__features", "__weight")


def draw(weighed: DataFrame, percent: int = 10, least_words: int = 20) -> DataFrame:
    """Rows (`doc_id`, `n_words`, `score`) with `rank`: 1, 2, 3 ... of those drawn, else NULL.

    Drawn is floor(percent / 100) of the rows with `least_words` words, those of highest score,
    ties to the smaller doc_id, a NULL id after all others. Rows of one id are judged each by
    their own score; among rows that are equal in both any may come first, but each of them has
    a rank of its own. An input column `rank` is replaced.
    """
    scratch = Scratch(weighed.sparkSession, "resampling")
    # written once, so that the row numbers stay
    rows = scratch.keep(weighed.withColumn("__at", F.monotonically_increasing_id()), "scored")
    second = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"))
    keys = rows.filter(F.col("n_words") >= least_words).select(
        (-F.col("score")).alias("first"), second.alias("second"), F.col("__at").alias("third")
    )
    ranks = ranked_least(keys, keys.count() * percent // 100, scratch)
    ranks = ranks.select(F.col("third").alias("__at"), F.col("rank").alias("__rank"))
    return add_columns(rows.join(ranks, "__at", "left"), rank=F.col("__rank")).drop("__at", "__rank")


KEY = ["first", "second", "third"]


def ranked_least(keys: DataFrame, count: int, scratch: Scratch) -> DataFrame:
    """The `count` least keys (first, second, third; no two alike) with their `rank` from 1."""
    if count <= 0:
        return keys.limit(0).withColumn("rank", F.lit(0).cast("long"))
    last = kth_key(keys, count, scratch)
    winners = keys.filter(_key() <= last)
    ranged = winners.repartitionByRange(*KEY).withColumn("range", F.spark_partition_id())
    # ranges are drawn from a sample: written, so that both readers below see the same ones
    ranged = scratch.keep(ranged, "winners")
    sizes = ranged.groupBy("range").agg(F.count("*").alias("n"))
    # one row for each range
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*KEY))
    return ranged.join(F.broadcast(starts), "range").select(*KEY, (F.col("start") + place).alias("rank"))


def _key() -> Column:
    return F.struct(*KEY)


def kth_key(keys: DataFrame, k: int, scratch: Scratch) -> Column:
    """The k-th least key (from 1), as a constant: quickselect with several random pivots.

    Each round counts all keys of the part in question below, at and above each pivot, and
    writes the part between the two pivots around the k-th. Keys differ, so parts shrink.
    """
    part, left = keys.select(*KEY), k
    for number in range(200):
        # equal hashes change the choice of pivots only
        drawn = part.orderBy(F.xxhash64(F.lit(number), "third")).limit(PIVOTS).collect()
        pivots = sorted((tuple(r) for r in drawn), key=_order)
        literals = [_literal(p, keys) for p in pivots]
        # 2 i: between pivots i - 1 and i; 2 i + 1: at pivot i
        place = F.lit(0)
        for literal in literals:
            place = place + F.when(_key() > literal, 2).when(_key() == literal, 1).otherwise(0)
        counts = dict(part.groupBy(place.alias("place")).count().collect())
        for place_of in range(2 * len(pivots) + 1):
            here = counts.get(place_of, 0)
            if left <= here:
                break
            left -= here
        if place_of % 2:
            return literals[place_of // 2]
        i = place_of // 2
        if i > 0:
            part = part.filter(_key() > literals[i - 1])
        if i < len(literals):
            part = part.filter(_key() < literals[i])
        part = scratch.keep(part, f"part-{number}")
    raise RuntimeError("keys are not distinct")


def _order(key: tuple) -> tuple:
    first, (missing, identity), third = key
    return first, missing, 0 if missing else identity, third


def _literal(key: tuple, keys: DataFrame) -> Column:
    first, (missing, identity), third = key
    kind = keys.schema["second"].dataType.fields[1].dataType
    second = F.struct(F.lit(missing).alias("missing"), F.lit(identity).cast(kind).alias("id"))
    return F.struct(F.lit(first).cast("long").alias("first"), second.alias("second"), F.lit(third).cast("long").alias("third"))
