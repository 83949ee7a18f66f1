"""Interaction of text filters: what each removes, and what the others would have removed anyway.

A text is measured in one pass of a byte transducer: two states (between words, in a word) and a
table that gives, for a state and a byte, what is counted and whether a word begins or ends. Word
spans go into a hash table that is verified: two spans share an entry only if they are in the same
text and equal byte for byte. Texts are the same where their SHA-256 is.

Documents that fail the same filters behave alike in every order, so they are counted by
language, failures and labels first; only these counts are expanded into all orders of filters.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import Scratch
from feedlake.llm.words import mix, slices

#: What a byte can do, as bits.
BEGINS, ENDS, CAPITAL, CONTINUES, SYMBOL = 1, 2, 4, 8, 16
BETWEEN, INSIDE = 0, 1
FILTERS = "ABCDE"
MEASURES = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]
_BASE = 0x9E3779B97F4A7C15
#: Bytes passed over, or hashed, or compared together.
CHUNK = 1 << 20


def transducer(symbols: bytes = b"#$%&*|") -> tuple[np.ndarray, np.ndarray]:
    """State after each byte, and what happens in each state at each byte (2 x 256)."""
    byte = np.arange(256)
    blank = (byte == 32) | ((byte >= 9) & (byte <= 13))
    after = np.where(blank, BETWEEN, INSIDE).astype(np.uint8)
    alike = np.where((byte >= 65) & (byte <= 90), CAPITAL, 0)
    # bytes that go on with a UTF-8 sequence are no code points of their own
    alike |= np.where((byte & 0xC0) == 0x80, CONTINUES, 0)
    alike |= np.where(np.isin(byte, np.frombuffer(symbols, np.uint8)), SYMBOL, 0)
    acts = np.stack([alike | np.where(blank, 0, BEGINS), alike | np.where(blank, ENDS, 0)])
    return after, acts.astype(np.uint8)


class Measurer:
    """Measures texts that lie one behind another; keeps the powers of the hash's base."""

    def __init__(self, symbols: bytes = b"#$%&*|"):
        after, acts = transducer(symbols)
        self.after, self.acts = after, acts.ravel()
        self.powers = self.inverses = np.ones(1, np.uint64)

    def measure(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A row of MEASURES for each text."""
        texts = len(offsets) - 1
        out = np.zeros((texts, len(MEASURES)), np.int64)
        out[:, 3] = np.diff(offsets)
        filled = np.diff(offsets) > 0
        starts, lasts = offsets[:-1][filled], offsets[1:][filled] - 1
        begins, stops, before = [], [lasts[self.after[data[lasts]] == INSIDE] + 1], BETWEEN
        for at in range(0, len(data), CHUNK):
            part = data[at : at + CHUNK]
            state = np.empty(len(part), np.uint16)
            state[0] = before
            state[1:] = self.after[part[:-1]]
            state[starts[np.searchsorted(starts, at) : np.searchsorted(starts, at + len(part))] - at] = BETWEEN
            before = self.after[part[-1]]
            done = self.acts[(state << np.uint16(8)) | part]
            begins.append(np.flatnonzero(done & BEGINS) + at)
            stops.append(np.flatnonzero(done & ENDS) + at)
            for column, bit, sign in ((2, CAPITAL, 1), (3, CONTINUES, -1), (4, SYMBOL, 1)):
                text = np.searchsorted(offsets, np.flatnonzero(done & bit) + at, "right") - 1
                out[:, column] += sign * np.bincount(text, minlength=texts)
        begin, stop = (np.concatenate([np.zeros(0, np.int64), *found]) for found in (begins, stops))
        stop.sort()
        text = np.searchsorted(offsets, begin, "right") - 1
        out[:, 0] = np.bincount(text, minlength=texts)
        out[:, 1] = np.bincount(text[self.distinct(data, begin, stop, text)], minlength=texts)
        return out

    def hashes(self, data: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of every span, of about CHUNK bytes together."""
        out, first = np.zeros(len(begins), np.uint64), 0
        while first < len(begins):
            end = max(first + 1, int(np.searchsorted(stops, begins[first] + CHUNK, "right")))
            low, high = int(begins[first]), int(stops[end - 1])
            if len(self.powers) <= high - low:
                for name, factor in (("powers", _BASE), ("inverses", pow(_BASE, -1, 1 << 64))):
                    steps = np.concatenate([np.ones(1, np.uint64), np.full(high - low, factor, np.uint64)])
                    setattr(self, name, np.cumprod(steps))
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * self.powers[: high - low], out=sums[1:])
            begin, stop = begins[first:end] - low, stops[first:end] - low
            out[first:end] = mix((sums[stop] - sums[begin]) * self.inverses[begin])
            first = end
        return out

    def distinct(self, data: np.ndarray, begins: np.ndarray, stops: np.ndarray, text: np.ndarray) -> np.ndarray:
        """The spans that are the first entered of their word in their text.

        Open addressing for all spans at once: each round, the spans left claim the slot of
        their probe if it is free, and are done with if the slot's span is theirs or equal.
        """
        count = len(begins)
        size = 1 << max(4, int(2 * count).bit_length())
        slots = np.full(size, -1, np.int64)
        keys = mix(self.hashes(data, begins, stops) + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        length, entered = stops - begins, []
        left, probe = np.arange(count), np.zeros(count, np.uint64)
        while len(left):
            at = ((keys[left] + probe[left]) & np.uint64(size - 1)).astype(np.int64)
            free = slots[at] < 0
            slots[at[free]] = left[free]
            owner = slots[at]
            entered.append(left[owner == left])
            alike = (keys[owner] == keys[left]) & (text[owner] == text[left]) & (length[owner] == length[left]) & (owner != left)
            asked = np.flatnonzero(alike)
            equal = self.same(data, begins[left[asked]], begins[owner[asked]], length[left[asked]])
            done = owner == left
            done[asked[equal]] = True
            left = left[~done]
            probe[left] += np.uint64(1)
        return np.concatenate(entered) if entered else np.zeros(0, np.int64)

    @staticmethod
    def same(data: np.ndarray, one: np.ndarray, two: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether pairs of spans are equal byte for byte; about CHUNK bytes are compared at once."""
        out, first, ends = np.zeros(len(one), bool), 0, np.cumsum(length)
        while first < len(one):
            end = max(first + 1, int(np.searchsorted(ends, ends[first] - length[first] + CHUNK, "right")))
            own = length[first:end]
            start = np.cumsum(own) - own
            inside = np.arange(int(own.sum())) - np.repeat(start, own)
            differs = data[np.repeat(one[first:end], own) + inside] != data[np.repeat(two[first:end], own) + inside]
            out[first:end] = ~np.logical_or.reduceat(differs, start)
            first = end
        return out


def measured(docs: DataFrame, symbols: bytes = b"#$%&*|") -> DataFrame:
    """`docs` without `text`, with MEASURES (long): words parted by ASCII white space, distinct
    ones (case counts), A to Z, code points and symbols. NULL text is empty. Input columns of
    these names are replaced, all others stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measurer = Measurer(symbols)
        for batch in batches:
            found = [measurer.measure(data, offsets) for _, data, offsets in slices(batch.column("text"))]
            found = np.concatenate([np.zeros((0, len(MEASURES)), np.int64), *found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(found[:, i]) for i in range(len(MEASURES)))], names=["row", *MEASURES]
            )

    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("text", *MEASURES)]
    packed = docs.select(F.struct(*others).alias("row"), F.col("text"))
    schema = packed.select("row").schema
    for name in MEASURES:
        schema = schema.add(name, "long")
    return packed.mapInArrow(run, schema).select("row.*", *MEASURES)


def failures() -> Column:
    """Bits of the filters A to D that a measured text fails; E needs the other texts."""
    fails = [
        F.col("n_words") < 100,
        100 * F.col("n_distinct") < 80 * F.col("n_words"),
        100 * F.col("n_capitals") > 10 * F.col("n_points"),
        F.col("n_symbols") > 0,
    ]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`part`, `fails` (bits of A to E), `good`, `toxic` and the number `n` of such documents.

    Copies are counted together before anything is joined, so that a text, an id or a language
    that holds a large part of the rows is a few rows by then. Joins have exchanges of their own
    on both sides, which adaptive execution can split.
    """
    rows = docs.select(
        F.col("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")
    )
    narrow = measured(rows.withColumn("sha", F.unhex(F.sha2("text", 256))))
    counted = narrow.select("doc_id", "part", "sha", failures().alias("fails")).groupBy("doc_id", "part", "sha", "fails").agg(F.count("*").alias("n"))
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    labelled = counted.hint("rebalance").join(known.hint("rebalance"), "doc_id", "left").select(
        *counted.columns, F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic")
    )
    # of each text: documents of each kind, and how many of them have its smallest id
    kinds = labelled.groupBy("sha", "part", "fails", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).getField("n").alias("at_least"),
    )
    # written once, so that texts are passed once for both uses
    kinds = Scratch(docs.sparkSession, "audit").keep(kinds, "kinds")
    least = kinds.groupBy("sha").agg(F.min("least").alias("first"))
    # a kind is one row for each text and labels, so no text has many of them
    joined = kinds.join(least, "sha")
    first = F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0) + F.col("nameless")
    split = joined.select(
        "part", "good", "toxic", F.inline(F.array(
            F.struct(F.col("fails").alias("fails"), first.alias("n")),
            F.struct((F.col("fails") + 16).alias("fails"), (F.col("n") - first).alias("n")),
        )),
    )
    return split.groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each `part` (language; NULL: empty), `filter_order` and `step`: what its filter does.

    `kept`, `removed`, `redundant` (failing, but removed before), `unique_fails` (failing no other
    filter), `good_lost`, `toxic_lost` (of those removed) and `shapley` (removed by the filter,
    summed over all orders); all long. A: under 100 words; B: less than 80 % of the words
    distinct; C: more than 10 % of the code points A to Z; D: a symbol; E: a smaller doc_id has
    the same text, whatever happens to that one.

    NULL text is empty, and as such a copy of other empty texts. A row without doc_id is no
    copy and makes none. Rows of one id count each; their texts are no copies of one another. Of
    several labels of one id the largest counts. Other columns are ignored; an empty table gives
    no rows.
    """
    bits = {f: 1 << i for i, f in enumerate(FILTERS)}
    steps = [
        {"filter_order": "".join(order), "step": i + 1, "bit": bits[f], "before": sum(bits[g] for g in order[:i])}
        for order in permutations(FILTERS)
        for i, f in enumerate(order)
    ]
    # a constant of 600 rows, which every cell meets; a part has at most 128 cells
    table = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, bit int, before int>>")
    each = cells(docs, labels).select("*", F.inline(table))
    fails = F.col("fails").bitwiseAND(F.col("bit")) != 0
    gone = F.col("fails").bitwiseAND(F.col("before")) != 0
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    # orders in which a failing filter comes first of those that fail
    turns = F.expr("120 div greatest(bit_count(fails), 1)")
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("fails") == F.col("bit")).alias("unique_fails"),
        total(fails & ~gone & F.col("good")).alias("good_lost"),
        total(fails & ~gone & F.col("toxic")).alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * turns).otherwise(0)).alias("shapley"),
    )
