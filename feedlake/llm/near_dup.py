"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its shingles of five words; a weight is the count in the
document times a smoothed inverse document frequency. A consistent weighted sample picks one
(shingle, level) such that two documents pick the same with the probability of their weighted
Jaccard similarity. `BANDS` bands of `ROWS` samples each are hashed; documents that share a
band are candidates and are verified by the exact weighted Jaccard similarity of their whole
texts.

Document frequencies are exact over all documents and for every shingle. Documents are dealt to
chunks; the distinct shingles of a chunk go, sorted and packed, to ranges of hashes, where they
are summed over all chunks, and the sums return to each chunk in the order of its shingles. What
is sent is 8 bytes and a count for each distinct shingle of a chunk, however frequent it is.

Equal texts are one from the start. Within a bucket no pair is made that is not needed:
members are verified against one pivot, then those of other components against a few more.
Large buckets that are still not one component owe it to a passage that many documents share;
what is apart in them is compared in tiles within the tasks. Pairs go on to be verified unless a
bound on their similarity rules out the threshold. The bound comes from the weights of either
text summed over `SUMS` cells of its shingles: what two texts share in a cell is at most the
smaller sum. Before it only pairs go of which fewer than `AGREE` samples agree, at the threshold
one in ten million.

Nodes are distinct texts, each with a number of its own, so that bands, samples and text of a
node always belong together. Texts of one document are linked as such.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import Scratch, add_columns, components
from feedlake.llm.words import Hasher, mix, shingles, slices

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 5
#: What share of all shingles `shingle_weights` lists as frequent, as its inverse.
FREQUENT = 1 << 17
#: Shingles of a chunk of documents, about; a range of hashes has RANGE times as many. Bytes of
#: text that stand for a shingle in this.
HELD, RANGE, SHINGLE_BYTES = 1 << 19, 4, 6
#: How much a shingle in every document weighs less than one in none: 1 against 1 + IDF * ln(N).
IDF = 0.05
#: Draws for the samples come from tables of so many entries, looked up by hash.
TABLE_BITS = 16
#: Shingles of a set that are expected to lie below the mark beyond which none is looked at; a set
#: of which none does, 3 in 10,000, is looked at whole.
EXPECTED = 8.0
#: Shingles whose draws are looked up at once.
DRAWN = 1 << 15
#: Pivots of a bucket in the second round.
PIVOTS = 8
#: Samples two texts must agree in to be verified without a pivot: at the threshold 64 of 80 are
#: expected, and fewer than 44 seen once in ten million pairs; bands miss 20,000 times as many.
AGREE = 44
#: Cells a text's shingles are summed in, a power of two. Sums are kept as bytes, rounded up to a
#: step of GRID; those beyond the last step stand for no bound.
SUMS = 256
GRID = np.concatenate([[0.0], 0.9 * 1.03 ** np.arange(254), [np.inf]])
#: Pairs whose sums are compared at once.
PAIRS_CHUNK = 8192
TILE_ROWS, TILE_CHUNK = 2048, 256
#: Nodes whose texts are needed that may be broadcast to the scan of the texts.
BROADCAST_IDS = 1_000_000
#: Members a pivot's text is sent to together.
MEMBERS = 512


class Sampler:
    """Consistent weighted samples: for each shingle draws r, c ~ Gamma(2, 1), b ~ U(0, 1).

    With a weight w: t = floor(ln w / r + b), y = exp(r (t - b)), a = c / (y e^r); the sample is
    the shingle of least a. As a follows from shingle and level, it stands for both. Logarithms
    throughout; a share of the hash separates shingles that look up the same draws.
    """

    def __init__(self) -> None:
        rng = np.random.default_rng(20_100)
        size = 1 << TABLE_BITS
        r = rng.gamma(2.0, 1.0, size)
        self.r, self.inverse = r.astype(np.float32), (1 / r).astype(np.float32)
        self.b = rng.random(size).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, size)).astype(np.float32)
        self.factors = (rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def _draws(self, mixed: np.ndarray, log_weights: np.ndarray) -> np.ndarray:
        """Logarithms of a."""
        at = (mixed >> np.uint64(64 - TABLE_BITS)).astype(np.intp)
        r, b = self.r[at], self.b[at]
        a = self.log_c[at] - r * (np.floor(log_weights * self.inverse[at] + b) - b + np.float32(1))
        a += ((mixed >> np.uint64(16)) & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(1e-9)
        return a

    def bands(self, hashes: np.ndarray, log_weights: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band hashes and a byte of each sample, a row for each set; `starts` of non-empty sets."""
        out = np.zeros((len(starts), BANDS), np.uint64)
        samples = np.zeros((len(starts), BANDS * ROWS), np.uint8)
        # sets together, so that what is looked up stays in the processor's cache
        first = np.flatnonzero(np.diff(starts // DRAWN, prepend=-1))
        for i, j in zip(first.tolist(), [*first[1:].tolist(), len(starts)], strict=True):
            own = slice(starts[i], starts[j] if j < len(starts) else len(hashes))
            least = self._least(hashes[own], log_weights[own], starts[i:j] - starts[i])
            for band in range(BANDS):
                value = np.full(j - i, np.uint64(band + 1))
                for k in range(band * ROWS, band * ROWS + ROWS):
                    sample = mix(least[k].view(np.uint32).astype(np.uint64))
                    samples[i:j, k] = sample >> np.uint64(56)
                    value = mix(value ^ sample) + np.uint64(k)
                out[i:j, band] = value
        return out, samples

    def _least(self, hashes: np.ndarray, log_weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The least draw of every set, a row for each sample.

        a is exponential, so the least of a set lies below EXPECTED / its size but rarely. A draw
        is no less than that of the same entry with a larger weight, so entries whose draw with
        the weight `usual` is beyond the mark are left out for all shingles that weigh no more.
        """
        ends = np.append(starts[1:], len(hashes))
        mark = (np.log(EXPECTED) - np.log(ends - starts)).astype(np.float32)
        usual = np.partition(log_weights, place := len(log_weights) * 9 // 10)[place]
        lowest = self.log_c - self.r * (np.floor(usual * self.inverse + self.b) - self.b + np.float32(1))
        marks = np.where(log_weights <= usual, np.repeat(mark, ends - starts), np.float32(np.inf))
        least = np.empty((BANDS * ROWS, len(starts)), np.float32)
        mixed, at, draw = np.empty_like(hashes), np.empty(len(hashes), np.intp), np.empty(len(hashes), np.float32)
        for k, factor in enumerate(self.factors):
            np.multiply(hashes, factor, out=mixed)
            np.right_shift(mixed, np.uint64(64 - TABLE_BITS), out=at.view(np.uint64))
            low = np.flatnonzero(np.take(lowest, at, out=draw, mode="clip") <= marks)
            bounds = np.searchsorted(low, np.append(starts, len(hashes)))
            full = np.flatnonzero(np.diff(bounds))
            least[k] = np.inf
            if len(full):
                least[k, full] = np.minimum.reduceat(self._draws(mixed[low], log_weights[low]), bounds[full])
            for missed in np.flatnonzero(~(least[k] <= mark)).tolist():
                own = slice(starts[missed], ends[missed])
                least[k, missed] = self._draws(mixed[own], log_weights[own]).min()
        return least


class Weights(NamedTuple):
    """Shingles, ascending, and the number of documents that hold each."""

    hashes: np.ndarray
    counts: np.ndarray


def idf(documents: int, frequencies: np.ndarray) -> np.ndarray:
    return 1 + IDF * np.log(np.maximum(1.0, documents / np.maximum(frequencies, 1)))


def cell_sums(distinct: np.ndarray, weights: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each of the sets of these sizes the summed weights of its cells, as steps of GRID."""
    own = np.repeat(np.arange(len(sizes)), sizes) * SUMS + (distinct % np.uint64(SUMS)).astype(np.intp)
    sums = np.bincount(own, weights, minlength=len(sizes) * SUMS)
    # rounding up, and a little more than the errors of a sum
    return np.searchsorted(GRID, sums * (1 + 1e-9)).astype(np.uint8).reshape(len(sizes), SUMS)


def most_similar(left: np.ndarray, right: np.ndarray, left_totals: np.ndarray, right_totals: np.ndarray) -> np.ndarray:
    """What the weighted Jaccard similarity of pairs of sets is at most, by their cell sums."""
    both = GRID[np.minimum(left, right)].sum(axis=1)
    both = np.minimum(both, np.minimum(left_totals, right_totals))
    return both / (left_totals + right_totals - both)


def _sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, distinct shingles, their counts, bounds of the texts), part by part."""
    hasher = Hasher()
    for at, data, offsets in slices(texts):
        found, bounds = shingles(*hasher.words(data, offsets), SHINGLE_WORDS)
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            found[start:end].sort()
        new = np.ones(len(found), bool)
        new[1:] = found[1:] != found[:-1]
        new[bounds[:-1][bounds[:-1] < len(found)]] = True
        places = np.flatnonzero(new)
        counts = np.diff(np.append(places, len(found)))
        yield at, found[places], counts, np.searchsorted(places, bounds)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on in the fewest bytes that hold the largest of them."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0)))).tobytes()


def _unpacked(packed: bytes, count: int) -> np.ndarray:
    return np.frombuffer(packed, f"u{len(packed) // count}").astype(np.int64) if count else np.zeros(0, np.int64)


def _distinct(texts: pa.ChunkedArray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """`_sets` of all parts of a column; rows are numbered through."""
    found, before = [], 0
    for part in texts.chunks:
        found += [(before + at, *rest) for at, *rest in _sets(part)]
        before += len(part)
    return found


def _chunk_counter(ranges: int) -> Callable:
    """The distinct shingles of a chunk and their documents in it, a row for each range of hashes."""

    def count(chunk: pa.Table) -> pa.Table:
        own = [np.zeros(0, np.uint64), *(distinct for _, distinct, _, _ in _distinct(chunk.column("text")))]
        shingle, documents = np.unique(np.concatenate(own), return_counts=True)
        number = ((shingle >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        full, starts = np.unique(number, return_index=True)
        parts = [slice(a, b) for a, b in zip(starts, np.append(starts, len(number))[1:], strict=True)]
        return pa.table(
            {
                "chunk": pa.array(np.full(len(full), chunk.column("chunk")[0].as_py(), np.int64)),
                "range": pa.array(full, pa.int64()),
                "shingles": pa.array([shingle[p].tobytes() for p in parts], pa.binary()),
                "documents": pa.array([_packed(documents[p]) for p in parts], pa.binary()),
            }
        )

    return count


COUNTED = "chunk long, range long, shingles binary, documents binary"


def _summed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a range and their documents over all chunks, the documents of each
    packed shingle in its place, and the number of shingles of each row.

    A range is the most a task holds, so arrays are read where they lie and dropped early.
    """
    shingle, ends = _joined(rows.column("shingles"))
    shingle, sizes = shingle.view(np.uint64), np.diff(ends // 8)
    packed, places = _joined(rows.column("documents"))
    documents, done = np.empty(len(shingle), np.uint32), 0
    for start, end, size in zip(places[:-1].tolist(), places[1:].tolist(), sizes.tolist(), strict=True):
        documents[done : done + size] = packed[start:end].view(f"u{(end - start) // size}") if size else 0
        done += size
    order = np.argsort(shingle).astype(np.uint32)
    distinct = shingle[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(distinct)), bool), distinct[1:] != distinct[:-1]]))
    distinct = distinct[starts]
    if len(starts):
        sums = np.add.reduceat(documents[order], starts, dtype=np.int64)
    else:
        sums = np.zeros(0, np.int64)
    documents = documents.astype(np.min_scalar_type(int(sums.max(initial=0))))
    documents[order] = np.repeat(sums.astype(documents.dtype), np.diff(np.append(starts, len(order))))
    return distinct, sums, documents, sizes


def _joined(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, one behind another, and where each row starts; the end last."""
    parts, starts, done = [np.zeros(0, np.uint8)], [np.zeros(1, np.int64)], 0
    for chunk in column.chunks:
        _, offsets, data = chunk.buffers()
        kind = np.int64 if pa.types.is_large_binary(chunk.type) else np.int32
        places = np.frombuffer(offsets, kind, len(chunk) + 1 + chunk.offset)[chunk.offset :].astype(np.int64)
        if data is not None and data.size:
            parts.append(np.frombuffer(data, np.uint8)[places[0] : places[-1]])
        starts.append(places[1:] - places[0] + done)
        done = int(starts[-1][-1]) if len(chunk) else done
    full = [part for part in parts if len(part)]
    return full[0] if len(full) == 1 else np.concatenate(parts), np.concatenate(starts)


def _sum_range(rows: pa.Table) -> pa.Table:
    """For each chunk the documents of its shingles of this range, in their order."""
    _, _, documents, sizes = _summed(rows)
    own = np.split(documents, np.cumsum(sizes)[:-1])
    return pa.table(
        {
            "chunk": rows.column("chunk"),
            "range": rows.column("range"),
            "size": pa.array(sizes),
            "documents": pa.array([_packed(d) for d in own], pa.binary()),
        }
    )


def _counted(rows: DataFrame, size: int, *by: str) -> tuple[DataFrame, DataFrame]:
    """`rows` with `chunk`, by the hash of columns, and COUNTED; `size` is the bytes of all texts."""
    chunks = 1 + size // (SHINGLE_BYTES * HELD)
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64(*by), F.lit(chunks)))
    ranges = 1 + size // (SHINGLE_BYTES * HELD * RANGE)
    return dealt, dealt.groupBy("chunk").applyInArrow(_chunk_counter(ranges), COUNTED)


def _size(docs: DataFrame) -> tuple[int, int]:
    """Number of rows, and of bytes of all texts."""
    return docs.select(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()


def shingle_weights(docs: DataFrame) -> Weights:
    """The shingles that are at least 1/`FREQUENT` of all, with their exact document frequencies.

    There are at most `FREQUENT` of them, whatever the corpus.
    """
    texts = docs.select("text")
    _, counted = _counted(texts, _size(texts)[1], "text")

    def sums(rows: pa.Table) -> pa.Table:
        distinct, documents, _, _ = _summed(rows)
        return pa.table({"shingle": pa.array(distinct.view(np.int64)), "documents": pa.array(documents)})

    counts = counted.groupBy("range").applyInArrow(sums, "shingle long, documents long")
    counts = Scratch(docs.sparkSession, "shingles").keep(counts, "counts")
    least = (counts.agg(F.sum("documents")).first()[0] or 0) / FREQUENT
    frequent = counts.filter(F.col("documents") >= F.lit(least)).toPandas()
    hashes = frequent["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Weights(hashes[order], frequent["documents"].to_numpy(np.int64)[order])


def similarity(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (shingles ascending, weights); 0 if either is empty."""
    (a, wa), (b, wb) = left, right
    if not len(a) or not len(b):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = np.minimum(wa[i], wb[j]).sum()
    return float(both / (wa.sum() + wb.sum() - both))


SIGNED = "doc_id long, h1 long, h2 long, bands array<long>, samples binary, sums binary, total double, frequencies binary"


def _signer(documents: int) -> Callable:
    """Samples of the texts of a chunk, with the frequencies of each text's shingles, ascending."""

    def sign(chunk: pa.Table, summed: pa.Table) -> pa.Table:
        sampler, kept = Sampler(), [pa.Table.from_batches([], _signed_schema())]
        sets = _distinct(chunk.column("text"))
        own = [np.zeros(0, np.uint64), *(distinct for _, distinct, _, _ in sets)]
        known, place = np.unique(np.concatenate(own), return_inverse=True)
        summed = summed.sort_by("range")
        parts = zip(summed.column("documents").to_pylist(), summed.column("size").to_pylist(), strict=True)
        sums_of = np.concatenate([np.zeros(0, np.int64), *(_unpacked(p, n) for p, n in parts)])
        if len(sums_of) != len(known):
            raise ValueError("a chunk of documents has changed since its shingles were counted")
        done = 0
        for at, distinct, counts, bounds in sets:
            frequencies = sums_of[place[done : done + len(distinct)]]
            done += len(distinct)
            full = np.flatnonzero(np.diff(bounds))
            if not len(full):
                continue
            starts = bounds[:-1][full]
            values = counts * idf(documents, frequencies)
            totals = np.add.reduceat(values, starts)
            sums = cell_sums(distinct, values, np.diff(bounds)[full])
            bands, samples = sampler.bands(distinct, np.log(values).astype(np.float32), starts)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1) * BANDS, pa.int32()), pa.array(bands.ravel().view(np.int64)))
            binary = [pa.array([s.tobytes() for s in rows], pa.binary()) for rows in (samples, sums)]
            packed = pa.array([_packed(frequencies[bounds[i] : bounds[i + 1]]) for i in full.tolist()], pa.binary())
            rows = chunk.select(["doc_id", "h1", "h2"]).take(pa.array(full + at))
            kept.append(pa.table([*rows.columns, lists, *binary, pa.array(totals), packed], schema=_signed_schema()))
        return pa.concat_tables(kept)

    return sign


def _signed_schema() -> pa.Schema:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.float64(), pa.binary()]
    return pa.schema(list(zip([c.split()[0] for c in SIGNED.split(", ")], kinds, strict=True)))


def _verifier(documents: int, threshold: float) -> Callable:
    """Reads a pivot's text (no `a`) before the texts it is compared with."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot: tuple[np.ndarray, np.ndarray] = np.zeros(0, np.uint64), np.zeros(0)
        for batch in batches:
            member = batch.column("a").is_valid().to_numpy(zero_copy_only=False)
            kept = []
            for at, distinct, counts, bounds in _sets(batch.column("text")):
                for row in range(len(bounds) - 1):
                    own = slice(bounds[row], bounds[row + 1])
                    frequencies = _unpacked(batch.column("frequencies")[at + row].as_py(), int(bounds[row + 1] - bounds[row]))
                    found = distinct[own], counts[own] * idf(documents, frequencies)
                    if not member[at + row]:
                        pivot = found[0].copy(), found[1]
                    elif similarity(found, pivot) >= threshold:
                        kept.append(at + row)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return verify


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with `class_id` (smallest doc_id reachable by links) and `kept` (it is the own one).

    Documents link if their weighted Jaccard similarity is at least `threshold`, or if their
    texts are equal and not empty. A pair shares a band with a probability of 0.998 at 0.8 and
    agrees in enough samples with 0.9999999, more above; a pair that does both is a candidate. A text of fewer than five words is one shingle
    of all its words. NULL and empty texts link with nothing, texts without any word only with
    equal ones. Rows that share a doc_id are one document, which links by each of its texts. Rows
    without an id link with nothing: class_id NULL, kept true.
    Input columns of the two names are replaced, all others stay.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "near-dup")
    hashes = (F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    documents, size = _size(own)
    texts = own.filter(F.col("doc_id").isNotNull() & (F.col("text") != "")).select("doc_id", *hashes, "text")
    ids = texts.select("doc_id", "h1", "h2")
    # a node for each distinct text; written once, so that the numbers stay
    nodes = ids.groupBy("h1", "h2").agg(F.min("doc_id").alias("least")).withColumn("node", F.monotonically_increasing_id())
    nodes = scratch.keep(nodes, "nodes")
    named = nodes.select("h1", "h2", F.col("least").alias("doc_id"), "node")
    # frequencies count every row, those without an id as well
    dealt, counted = _counted(own.filter(F.col("text") != "").select("doc_id", *hashes, "text"), size, "doc_id", "h1", "h2")
    summed = counted.groupBy("range").applyInArrow(_sum_range, "chunk long, range long, size long, documents binary")
    signed = dealt.groupBy("chunk").cogroup(summed.groupBy("chunk")).applyInArrow(_signer(documents), SIGNED)
    signed = scratch.keep(signed, "signed")
    # repeated rows of a node's document hold its one text, so all of them have the same values
    first = signed.join(named, ["h1", "h2", "doc_id"]).groupBy(F.col("node").alias("id"))
    first = scratch.keep(first.agg(*(F.first(c).alias(c) for c in ("bands", "samples", "sums", "total", "frequencies"))), "first")
    members = first.select("id", F.posexplode("bands").alias("band", "hash"))
    members = scratch.keep(members, "members")
    crowded = members.groupBy("band", "hash").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    crowded = scratch.keep(crowded.filter("least < most").select("band", "hash"), "buckets")
    members = scratch.keep(members.join(crowded, ["band", "hash"], "left_semi"), "members")
    # a document of several texts is all of their nodes: they are linked to the first of them
    held = ids.join(nodes.select("h1", "h2", "node"), ["h1", "h2"]).select("doc_id", "node").distinct()
    several = held.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("most")).filter("b < most")
    own_links = held.join(several.select("doc_id", "b"), "doc_id").filter("node <> b").select(F.col("node").alias("a"), "b")
    links = scratch.keep(own_links, "links")
    groups = None
    for pivots in (1, PIVOTS, 0):
        pairs = scratch.keep(_pairs(members, groups, pivots, first, threshold, scratch), "pairs")
        if pairs.isEmpty():
            continue
        read = _with_texts(pairs, texts, named, first)
        found = scratch.keep(read.mapInArrow(_verifier(documents, threshold), "a long, b long"), "verified")
        links = links.unionByName(found)
        groups = components(links, scratch)
    if groups is None:
        groups = components(links, scratch)
    table = nodes.join(groups, "node", "left").select("h1", "h2", "least", F.coalesce("component", "node").alias("group"))
    table = scratch.keep(table, "grouped")
    smallest = table.groupBy("group").agg(F.min("least").alias("class"))
    table = scratch.keep(table.join(smallest, "group").select("h1", "h2", "class"), "table")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), *hashes)
    rows = rows.join(table, ["h1", "h2"], "left")
    named = rows.select(
        "row.*", F.when(F.col("id").isNotNull(), F.coalesce("class", "id")).alias("__class"), F.col("id").alias("__id")
    )
    kept = F.coalesce(F.col("__class") == F.col("__id"), F.lit(True))
    return add_columns(named, class_id=F.col("__class"), kept=kept).drop("__class", "__id")


def _pairs(
    members: DataFrame, groups: DataFrame | None, pivots: int, signed: DataFrame, threshold: float, scratch: Scratch
) -> DataFrame:
    """Pairs (a, b) to verify, each once: members of a bucket with its pivots, or close ones.

    `pivots` is the number of pivots of a bucket, the smallest ids of as many hash classes; 0
    stands for `_close_pairs`. With `groups`, only pairs of different components count.
    """
    if groups is not None:
        component = groups.select(F.col("node").alias("id"), "component")
        members = members.join(component, "id", "left").withColumn("component", F.coalesce("component", "id"))
    else:
        members = members.withColumn("component", F.col("id"))
    if not pivots:
        return _close_pairs(members, signed, threshold, scratch)
    salt = F.pmod(F.xxhash64("id"), F.lit(pivots))
    chosen = members.groupBy("band", "hash", salt.alias("salt")).agg(
        F.min_by(F.struct("id", "component"), "id").alias("p")
    )
    # as many as `pivots`
    chosen = chosen.groupBy("band", "hash").agg(F.collect_list("p").alias("pivots"))
    others = F.transform(F.filter("pivots", lambda p: p["component"] != F.col("component")), lambda p: p["id"])
    joined = members.join(chosen, ["band", "hash"]).select("id", others.alias("others")).filter(F.size("others") > 0)
    # a text meets the same pivot in several bands; it has one list a band
    joined = joined.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
    found = joined.select("id", F.explode("others").alias("pivot"))
    return found.select(F.greatest("id", "pivot").alias("a"), F.least("id", "pivot").alias("b")).distinct()


def _close_pairs(members: DataFrame, signed: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Pairs of different components that share a bucket and may reach the threshold.

    A bucket is compared in tiles of at most TILE_ROWS by TILE_ROWS texts, whose samples and cell
    sums are bytes. Only pairs leave the task that agree in `AGREE` samples and whose similarity
    may be the threshold by their total weights and their cell sums, each from the first bucket
    it shares.
    """
    open_ = members.groupBy("band", "hash").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("count")
    )
    blocks = F.ceil(F.col("count") / TILE_ROWS).cast("int").alias("blocks")
    open_ = scratch.keep(open_.filter("low < high").select("band", "hash", "count", blocks), "open")
    dealt = 1 + (open_.agg(F.sum("count")).first()[0] or 0) // TILE_ROWS
    rows = members.join(open_.drop("count"), ["band", "hash"])
    rows = rows.join(signed, "id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    # buckets of one block go together to groups of about the same size; they are many and small
    whole = F.col("blocks") == 1
    rows = rows.withColumns(
        {
            "deal": F.when(whole, F.pmod(F.xxhash64("band", "hash"), F.lit(dealt))),
            "tile": F.when(~whole, F.struct("band", "hash", "low", "high")),
        }
    )
    chosen = rows.select("deal", "tile", "band", "hash", "low", "high", "block", "id", "component", "bands", "samples", "sums", "total")
    return chosen.groupBy("deal", "tile").applyInArrow(_tiles(threshold - 1e-9), "a long, b long").distinct()


def _tiles(least: float) -> Callable:
    """Compares the tiles of a group of rows, each by itself."""

    def tiles(rows: pa.Table) -> pa.Table:
        keys = ("band", "hash", "low", "high", "block", "id", "component", "total")
        band, hash_, low, high, block, ids, groups, totals = (rows.column(c).to_numpy() for c in keys)
        bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(rows), BANDS)
        samples = _joined(rows.column("samples"))[0].reshape(len(rows), BANDS * ROWS)
        sums = _joined(rows.column("sums"))[0].reshape(len(rows), SUMS)
        order = np.lexsort((high, low, hash_, band))
        new = np.zeros(len(rows), bool)
        for key in (band, hash_, low, high):
            new[1:] |= key[order][1:] != key[order][:-1]
        found = [np.zeros((0, 2), np.int64)]
        for tile in np.split(order, np.flatnonzero(new)):
            one = tile[block[tile] == low[tile[0]]]
            right = tile[block[tile] == high[tile[0]]]
            for at in range(0, len(one) if len(right) else 0, TILE_CHUNK):
                left = one[at : at + TILE_CHUNK]
                i, j = np.nonzero(
                    (_agreeing(samples[left], samples[right]) >= AGREE) & (groups[left][:, None] != groups[right][None, :])
                )
                i, j = left[i], right[j]
                own, other = totals[i], totals[j]
                possible = np.minimum(own, other) >= least * np.maximum(own, other)
                if low[tile[0]] == high[tile[0]]:
                    possible &= ids[i] > ids[j]
                i, j = i[possible], j[possible]
                first = (bands[i] == bands[j]).argmax(axis=1) == band[tile[0]]
                i, j = i[first], j[first]
                for part in range(0, len(i), PAIRS_CHUNK):
                    a, b = i[part : part + PAIRS_CHUNK], j[part : part + PAIRS_CHUNK]
                    close = most_similar(sums[a], sums[b], totals[a], totals[b]) >= least
                    found.append(np.stack([ids[a[close]], ids[b[close]]], axis=1))
        pairs = np.concatenate(found)
        return pa.table({"a": pa.array(pairs.max(axis=1, initial=-(2**63))), "b": pa.array(pairs.min(axis=1, initial=2**63 - 1))})

    return tiles


def _agreeing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The number of samples in which each row of `left` agrees with each of `right`."""
    if len(left) * len(right) <= PAIRS_CHUNK // 2:
        return np.count_nonzero(left[:, None, :] == right[None, :, :], axis=2)
    same, columns = np.zeros((len(left), len(right)), np.uint8), np.ascontiguousarray(right.T)
    for k in range(BANDS * ROWS):
        same += left[:, k, None] == columns[k]
    return same


def _with_texts(pairs: DataFrame, texts: DataFrame, named: DataFrame, signed: DataFrame) -> DataFrame:
    """Rows (a, b, text, frequencies): of each pivot b its own text, a being NULL, and then those of its members.

    A pivot's text goes once to every MEMBERS of them, so that no pivot is a task of its own.
    """
    ids = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = named.join(ids, "node")
    wanted = F.broadcast(wanted) if ids.count() <= BROADCAST_IDS else wanted
    # repeated rows hold the same text
    needed = texts.join(wanted, ["h1", "h2", "doc_id"]).groupBy("node").agg(F.first("text").alias("text"))
    needed = needed.join(signed.select(F.col("id").alias("node"), "frequencies"), "node")
    crowds = pairs.groupBy("b").agg(F.ceil(F.count("*") / MEMBERS).alias("salts")).filter("salts > 1")
    salted = pairs.join(crowds, "b", "left").select(
        "a", "b", F.pmod(F.xxhash64("a"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt")
    )
    members = salted.join(needed.withColumnRenamed("node", "a"), "a")
    none, read = F.lit(None).cast("long").alias("a"), ["text", "frequencies"]
    pivots = salted.select("b", "salt").distinct().join(needed.withColumnRenamed("node", "b"), "b").select(none, "b", "salt", *read)
    rows = members.select("a", "b", "salt", *read).unionByName(pivots)
    return rows.repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first()).select("a", "b", *read)
