"""Packing documents into sequences by a grouping genetic algorithm on islands.

A document is its token ids and a closing id. Longer ones are cut into full pieces after a
first piece that takes the remainder, so only one piece of a document has to be packed. The
pieces to pack are dealt to shards of bounded size. Each shard is solved by several islands, a
task each: a population of packings evolves by grouping crossover (whole well-filled bins of
one parent are injected into the other, bins that now repeat a piece are removed, and pieces
that lost their bin are put back by best fit) and by dissolving poorly filled bins. After each
epoch the elite of an island migrates to the next one. Well-filled bins of the best packing
are final; the pieces of the others are dealt anew to fewer shards, until one shard is left or
nothing is gained.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import Scratch

CAPACITY = 2048
END_ID = 0
SHARD_PIECES = 2048
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 2, 2, 3, 4
#: A bin is final from this fill on.
WELL_FILLED = 0.98
#: Texts are encoded in calls of about so many characters.
CALL_CHARS = 1 << 21

Encoder = Callable[[list[str]], list[list[int]]]
Bins = list[list[int]]


def byte_bpe() -> Encoder:
    """Ids of the public byte-level BPE with 50,257 entries.

    Its ranks are read with tiktoken, whose ids equal those of the tokenizers library at three
    times the speed (a test holds both against each other).
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    special = {"<|endoftext|>": len(ranks)}
    encoding = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(texts: list[str]) -> list[list[int]]:
        return [encoding.encode(t, allowed_special="all") if "<|endoftext|>" in t else encoding.encode_ordinary(t) for t in texts]

    return encode


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, encoder: Callable[[], Encoder] = byte_bpe, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: `doc_id`, `piece`, `start`, `length`, `ids_crc32`, and `ids`
    if asked for. NULL or empty text is the closing id alone."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for batch in batches:
            for rows in _calls(batch):
                out: list[tuple] = []
                texts = [t or "" for t in rows.column(1).to_pylist()]
                for doc_id, ids in zip(rows.column(0).to_pylist(), encode(texts), strict=True):
                    tokens = np.array([*ids, END_ID], "<u4")
                    first = (len(tokens) - 1) % capacity + 1
                    ends = range(first, len(tokens) + 1, capacity)
                    for number, end in enumerate(ends):
                        start = end - first if number == 0 else end - capacity
                        own = tokens[start:end]
                        out.append((doc_id, number, start, end - start, zlib.crc32(own.tobytes()), own))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
                columns = [pa.array([o[i] for o in out], kinds[i]) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(pieces, PIECES + (", ids array<int>" if with_ids else ""))


def _calls(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about CALL_CHARS bytes of text, one row at least."""
    sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(batch):
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), CALL_CHARS)))
        yield batch.slice(at, end - at)
        at = end


class _Free:
    """Bins by free space; the tightest that takes a size is the lowest set bit of a mask."""

    def __init__(self, sizes: list[int], bins: Bins, capacity: int):
        self.sizes, self.bins, self.capacity = sizes, bins, capacity
        self.mask, self.by_space = 0, {}
        for number, own in enumerate(bins):
            self._file(number, capacity - sum(sizes[i] for i in own))

    def _file(self, number: int, space: int) -> None:
        self.by_space.setdefault(space, []).append(number)
        self.mask |= 1 << space

    def place(self, item: int) -> None:
        size = self.sizes[item]
        fits = self.mask >> size
        if not fits:
            self.bins.append([item])
            self._file(len(self.bins) - 1, self.capacity - size)
            return
        space = size + (fits & -fits).bit_length() - 1
        numbers = self.by_space[space]
        number = numbers.pop()
        if not numbers:
            self.mask &= ~(1 << space)
        self.bins[number].append(item)
        self._file(number, space - size)


def best_fit(sizes: list[int], bins: Bins, items: list[int], capacity: int) -> Bins:
    """`bins` with `items` added, each to the bin it fills best or to a new one."""
    free = _Free(sizes, bins, capacity)
    for item in items:
        free.place(item)
    return bins


def _fitness(sizes: list[int], bins: Bins, capacity: int) -> tuple[int, float]:
    """Smaller is better: bins, then minus the mean squared fill."""
    return len(bins), -sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def _crossover(sizes: list[int], into: Bins, source: Bins, capacity: int, rng: np.random.Generator) -> Bins:
    fills = np.array([sum(sizes[i] for i in b) for b in source])
    well = np.flatnonzero(fills >= np.median(fills))
    chosen = rng.choice(well, size=max(1, len(well) // 4), replace=False)
    injected = [list(source[i]) for i in chosen]
    present = {i for b in injected for i in b}
    child, displaced = injected, []
    for own in into:
        if present.isdisjoint(own):
            child.append(list(own))
        else:
            displaced += [i for i in own if i not in present]
    return _reinsert(sizes, child, displaced, capacity, rng)


def _reinsert(sizes: list[int], bins: Bins, items: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    """Dissolve some of the emptiest bins and put their pieces and `items` back, largest first."""
    fills = np.array([sum(sizes[i] for i in b) for b in bins] or [0])
    loose = np.argsort(fills + rng.integers(0, capacity // 8, len(fills)))[: max(1, len(bins) // 20)]
    gone = {int(n) for n in loose if n < len(bins)}
    items = items + [i for n in gone for i in bins[n]]
    kept = [b for n, b in enumerate(bins) if n not in gone]
    return best_fit(sizes, kept, sorted(items, key=lambda i: -sizes[i]), capacity)


def _fresh(sizes: list[int], capacity: int, rng: np.random.Generator | None) -> Bins:
    """Best fit decreasing; with `rng` in an order that is only roughly decreasing."""
    noise = np.zeros(len(sizes)) if rng is None else rng.integers(0, capacity // 4, len(sizes))
    return best_fit(sizes, [], np.argsort(-(np.array(sizes) + noise), kind="stable").tolist(), capacity)


def evolve(sizes: list[int], population: list[Bins], generations: int, capacity: int, seed: int) -> list[Bins]:
    """The population after some generations, best first; stops where no packing can be better."""
    rng = np.random.default_rng(seed)
    least = math.ceil(sum(sizes) / capacity)
    if not population:
        population = [_fresh(sizes, capacity, None)]
    rank = lambda bins: _fitness(sizes, bins, capacity)
    if min(len(b) for b in population) > least:
        while len(population) < POPULATION:
            population.append(_fresh(sizes, capacity, rng))
        for _ in range(generations):
            population.sort(key=rank)
            if len(population[0]) <= least:
                break
            children = []
            for _ in range(POPULATION // 2):
                first, second = rng.choice(len(population), 2, replace=False)
                children.append(_crossover(sizes, population[first], population[second], capacity, rng))
            population = sorted([*population, *children], key=rank)[:POPULATION]
    return sorted(population, key=rank)[:POPULATION]


def _genome(bins: Bins, count: int) -> bytes:
    numbers = np.zeros(count, "<i4")
    for number, own in enumerate(bins):
        numbers[own] = number
    return numbers.tobytes()


def _bins(genome: bytes) -> Bins:
    numbers = np.frombuffer(genome, "<i4")
    order = np.argsort(numbers, kind="stable")
    return [part.tolist() for part in np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1) if len(part)]


def _ordered(pieces: pd.DataFrame) -> pd.DataFrame:
    return pieces.sort_values(["length", "ids_crc32", "doc_id", "piece"], kind="stable", ignore_index=True)


def _epoch(epoch: int, capacity: int) -> Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """One epoch of one island: its own population and the elites that arrived evolve."""

    def run(key: tuple, pieces: pd.DataFrame, arrived: pd.DataFrame) -> pd.DataFrame:
        if not len(pieces):
            return pd.DataFrame(columns=["shard", "island", "bins", "fitness", "genome"])
        shard, island = int(key[0]), int(key[1])
        sizes = _ordered(pieces)["length"].tolist()
        seed = (shard * ISLANDS + island) * EPOCHS + epoch
        best = evolve(sizes, [_bins(g) for g in arrived["genome"]], GENERATIONS, capacity, seed)
        ranks = [_fitness(sizes, b, capacity) for b in best]
        return pd.DataFrame(
            {
                "shard": shard,
                "island": island,
                "bins": [r[0] for r in ranks],
                "fitness": [r[1] for r in ranks],
                "genome": [_genome(b, len(sizes)) for b in best],
            }
        )

    return run


def _solve(items: DataFrame, shards: int, capacity: int, scratch: Scratch) -> DataFrame:
    """`items` (pieces with `shard`) with `bin`, `offset` and `fill` of the best packing found."""
    islands = items.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    state = "shard int, island int, bins int, fitness double, genome binary"
    empty = items.sparkSession.createDataFrame([], state)
    elites = empty
    for epoch in range(EPOCHS):
        grown = islands.groupBy("shard", "island").cogroup(elites.groupBy("shard", "island"))
        grown = scratch.keep(grown.applyInPandas(_epoch(epoch, capacity), state), "population")
        best = grown.groupBy("shard", "island").agg(
            F.min("bins").alias("bins"),
            F.min_by("fitness", F.struct("bins", "fitness")).alias("fitness"),
            F.min_by("genome", F.struct("bins", "fitness")).alias("genome"),
        )
        migrants = best.withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int"))
        elites = grown.unionByName(migrants)
    winner = grown.groupBy("shard").agg(F.min_by("genome", F.struct("bins", "fitness", "island")).alias("genome"))

    def laid_out(pieces: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
        if not len(pieces):
            return pieces.assign(bin=0, offset=0, fill=0.0)
        pieces = _ordered(pieces).assign(bin=np.frombuffer(best["genome"].iloc[0], "<i4").astype("int64"))
        sums = pieces.groupby("bin")["length"]
        return pieces.assign(offset=sums.cumsum() - pieces["length"], fill=sums.transform("sum") / capacity)

    kinds = PIECES + ", shard int, bin long, offset long, fill double"
    return items.groupBy("shard").cogroup(winner.groupBy("shard")).applyInPandas(laid_out, kinds)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (as `cut` gives them) with `sequence_id` and `offset`.

    Lengths of a sequence add up to at most `capacity`; offsets are gapless from 0; sequence
    ids are any distinct numbers. Repeated rows are packed once each. No pieces, no sequences.
    """
    spark, scratch = pieces.sparkSession, Scratch(pieces.sparkSession, "packing")
    pieces = scratch.keep(pieces.select("doc_id", "piece", "start", "length", "ids_crc32"), "pieces")
    whole = pieces.filter(F.col("length") >= capacity)
    packed = [whole.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))]
    rest, level, before = pieces.filter(F.col("length") < capacity), 0, None
    while True:
        count = rest.count()
        if not count:
            break
        shards = math.ceil(count / SHARD_PIECES)
        last = shards == 1 or before is not None and count > 0.9 * before
        shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(level)), F.lit(shards)).cast("int")
        solved = scratch.keep(_solve(rest.withColumn("shard", shard), shards, capacity, scratch), "solved")
        done = solved if last else solved.filter(F.col("fill") >= WELL_FILLED)
        number = F.lit(level).cast("long") * F.lit(2**56) + F.col("shard").cast("long") * F.lit(2**24) + F.col("bin")
        packed.append(done.select("doc_id", "piece", "start", "length", "ids_crc32", number.alias("sequence_id"), "offset"))
        if last:
            break
        rest = solved.filter(F.col("fill") < WELL_FILLED).select("doc_id", "piece", "start", "length", "ids_crc32")
        level, before = level + 1, count
    out = packed[0]
    for other in packed[1:]:
        out = out.unionByName(other)
    return out
