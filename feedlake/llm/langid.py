"""Language identification with a linear-chain conditional random field over words.

Every word of a text gets a label; neighbours are tied by learned transitions, so a text may
switch languages. What speaks for a label at a word are its affixes (1 to 3 bytes at either end),
its byte n-grams (2 to 4, with the word's edges) and its own entry in a lexicon. Words are
labelled by forward-backward over chains of CHAIN words with CONTEXT words on both sides, all
chains of many texts at once. A text's language is that of most of its words' probability.

The field is fitted on at most `max_docs` documents, shared evenly among the languages, and on
at most DRAWN runs of RUN words of each, spread over the whole text. Runs of different languages
are joined into chains, by which the transitions see switches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm.common import add_columns
from feedlake.llm.words import Hasher, mix, slices

UNKNOWN = "und"
MAX_DOCS, DRAWN, RUN = 2400, 6, 16
CHAIN, CONTEXT = 64, 12
#: Cells of hashed features; entries of the lexicon have cells of their own kind there.
CELLS = 1 << 17
ROUNDS, RATE, DECAY, SEEN = 40, 0.3, 1e-3, 2
#: Distinct words a task remembers.
REMEMBERED = 1 << 19

# bytes of words: ASCII letters and whatever is not ASCII
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def features(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the features of words (spans of bytes), and the word each is of, ascending."""
    length = stops - starts
    size = length + 2
    at = np.cumsum(size) - size
    total = int(size.sum())
    # the words one behind another, each between two edges
    flat = np.zeros(total, np.uint64)
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    flat[np.repeat(at + 1, length) + inside] = _FOLD[data[np.repeat(starts, length) + inside]]
    flat[at], flat[at + size - 1] = 1, 2
    word = np.repeat(np.arange(len(length)), size)
    place = np.arange(total) - at[word]
    cells, owners = [], []
    code = np.zeros(total, np.uint64)
    for n in range(1, 5):
        code = (code[: total - n + 1] << np.uint64(8)) | flat[n - 1 :] if n > 1 else flat.copy()
        if len(code) == 0:
            break
        fits = place[: len(code)] + n <= size[word[: len(code)]]
        kinds = [(n, fits)] if n > 1 else []
        if n < 4:
            # affixes of n bytes: behind the first edge, before the last one
            begin, end = place[: len(code)] == 1, place[: len(code)] + n + 1 == size[word[: len(code)]]
            inner = fits & (place[: len(code)] >= 1) & (place[: len(code)] + n + 1 <= size[word[: len(code)]])
            kinds += [(10 + n, begin & inner), (20 + n, end & inner)]
        for kind, chosen in kinds:
            own = np.flatnonzero(chosen)
            cells.append((mix(code[own] * np.uint64(64) + np.uint64(kind)) % np.uint64(CELLS)).astype(np.int64))
            owners.append(word[own])
    cells, owners = np.concatenate(cells), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return cells[order], owners[order]


class Field:
    """Weights of features, lexicon, transitions and ends for the labels `labels`."""

    def __init__(self, labels: list[str]):
        self.labels, count = labels, len(labels)
        self.weights = np.zeros((CELLS, count), np.float32)
        self.lexicon = np.zeros(0, np.uint64)
        self.entries = np.zeros((0, count), np.float32)
        self.moves = (np.eye(count) * 2).astype(np.float32)
        self.start = np.zeros(count, np.float32)

    def speaks(self, hashes: np.ndarray, cells: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """What speaks for each label at distinct words, by their hashes and features."""
        out = np.zeros((len(hashes), len(self.labels)), np.float32)
        if len(owners):
            first = np.flatnonzero(np.diff(owners, prepend=-1))
            out[owners[first]] = np.add.reduceat(self.weights[cells], first, axis=0)
        if len(self.lexicon):
            at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
            known = self.lexicon[at] == hashes
            out[known] += self.entries[at[known]]
        return out

    def marginals(self, scores: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward-backward over chains (chains x places x labels), where `real` is a place.

        Gives each place's label probabilities, the expected number of moves between labels, and
        the log of each chain's total. Missing places lie at the ends and are passed through.
        """
        chains, places, count = scores.shape
        peak = scores.max(axis=2)
        here = np.exp(scores - peak[..., None])
        move = np.exp(self.moves)
        forward = np.zeros((chains, places, count), np.float32)
        log = np.zeros(chains)
        before, begun = np.zeros((chains, count), np.float32), np.zeros(chains, bool)
        for t in range(places):
            own = np.where(begun[:, None], before @ move, np.exp(self.start)[None]) * here[:, t]
            total = own.sum(axis=1)
            own /= total[:, None]
            use = real[:, t]
            log[use] += np.log(total[use]) + peak[use, t]
            before = np.where(use[:, None], own, before)
            begun |= use
            forward[:, t] = before
        backward = np.ones((chains, count), np.float32)
        out = np.zeros((chains, places, count), np.float32)
        moved = np.zeros((count, count))
        for t in range(places - 1, -1, -1):
            use = real[:, t]
            both = forward[:, t] * backward
            out[use, t] = both[use] / both[use].sum(axis=1, keepdims=True)
            later = here[:, t] * backward
            if t:
                pair = use & real[:, t - 1]
                left, right = forward[pair, t - 1], later[pair]
                norm = ((left @ move) * right).sum(axis=1)
                moved += move * (left.T @ (right / norm[:, None]))
            earlier = later @ move.T
            earlier /= earlier.sum(axis=1, keepdims=True)
            backward = np.where(use[:, None], earlier, backward)
        return out, moved, log


class Labeller:
    """Language probabilities of texts; scores each distinct word of a task once."""

    def __init__(self, field: Field):
        self.field, self.hasher = field, Hasher(_LETTERS)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.scores = np.zeros((0, len(self.field.labels)), np.float32)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What speaks for each label at every word, and the bounds of the texts in the words."""
        hashes, starts, stops, bounds = self.hasher.spans(data, offsets)
        distinct, first, index = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self._forget()
        new = np.flatnonzero(~np.isin(distinct, self.known, assume_unique=True))
        if len(new):
            cells, owners = features(data, starts[first[new]], stops[first[new]])
            own = self.field.speaks(distinct[new], cells, owners)
            known = np.concatenate([self.known, distinct[new]])
            order = np.argsort(known)
            self.known, self.scores = known[order], np.concatenate([self.scores, own])[order]
        return self.scores[np.searchsorted(self.known, distinct)][index], bounds

    def chains(self, scores: np.ndarray, bounds: np.ndarray, together: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of many chains at once: their texts, the words they label (-1: none), and the words'
        label probabilities."""
        counts = np.diff(bounds)
        made = -(-counts // CHAIN)
        text = np.repeat(np.arange(len(counts)), made)
        first = (np.arange(len(text)) - np.repeat(np.cumsum(made) - made, made)) * CHAIN
        for at in range(0, len(text), together):
            own = text[at : at + together]
            place = first[at : at + together, None] - CONTEXT + np.arange(CHAIN + 2 * CONTEXT)
            real = (place >= 0) & (place < counts[own][:, None])
            word = np.where(real, bounds[own][:, None] + place, -1)
            probability, _, _ = self.field.marginals(scores[word], real)
            yield own, word[:, CONTEXT : CONTEXT + CHAIN], probability[:, CONTEXT : CONTEXT + CHAIN]

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean label probabilities of the words of each text (0 everywhere without words)."""
        scores, bounds = self.words(data, offsets)
        sums = np.zeros((len(bounds) - 1, len(self.field.labels)))
        for text, _, probability in self.chains(scores, bounds):
            np.add.at(sums, text, probability.sum(axis=1))
        return sums / np.maximum(np.diff(bounds), 1)[:, None]

    def runs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Maximal runs of words of one label: text, label, start and end in code points, words,
        mean probability."""
        scores, bounds = self.words(data, offsets)
        _, starts, stops, _ = self.hasher.spans(data, offsets)
        label, sure = np.zeros(len(scores), np.int64), np.zeros(len(scores))
        for _, word, probability in self.chains(scores, bounds):
            own = word >= 0
            label[word[own]], sure[word[own]] = probability.argmax(axis=2)[own], probability.max(axis=2)[own]
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        first = np.flatnonzero((np.diff(label, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
        size = np.diff(first, append=len(label))
        points = np.concatenate([np.zeros(1, np.int64), np.cumsum((data & 0xC0) != 0x80)])
        of = text[first]
        begin, end = points[starts[first]] - points[offsets[of]], points[stops[first + size - 1]] - points[offsets[of]]
        mean = np.add.reduceat(sure, first) / size if len(first) else np.zeros(0)
        return of, label[first], begin, end, size, mean


def _runs(words: list[bytes], identity: int) -> list[list[bytes]]:
    """At most DRAWN runs of RUN words, spread evenly over all of them."""
    pieces = max(1, len(words) // RUN)
    step = max(1, -(-pieces // DRAWN))
    chosen = range(identity % step, pieces, step)
    return [words[i * RUN : (i + 1) * RUN] for i in chosen]


def fit(docs: DataFrame, use: Column | None = None, max_docs: int = MAX_DOCS) -> Field:
    """A field learned from `text` and `lang` of documents with both, where `use` holds.

    `use` is a condition on `doc_id`; rows where it is NULL do not teach. At most about
    `max_docs` documents teach, those of smallest id hash in each language. Without any the
    field has no labels.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    if use is not None:
        known = known.filter(use)
    known = known.select(F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id").alias("draw"), "text")
    # one row for each language
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return Field([])
    quota = max(1, max_docs // len(counts))
    # a share of each language by hash, half as much again as needed; trimmed below
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 1.5 * (quota + 20) / n))))
    place = (F.pmod("draw", F.lit(1 << 40)) / float(1 << 40)).alias("place")
    chosen = known.withColumn("place", place).filter(F.col("place") < F.element_at(share, F.col("lang")))

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(_LETTERS)
        for batch in batches:
            own, ids = [], batch.column("draw").to_pylist()
            for at, data, offsets in slices(batch.column("text")):
                _, starts, stops, bounds = hasher.spans(data, offsets)
                raw = _FOLD[data].tobytes()
                for i in range(len(offsets) - 1):
                    words = [raw[a:b] for a, b in zip(starts[bounds[i] : bounds[i + 1]].tolist(), stops[bounds[i] : bounds[i + 1]].tolist(), strict=True)]
                    own.append(b"\n".join(b" ".join(r) for r in _runs(words, ids[at + i])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("place"), pa.array(own, pa.binary())], names=["lang", "place", "runs"]
            )

    # at most 1.5 * max_docs rows or so, each of DRAWN * RUN words
    rows = chosen.select("lang", "draw", "place", "text").mapInArrow(drawn, "lang string, place double, runs binary").collect()
    rows = sorted((r.lang, r.place, bytes(r.runs)) for r in rows)
    labels = sorted(counts)
    runs = []
    for label, lang in enumerate(labels):
        own = [r[2] for r in rows if r[0] == lang][:quota]
        runs += [(label, run.split(b" ")) for text in own for run in text.split(b"\n") if run]
    return train(labels, runs)


def train(labels: list[str], runs: list[tuple[int, list[bytes]]], rounds: int = ROUNDS) -> Field:
    """A field fitted on labelled runs of words by steps of Adagrad on the likelihood of chains."""
    field = Field(labels)
    if not runs or len(labels) < 2:
        return field
    rng = np.random.default_rng(3)
    order = rng.permutation(len(runs))
    whole = [runs[i] for i in order]
    # chains of up to four runs: half of them of one language, half of whatever comes
    alike = sorted(range(len(whole) // 2), key=lambda i: whole[i][0])
    line = [whole[i] for i in alike] + whole[len(whole) // 2 :]
    joined = b"".join(w for _, run in line for w in run)
    data = np.frombuffer(joined, np.uint8)
    length = np.array([len(w) for _, run in line for w in run], np.int64)
    label = np.array([y for y, run in line for _ in run], np.int64)
    ends = np.cumsum(length)
    # the hashes that labelling gives these words: the hasher sees one text for each
    hashes = _hashes(data, ends - length, ends)
    distinct, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    cells, owners = features(data, (ends - length)[first], ends[first])
    counts = np.bincount(index)
    entered = np.flatnonzero(counts >= SEEN)
    field.lexicon, field.entries = distinct[entered], np.zeros((len(entered), len(labels)), np.float32)

    places = 4 * RUN
    chains = -(-len(label) // places)
    at = np.arange(chains * places).reshape(chains, places)
    real = at < len(label)
    at = np.minimum(at, len(label) - 1)
    target = np.eye(len(labels), dtype=np.float32)[label[at]] * real[..., None]
    both = real[:, 1:] & real[:, :-1]
    moves = np.zeros((len(labels), len(labels)))
    np.add.at(moves, (label[at[:, :-1]][both], label[at[:, 1:]][both]), 1)
    squares = {k: np.full_like(getattr(field, k), 1e-6) for k in ("weights", "entries", "moves", "start")}
    for _ in range(rounds):
        scores = field.speaks(distinct, cells, owners)
        probability, moved, _ = field.marginals(scores[index[at]], real)
        gap = target - probability
        by_word = np.zeros((len(distinct), len(labels)), np.float32)
        np.add.at(by_word, index[at[real]], gap[real])
        by_cell = np.zeros_like(field.weights)
        for y in range(len(labels)):
            by_cell[:, y] = np.bincount(cells, by_word[owners, y], CELLS)
        steps = {"weights": by_cell, "entries": by_word[entered], "moves": moves - moved, "start": gap[:, 0].sum(axis=0)}
        for k, gradient in steps.items():
            value = getattr(field, k)
            gradient = (gradient / len(label) - DECAY / len(label) * value).astype(np.float32)
            squares[k] += (gradient * len(label)) ** 2
            value += np.float32(RATE) * gradient * len(label) / np.sqrt(squares[k])
    return field


def _hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of spans as the hasher gives them to words: a blank is put behind each."""
    length = stops - starts
    spaced = np.full(int((length + 1).sum()), 32, np.uint8)
    at = np.cumsum(length + 1) - length - 1
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    spaced[np.repeat(at, length) + inside] = data[np.repeat(starts, length) + inside]
    hashes, _ = Hasher(_LETTERS).words(spaced, np.array([0, len(spaced)]))
    return hashes


def identify(docs: DataFrame, field: Field) -> DataFrame:
    """`docs` with `lang_pred` and `score` (0 to 1: mean probability of that language).

    Whole texts are read. A text that is NULL or holds no letter is `und` with score 0, and so is
    every text if the field has no labels. Equal texts have equal results, whatever their ids,
    sources and languages. Input columns of the two names are replaced, all others stay.
    """
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if not field.labels:
        return add_columns(docs, lang_pred=F.lit(UNKNOWN), score=F.lit(0.0))
    labels = np.array(field.labels, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(field)
        for batch in batches:
            found = [labeller.texts(data, offsets) for _, data, offsets in slices(batch.column("text"))]
            found = np.concatenate([np.zeros((0, len(labels))), *found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(labels[found.argmax(axis=1)], pa.string()), pa.array(np.clip(found.max(axis=1), 0, 1))],
                names=["row", "lang_pred", "score"],
            )

    packed = docs.select(F.struct("*", letter.alias("__letter")).alias("row"), F.col("text"))
    schema = packed.select("row").schema.add("lang_pred", "string").add("score", "double")
    rows = packed.mapInArrow(run, schema).select("row.*", F.col("lang_pred").alias("__lang"), F.col("score").alias("__score"))
    known = F.col("__letter")
    out = add_columns(
        rows, lang_pred=F.when(known, F.col("__lang")).otherwise(UNKNOWN), score=F.when(known, F.col("__score")).otherwise(0.0)
    )
    return out.drop("__letter", "__lang", "__score")


SEGMENTS = T.ArrayType(
    T.StructType()
    .add("lang", "string").add("start", "long").add("end", "long").add("words", "long").add("probability", "double")
)


def segments(docs: DataFrame, field: Field) -> DataFrame:
    """`docs` with `segments`: where each text is in which language.

    Maximal runs of words with one likeliest language, in order, from `start` to `end` (code
    points, end exclusive); words are runs of ASCII letters and other characters beyond ASCII. A
    text without words, NULL included, has none. An input column of that name is replaced.
    """
    labels = field.labels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(field)
        kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64()), ("probability", pa.float64())]))
        for batch in batches:
            out = []
            for _, data, offsets in slices(batch.column("text")):
                own: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
                if labels:
                    for of, label, *rest in zip(*(c.tolist() for c in labeller.runs(data, offsets)), strict=True):
                        own[of].append(dict(zip(("lang", "start", "end", "words", "probability"), (labels[label], *rest), strict=True)))
                out += own
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, kind)], names=["row", "segments"])

    packed = docs.select(F.struct("*").alias("row"), F.col("text"))
    schema = packed.select("row").schema.add("segments", SEGMENTS)
    rows = packed.mapInArrow(run, schema).select("row.*", F.col("segments").alias("__segments"))
    return add_columns(rows, segments=F.col("__segments")).drop("__segments")
