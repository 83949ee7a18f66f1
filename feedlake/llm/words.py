"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of letters and digits: ASCII letters and digits, and all bytes beyond ASCII;
A to Z count as a to z. Texts come as the buffers of an Arrow string column, so nothing is
done for each word in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed together; a longer run of text is cut between words.
CHUNK = 1 << 20
#: Bytes of text handed out together.
SLICE = 1 << 22

_BASE = 0x9E3779B97F4A7C15 | 1
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint64) + 1
_FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes of words that only white space parts.
VISIBLE = np.ones(256, bool)
VISIBLE[[32, *range(9, 14)]] = False


def _powers(base: int, count: int) -> np.ndarray:
    """At least so many powers of `base`, from 1 on; products of two short runs of them."""
    step = 1 << (count.bit_length() + 1) // 2
    short = np.cumprod(np.array([1] + [base] * (step - 1), np.uint64))
    long = np.cumprod(np.array([1] + [pow(base, step, 1 << 64)] * (-(-count // step) - 1), np.uint64))
    return np.multiply.outer(long, short).ravel()


class Hasher:
    """Hashes words of the given bytes; keeps the powers of the base it has needed."""

    def __init__(self, letters: np.ndarray = _LETTER) -> None:
        self._letters = letters
        self._powers = self._inverse = np.ones(1, np.uint64)

    def _grow(self, count: int) -> None:
        if len(self._powers) < count:
            # a little more, as the next run of text may be longer by a word
            count += count >> 6
            self._powers, self._inverse = _powers(_BASE, count), _powers(pow(_BASE, -1, 1 << 64), count)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word of texts that lie in `data` at `offsets`, and the number of words
        before each text (one entry more than texts)."""
        hashes, _, _, bounds = self.spans(data, offsets)
        return hashes, bounds

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As `words`, with the start and end of every word in `data` in between."""
        parts = []
        letter = self._letters[data]
        at, end = int(offsets[0]), int(offsets[-1])
        while at < end:
            stop = min(end, at + CHUNK)
            if stop < end:
                between = np.flatnonzero(~letter[at:stop])
                # a word longer than a chunk is taken whole
                if len(between):
                    stop = at + int(between[-1]) + 1
                else:
                    later = np.flatnonzero(~letter[stop:end])
                    stop = stop + int(later[0]) if len(later) else end
            cuts = offsets[(offsets > at) & (offsets < stop)] - at
            begin, finish, hashed = self._chunk(data[at:stop], letter[at:stop], cuts)
            parts.append((hashed, begin + at, finish + at))
            at = stop
        if not parts:
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
        hashes, starts, stops = (np.concatenate(column) for column in zip(*parts, strict=True))
        return hashes, starts, stops, np.searchsorted(starts, offsets)

    def _chunk(self, data: np.ndarray, letter: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(np.where(letter, _FOLD[data], np.uint64(0)) * self._powers[: len(data)], out=sums[1:])
        begins, ends = letter.copy(), letter.copy()
        begins[1:] &= ~letter[:-1]
        ends[:-1] &= ~letter[1:]
        if len(cuts):
            begins[cuts] = letter[cuts]
            ends[cuts - 1] = letter[cuts - 1]
        begin, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        return begin, stop, mix((sums[stop] - sums[begin]) * self._inverse[begin] + (stop - begin).astype(np.uint64))


def shingles(words: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of `size` words within a text, and the bounds of the texts in them.

    A text of fewer words, one at least, has one shingle of all its words.
    """
    counts = np.diff(bounds)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out = np.concatenate([np.zeros(1, np.int64), np.cumsum(made)])
    text = np.repeat(np.arange(len(counts)), made)
    place = np.arange(out[-1]) - out[text] + bounds[text]
    length = np.minimum(counts[text], size)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    total = np.zeros(len(place), np.uint64)
    for i in range(size):
        factor = np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64))
        total += np.where(i < length, padded[place + i], np.uint64(0)) * factor
    return mix(total + length.astype(np.uint64)), out


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of parts of an Arrow string column; NULL is empty.

    A part has about SLICE bytes, one row at least.
    """
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    texts = texts.fill_null("")
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, kind, count=len(texts) + 1 + texts.offset)[texts.offset :].astype(np.int64) if places else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        end = min(end, len(texts))
        yield at, whole[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end
