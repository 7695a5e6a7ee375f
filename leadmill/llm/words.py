"""64-bit hashes of the words and word shingles of Arrow text, computed for a whole column at once.

Words are what ASCII white space (space, tab to carriage return) separates. A shingle is a run of
``width`` words; a shorter text with a word has one shingle, all of its words. Two different
words or shingles of a table have the same hash with a chance of about one in 2**64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_PLAIN = np.arange(256, dtype=np.uint8)
_LOWER = _PLAIN.copy()
_LOWER[ord("A"):ord("Z") + 1] += 32

_RANDOM = np.random.default_rng(20240501)
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_SHINGLE_FACTORS = _RANDOM.integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SortedHashes:
    """Places of hashes in a sorted list of different ones, by a table of where the hashes with the same first bits begin.
    As such hashes lie evenly, that is a step or two; a binary search of a long list goes to memory at every step."""

    def __init__(self, hashes: np.ndarray):
        bits = max(1, len(hashes).bit_length())
        self.shift, self.n = np.uint64(64 - bits), len(hashes)
        self.starts = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.hashes = np.append(hashes, np.uint64(2**64 - 1))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are in the list, and the places of these."""
        at = self.starts[hashes >> self.shift].astype(np.intp)
        behind = np.flatnonzero(self.hashes[at] < hashes)
        while len(behind):
            at[behind] += 1
            behind = behind[self.hashes[at[behind]] < hashes[behind]]
        known = (self.hashes[at] == hashes) & (at < self.n)
        return known, at[known]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def word_hashes(text: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each row the number of words in it and those before.

    ``lower`` makes A-Z small first. Null rows have no words.
    """
    text = pa.compute.fill_null(text.cast(pa.string()), "")
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1]
    if not len(text) or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint64), np.zeros(len(text), np.int64)
    raw = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    bounds = (offsets - offsets[0]).astype(np.int64)
    white = _WHITE[raw]
    n = len(raw)
    first = np.ones(n, bool)  # no word goes across rows
    first[1:] = white[:-1]
    first[bounds[:-1][bounds[:-1] < n]] = True
    last = np.ones(n, bool)
    last[:-1] = white[1:]
    inner = bounds[1:-1]
    last[inner[inner > 0] - 1] = True
    starts = np.flatnonzero(first & ~white)
    ends = np.flatnonzero(last & ~white) + 1
    values = _BYTE_VALUES[(_LOWER if lower else _PLAIN)[raw]] * _powers(_BASE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    # The sum of a word's bytes, as if the word began the text, whatever comes before it.
    hashes = (sums[ends] - sums[starts]) * _powers(_INVERSE, n)[starts]
    before = np.searchsorted(starts, bounds)
    return mix(hashes + (ends - starts).astype(np.uint64)), before[1:]


def shingle_hashes(words: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, repeats included, and the number of them up to each row's end."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    sizes = ends - starts
    counts = np.where(sizes == 0, 0, np.maximum(sizes - width + 1, 1))
    upto = np.cumsum(counts)
    rows = np.repeat(np.arange(len(ends)), counts)
    at = starts[rows] + np.arange(len(rows)) - (upto - counts)[rows]
    made = np.zeros(len(rows), np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    short = sizes[rows] < width
    for k in range(width):
        word = padded[at + k]
        if short.any():
            word = np.where(short & (k >= sizes[rows]), np.uint64(k + 1), word)
        made += word * _SHINGLE_FACTORS[k]
    return mix(made), upto


def by_row(values: np.ndarray, upto: np.ndarray) -> list[np.ndarray]:
    """The values of each row, given the numbers of values up to each row's end."""
    bounds = [0, *upto.tolist()]
    return [values[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def shingle_sets(text: pa.Array, width: int) -> list[np.ndarray]:
    """For each row its different shingles' hashes, ascending."""
    shingles, upto = shingle_hashes(*word_hashes(text), width)
    return [np.unique(s) for s in by_row(shingles, upto)]
