"""Benchmark passages in documents, by SimHash of item-sized windows.

The 64-bit SimHash of every benchmark item is compared with those of windows of as many words as
the item has. Items lie in a multi-index of BLOCKS blocks of bits: two hashes within RADIUS bits
differ in at most RADIUS // BLOCKS bits of some block, so the items whose block is that near are
all the candidates there can be. Candidates within the radius are then verified by the exact
similarity of their weighted shingles: the weight of a shingle is how often it occurs, and the
similarity is the sum of the smaller weights by the sum of the greater ones.

A window that shares no shingle with any item has similarity 0, so only windows around shared
shingles are hashed. Windows are placed at every word. Words are separated by ASCII white space and
A-Z count as small; texts of fewer than WIDTH words have one shingle, all of their words, and a
text shorter than an item is one window. Of windows that are equally similar to an item the first counts.
Long texts are worked through in slices of windows, so memory grows with a text's words by a few numbers
each, and by a list of candidates.

The benchmark goes to tasks in blocks of bounded size, each against all documents. Items and texts
that are null or without words match nothing. Items of the same text match alike; repeated rows
are all found; empty tables give empty results; other columns do not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.llm.shared import HASHED_BYTES, pick, pieces
from leadmill.llm.words import by_row, shingle_hashes, word_hashes

WIDTH, SIMILARITY = 5, 0.8
# At similarity 0.8 the hashes of two windows differ in about 10 of 64 bits, with a deviation of 3.
RADIUS, BLOCKS = 20, 8
BLOCK_BITS = 64 // BLOCKS
# Text of benchmark items that is sent to tasks at a time.
BENCHMARK_BYTES = 8 << 20
# Windows whose hashes are made, and windows times items that are looked up, at a time.
WINDOWS_TOGETHER, COMPARED_TOGETHER = 2_048, 2_000_000

_BITS = np.arange(64, dtype=np.uint64)
_ONES = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def _votes(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle."""
    return ((shingles[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) * 2 - 1


def _packed(votes: np.ndarray) -> np.ndarray:
    return ((votes > 0).astype(np.uint64) << _BITS).sum(1, dtype=np.uint64)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which 64-bit numbers differ."""
    x = np.ascontiguousarray(a ^ b)
    return _ONES[x.view(np.uint16)].reshape(*x.shape, 4).sum(-1)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller by the sum of the greater numbers of occurrences."""
    keys, back = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.bincount(back[:len(a)], minlength=len(keys)), np.bincount(back[len(a):], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


@dataclass
class Items:
    """Items of one number of shingles: ids, shingles, hashes, and the index of their blocks.

    For block b and value v of it, ``near[b][starts[b][v]:starts[b][v + 1]]`` are the numbers of the items
    whose block is within RADIUS // BLOCKS bits of v.
    """

    ids: list[int]
    shingles: list[np.ndarray]
    hashes: np.ndarray
    starts: list[np.ndarray]
    near: list[np.ndarray]

    def candidates(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of windows and of items within RADIUS of each other, by window and item."""
        found = []
        step = max(1, COMPARED_TOGETHER // len(self.ids))
        for first in range(0, len(windows), step):
            some = windows[first:first + step]
            for b in range(BLOCKS):
                value = _block(some, b)
                start, n = self.starts[b][value], np.diff(self.starts[b])[value]
                w = np.repeat(np.arange(len(some)), n)
                i = self.near[b][np.repeat(start - np.cumsum(n) + n, n) + np.arange(len(w))]
                within = distance(some[w], self.hashes[i]) <= RADIUS
                found.append((w[within] + first) * len(self.ids) + i[within])
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        return pairs // len(self.ids), pairs % len(self.ids)


def _block(hashes: np.ndarray, b: int) -> np.ndarray:
    return ((hashes >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)


class BenchmarkIndex:
    """The items of one block of a benchmark, by number of shingles."""

    def __init__(self, ids: list[int], texts: list[str]):
        shingles, upto = shingle_hashes(*word_hashes(pa.array(texts, pa.string())), WIDTH)
        whole = by_row(shingles, upto)
        self.known = np.unique(shingles)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.known & np.uint64((1 << 20) - 1)] = True
        self.by_size: dict[int, Items] = {}
        values = np.arange(1 << BLOCK_BITS)
        for size in sorted({len(w) for w in whole} - {0}):
            mine = [i for i, w in enumerate(whole) if len(w) == size]
            hashes = np.concatenate([_packed(_votes(whole[i]).sum(0, keepdims=True)) for i in mine])
            near, starts = [], []
            for b in range(BLOCKS):
                block = _block(hashes, b)
                of_value = [np.flatnonzero(_ONES[v ^ block] <= RADIUS // BLOCKS) for v in values]
                near.append(np.concatenate(of_value).astype(np.int32))
                starts.append(np.cumsum([0, *map(len, of_value)]))
            self.by_size[size] = Items([ids[i] for i in mine], [whole[i] for i in mine], hashes, starts, near)
        self.longest = max(self.by_size, default=0)

    def knows(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles some item has; ``known`` is sorted once, not for each text."""
        return self.known[np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)] == shingles

    def matches(self, shingles: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """By item: the similarity of the best window, its first shingle and how many it has."""
        found: dict[int, tuple[float, int, int]] = {}
        maybe = np.flatnonzero(self.sieve[shingles & np.uint64((1 << 20) - 1)]) if self.longest else []
        if len(maybe):
            maybe = maybe[self.knows(shingles[maybe])]
        if not len(maybe):
            return found
        # Stretches of the text that windows with a shared shingle can cover.
        gaps = np.flatnonzero(np.diff(maybe) > 2 * self.longest)
        for first, last in zip(maybe[[0, *(gaps + 1)]], maybe[[*gaps, len(maybe) - 1]], strict=True):
            low, high = max(0, first - self.longest + 1), min(len(shingles), last + self.longest)
            inside = shingles[low:high]
            shared = np.concatenate([[0], np.cumsum(self.knows(inside))])
            for begin in range(0, len(inside), WINDOWS_TOGETHER):
                part = inside[begin:begin + WINDOWS_TOGETHER + self.longest]
                sums = np.zeros((len(part) + 1, 64), np.int32)
                np.cumsum(_votes(part), axis=0, out=sums[1:])
                for size, items in self.by_size.items():
                    length = min(size, len(inside))
                    starts = np.arange(begin, min(begin + WINDOWS_TOGETHER, len(inside) - length + 1))
                    # No window reaches the similarity with fewer shared shingles than this.
                    starts = starts[shared[starts + length] - shared[starts] >= SIMILARITY * max(size, length)]
                    if not len(starts):
                        continue
                    windows = _packed(sums[starts - begin + length] - sums[starts - begin])
                    for w, i in zip(*items.candidates(windows), strict=True):
                        start = int(starts[w])
                        alike = weighted_similarity(inside[start:start + length], items.shingles[i])
                        best = found.get(items.ids[i], (0.0, 0, 0))
                        if alike >= SIMILARITY and alike > best[0]:
                            found[items.ids[i]] = alike, int(low) + start, length
        return found


def _blocks(benchmark: DataFrame) -> Iterator[Broadcast]:
    """The benchmark as indexes of bounded size."""
    items = pick(benchmark, "item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + size // BENCHMARK_BYTES
    for b in range(n):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else items
        rows = sorted((r.item_id, r.text) for r in mine.collect())  # about BENCHMARK_BYTES of text
        yield benchmark.sparkSession.sparkContext.broadcast(
            BenchmarkIndex([i for i, _ in rows], [t for _, t in rows]))


def _found(index: BenchmarkIndex, text: pa.Array) -> list[dict[int, tuple[float, int, int]]]:
    return [index.matches(s) for s in by_row(*shingle_hashes(*word_hashes(text), WIDTH))]


def find_passages(df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and benchmark item in it: ``item_id``, ``similarity`` of the best window,
    ``first_word`` and ``n_words`` of that window (words count from 0)."""
    rows = pick(df, id_column, text)
    schema = T.StructType([
        rows.schema[id_column], T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()),
        T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType())])

    def search(index: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, text, HASHED_BYTES):
                hits = [(row, item, *m) for row, found in enumerate(_found(index.value, piece.column(text)))
                        for item, m in sorted(found.items())]
                if hits:
                    at, item, alike, start, size = (list(c) for c in zip(*hits, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(id_column).take(pa.array(at)), pa.array(item, pa.int64()),
                         pa.array(alike, pa.float64()), pa.array(start, pa.int64()),
                         pa.array([s + WIDTH - 1 for s in size], pa.int64())], names=schema.names)
        return run

    whole = None
    for index in _blocks(benchmark):
        found = rows.mapInArrow(search(index), schema)
        whole = found if whole is None else whole.unionByName(found)
    return whole


def without_passages(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text holds no benchmark passage, with all their columns."""
    place = df.columns.index(text)

    def keep(index: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, place, HASHED_BYTES):
                yield piece.filter(pa.array([not found for found in _found(index.value, piece.column(place))], pa.bool_()))
        return run

    # Columns go by their places meanwhile, so that their names need not differ.
    names = df.columns
    kept = df.toDF(*[f"_{i}" for i in range(len(names))])
    for index in _blocks(benchmark):
        kept = kept.mapInArrow(keep(index), kept.schema)
    return kept.toDF(*names)
