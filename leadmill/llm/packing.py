"""Documents packed into sequences of tokens by a grouping genetic algorithm on islands.

A document's ids are those of a word vocabulary and one end id; only documents longer than a sequence
are cut, into pieces as long as a sequence and a last one that may be shorter. A piece that fills a
sequence is one. The others are dealt to shards of about SHARD pieces by a hash of their row, so that
no source, length or group of copies makes a shard large. On each of a shard's ISLANDS lives a
population of whole packings of the shard:

- Crossover injects well-filled bins of one packing into another, removes the bins there that hold the
  same pieces, and puts the displaced pieces back by best fit, longest first.
- Mutation empties some bins, mostly badly filled ones, and puts their pieces back by best fit.
- After each epoch an island sends its best packings to the next island of its shard.

Fitness is the number of bins, then the sum of squares of their fill. The best packing of a shard's
islands settles its well-filled bins; the others are given up, and their pieces from all shards are
dealt to fewer shards and packed again, until one shard is left. So the cut into shards costs
about one sequence a level, not one a shard. An island that needs no more bins than the pieces' total
length asks for stops. Random choices are seeded by shard, island and epoch: a task that is run again
gives the same packings.

A null or empty text is a document of the end id alone. Repeated rows and rows with a null id are
packed like all others, each by itself. Empty tables give empty results; columns other than the two
named do not matter, whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, pre_tokenizers

from leadmill.llm.shared import BATCH_BYTES, pick, pieces, staged, unstage, worker_memory
from leadmill.llm.words import by_row

CAPACITY, END_ID = 2048, 0

# Pieces of a shard, and islands, epochs and generations that pack it.
SHARD, ISLANDS, EPOCHS, GENERATIONS = 4096, 3, 2, 12
# Packings that live on an island, children of a generation, packings that migrate.
POPULATION, CHILDREN, ELITE = 6, 4, 2
# Of the bins of a packing: one in so many is injected, emptied by a mutation, given up by a shard.
INJECTED, MUTATED, GIVEN_UP = 8, 12, 8

# How the vocabulary's pattern cuts words (which have no ASCII white space) of the characters ! to ~ and
# \xa1 to \xff into units: letters, single digits, others, and endings like 's. Bytes are those of Latin-1, made small.
LATIN = bytes(range(256)).decode("latin-1")
SMALL = np.frombuffer(LATIN.lower().encode("latin-1"), np.uint8)
BREAK, LETTER, DIGIT, OTHER = range(4)
KINDS = np.array([BREAK if c == "\n" else LETTER if c.isalpha() else DIGIT if c in "0123456789²³¹¼½¾" else OTHER for c in LATIN], np.uint8)
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
# Bytes of UTF-8 that other characters have; 0xc2 also begins some below \xa1.
FOREIGN = np.array([b < 0x21 or b == 0x7f or b in (0xc0, 0xc1) or b > 0xc3 for b in range(256)])
# A task remembers up to twice so many words of other characters, none of them longer than so many characters,
# and up to twice so many units.
REMEMBERED_WORDS, REMEMBERED_LENGTH = 300_000, 40
# Longest text that is encoded whole to check the words' ids, one in each piece of a batch.
CHECKED_LENGTH = 10_000


class Remembered:
    """Ids of strings met lately, made many at a time."""

    def __init__(self, learn: Callable[[list[str]], Iterable[bytes]]):
        self.learn = learn
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, strings: list[str]) -> list[bytes]:
        """Ids of these strings, which are different from each other."""
        found = list(map(self.young.get, strings))
        missing = [i for i, ids in enumerate(found) if ids is None]
        late = [strings[i] for i in missing]
        older = list(map(self.old.get, late))
        learned = iter(self.learn([s for s, ids in zip(late, older, strict=True) if ids is None]))
        ids_of = [next(learned) if ids is None else ids for ids in older]
        self.young.update(zip(late, ids_of, strict=True))
        for i, ids in zip(missing, ids_of, strict=True):
            found[i] = ids
        if len(self.young) > REMEMBERED_WORDS:
            self.old, self.young = {s: i for s, i in self.young.items() if len(s) <= REMEMBERED_LENGTH}, {}
        return found


class RememberedUnits:
    """The same for many strings of bytes at a time, in Arrow and numpy: no object for each."""

    def __init__(self, learn: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]):
        self.learn = learn
        self.strings = pa.array([], pa.binary())
        self.ids, self.sizes, self.used = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)
        self.turn = 0

    def of(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all strings in turn, and how many each has."""
        known = len(self.strings)
        coded = pa.concat_arrays([self.strings, strings]).dictionary_encode()
        at = coded.indices.to_numpy()[known:]
        self.strings = coded.dictionary  # what is known comes first, in its order
        if len(self.strings) > known:
            ids, sizes = self.learn(self.strings.slice(known))
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        found = gathered(self.ids, self.sizes, at), self.sizes[at]
        self.turn += 1
        self.used = np.append(self.used, np.zeros(len(self.strings) - known, np.int64))
        self.used[at] = self.turn
        self._forget()
        return found

    def _forget(self) -> None:
        """Of too many strings, keep those that were used last."""
        if len(self.strings) <= 2 * REMEMBERED_WORDS:
            return
        short = pa.compute.binary_length(self.strings).to_numpy() <= REMEMBERED_LENGTH
        order = np.argsort(np.where(short, -self.used, 1), kind="stable")
        kept = np.sort(order[:min(REMEMBERED_WORDS, short.sum())])
        self.ids = gathered(self.ids, self.sizes, kept)
        self.strings, self.sizes, self.used = self.strings.take(pa.array(kept)), self.sizes[kept], self.used[kept]


def gathered(values: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The values of the groups ``at``, in this order; ``sizes`` are those of all groups, which lie one after the other."""
    many = sizes[at]
    ends = np.cumsum(many)
    return values[np.repeat((np.cumsum(sizes) - sizes)[at] - ends + many, many) + np.arange(many.sum())]


def unit_bounds(text: np.ndarray) -> np.ndarray:
    """Where the units and line breaks of a text of Latin-1 begin."""
    kinds = KINDS[text]
    first = (kinds == BREAK) | (kinds == DIGIT)
    first[0] = True
    first[1:] |= kinds[1:] != kinds[:-1]
    ticks = np.flatnonzero((text == ord("'")) & first)
    padded = np.concatenate([text, np.zeros(2, np.uint8)])
    for ending in ENDINGS:
        here = ticks[np.all([padded[ticks + 1 + i] == ord(c) for i, c in enumerate(ending)], axis=0)]
        first[here + 1] = False
        after = here + 1 + len(ending)
        first[after[after < len(text)]] = True
    return np.flatnonzero(first)


class WordIds:
    """Ids of texts as the library gives them, from the remembered ids of their words' units.

    The vocabulary's pattern never goes across white space, so words are encoded on their own. Words
    of ordinary characters are cut into units here, and new units are merged by the library without its
    pattern; other words go through all of the library, with a special token between them.
    """

    def __init__(self, path: str):
        self.library, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # One or two characters that the vocabulary has for a character of Latin-1; a blank stays.
        names = [" " if c == " " else byte_level.pre_tokenize_str(c)[0][0] for c in LATIN]
        self.names = np.array([[ord(c) for c in name.ljust(2, "\0")] for name in names], "<u4")
        special = [(i, t.content) for i, t in self.library.get_added_tokens_decoder().items()
                   if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.between, self.mark = special[0]
        self.special = re.compile("|".join(re.escape(t) for _, t in special))
        names = self.library.get_vocab()
        self.ends_unit = np.zeros(max(names.values()) + 1, bool)
        self.ends_unit[[i for name, i in names.items() if name.endswith(self.library.model.end_of_word_suffix)]] = True
        self.units, self.others = RememberedUnits(self._units), Remembered(self._others)

    def _encoded(self, library: Tokenizer, text: str) -> np.ndarray:
        return np.array(library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different units, and how many each has; a line break has none."""
        ids, sizes = [], np.zeros(len(units), np.int64)
        learned = np.flatnonzero(pa.compute.not_equal(units, b"\n").to_numpy(zero_copy_only=False))
        for first in range(0, len(learned), 5_000):
            some = learned[first:first + 5_000]
            named = self.names[np.frombuffer(joined(units.take(pa.array(some)), b" "), np.uint8)]
            ids.append(self._encoded(self.bare, named[named > 0].tobytes().decode("utf-32-le")))
            ends = np.flatnonzero(self.ends_unit[ids[-1]]) + 1
            sizes[some] = np.diff(ends, prepend=0)
        return np.concatenate([np.empty(0, "<u4"), *ids]), sizes

    def _others(self, words: list[str]) -> list[bytes]:
        special = [w for w in words if self.special.search(w)]
        ids_of = {w: self._encoded(self.library, w).tobytes() for w in special}
        rest = [w for w in words if w not in ids_of]
        for first in range(0, len(rest), 5_000):
            some = rest[first:first + 5_000]
            ids = self._encoded(self.library, f" {self.mark} ".join(some))
            cuts = np.flatnonzero(ids == self.between)
            starts, ends = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(ids)]])
            data = ids.tobytes()
            ids_of.update((w, data[a:b]) for w, a, b in zip(some, (4 * starts).tolist(), (4 * ends).tolist(), strict=True))
        return [ids_of[w] for w in words]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, which are different, and how many each has."""
        other = self._is_other(words)
        if not other.any():
            return self._cut(words)
        plain, rest = np.flatnonzero(~other), np.flatnonzero(other)
        ids, sizes = self._cut(words.take(pa.array(plain)))
        found = self.others.of(words.take(pa.array(rest)).to_pylist())
        ids = np.concatenate([ids, np.frombuffer(b"".join(found), "<u4")])
        sizes = np.concatenate([sizes, np.fromiter(map(len, found), np.int64, len(found)) // 4])
        back = np.argsort(np.concatenate([plain, rest]))
        return gathered(ids, sizes, back), sizes[back]

    def _is_other(self, words: pa.Array) -> np.ndarray:
        """Which words have characters that are not ordinary, or a special token."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        foreign = FOREIGN[data]
        begins = np.flatnonzero(data == 0xc2)
        foreign[begins[data[begins + 1] < 0xa1]] = True
        other = np.zeros(len(words), bool)
        other[np.searchsorted(offsets - offsets[0], np.flatnonzero(foreign), "right") - 1] = True
        if self.special.search(data.tobytes().decode()):
            other |= np.array([self.special.search(w) is not None for w in words.to_pylist()])
        return other

    def _cut(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of ordinary characters, and how many each has."""
        if not len(words):
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        text = SMALL[np.frombuffer(f"{joined(words, '\n')}\n".encode("latin-1"), np.uint8)]
        starts = unit_bounds(text)
        ids, sizes = self.units.of(pa.Array.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(text)).astype(np.int32)), pa.py_buffer(text)]))
        ends = np.cumsum(sizes)[text[starts] == ord("\n")]
        return ids, np.diff(ends, prepend=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many there are up to each text's end."""
        cut = pa.compute.ascii_split_whitespace(pa.compute.fill_null(texts.cast(pa.string()), ""))
        coded = cut.flatten().dictionary_encode()
        of_word, sizes = self._words(coded.dictionary)
        at = coded.indices.to_numpy()
        ids, ends = gathered(of_word, sizes, at), np.cumsum(sizes[at])
        bounds = np.concatenate([[0], ends])[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        checked = next((i for i, t in enumerate(texts.slice(0, 20).to_pylist()) if t and len(t) <= CHECKED_LENGTH), None)
        if checked is not None and self._encoded(self.library, texts[checked].as_py()).tobytes() != ids[bounds[checked]:bounds[checked + 1]].tobytes():
            raise ValueError(f"the library encodes {texts[checked].as_py()!r} in another way")
        return ids, bounds[1:]


def joined(strings: pa.Array, between: str | bytes) -> str | bytes:
    whole = pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings)
    return pa.compute.binary_join(whole, between)[0].as_py()


def _vocabulary(path: str) -> WordIds:
    """The vocabulary with the words this worker has met, also in earlier tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    known = worker_memory("word_ids")
    if path not in known:
        known[path] = WordIds(path)
    return known[path]


def _together(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Batches of at least so many bytes, the last one aside: a word is looked up once in each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= least:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def token_pieces(df: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_column: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per piece of a document: the id, ``piece``, ``start``, ``length`` and ``ids_crc32``.

    ``vocabulary`` is the path of a tokenizers file on every executor.
    """
    rows = pick(df, id_column, text)
    names = ["piece", "start", "length", "ids_crc32"]
    schema = T.StructType([rows.schema[id_column], *[
        T.StructField(n, T.IntegerType() if n == "piece" else T.LongType()) for n in names]])
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _vocabulary(vocabulary).encode
        for piece in pieces(_together(batches, 2 * BATCH_BYTES), text, 4 * BATCH_BYTES):
            made = []
            every, upto = ids_of(piece.column(text))
            for row, mine in enumerate(by_row(every, upto)):
                ids = mine.tobytes() + end
                made += [(row, start // (4 * capacity), start // 4, len(part) // 4, zlib.crc32(part))
                         for start in range(0, len(ids), 4 * capacity) for part in [ids[start:start + 4 * capacity]]]
            row, *rest = np.array(made, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [piece.column(id_column).take(pa.array(row)), pa.array(rest[0].astype(np.int32)),
                 *[pa.array(r.copy()) for r in rest[1:]]], names=schema.names)

    return rows.mapInArrow(cut, schema)


class Population:
    """Packings of one shard: arrays that give each piece its bin. Pieces come longest first."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: list[int]):
        self.lengths, self.capacity = lengths, capacity
        self.sizes = lengths.tolist()
        self.random = np.random.default_rng(seed)
        self.least = -(-int(lengths.sum()) // capacity)  # no packing has fewer bins

    def fill(self, packing: np.ndarray) -> np.ndarray:
        return np.bincount(packing, self.lengths).astype(np.int64)

    def cost(self, packing: np.ndarray) -> tuple[int, int]:
        fill = self.fill(packing)
        return len(fill), -int((fill * fill).sum())

    def best_fit(self, packing: np.ndarray, loose: np.ndarray) -> np.ndarray:
        """The packing with the loose pieces, in this order, each put where the least space is left."""
        placed = np.ones(len(packing), bool)
        placed[loose] = False
        used = np.bincount(packing[placed], minlength=1) > 0
        numbers = (np.cumsum(used) - 1)[packing[placed]]
        packing = packing.copy()
        packing[placed] = numbers
        n = int(numbers.max()) + 1 if len(numbers) else 0
        space = self.capacity - np.bincount(numbers, self.lengths[placed], n).astype(np.int64)
        of_space: dict[int, list[int]] = {}
        for b, s in enumerate(space.tolist()):
            of_space.setdefault(s, []).append(b)
        spaces = sum(1 << s for s in of_space)  # bit s: a bin has just this space
        where = []
        for piece in loose.tolist():
            need = self.sizes[piece]
            if fitting := spaces >> need:
                s = need + (fitting & -fitting).bit_length() - 1
                bins = of_space[s]
                b = bins.pop()
                if not bins:
                    spaces ^= 1 << s
            else:
                s, b, n = self.capacity, n, n + 1
            where.append(b)
            s -= need
            of_space.setdefault(s, []).append(b)
            spaces |= 1 << s
        packing[loose] = where
        return packing

    def first(self) -> np.ndarray:
        return self.best_fit(np.zeros(len(self.sizes), np.int64), np.arange(len(self.sizes)))

    def mutate(self, packing: np.ndarray) -> np.ndarray:
        """Some bins emptied, badly filled ones first, and their pieces put back."""
        fill = self.fill(packing)
        n = max(2, len(fill) // MUTATED)
        emptied = np.zeros(len(fill), bool)
        emptied[np.argsort(fill, kind="stable")[:n]] = True
        emptied[self.random.integers(0, len(fill), n)] = True
        loose = np.flatnonzero(emptied[packing])
        # Nearly longest first: neighbours in the order may change places.
        return self.best_fit(packing, loose[np.argsort(np.arange(len(loose)) + self.random.uniform(0, 1 + len(loose) / 8, len(loose)))])

    def cross(self, giver: np.ndarray, taker: np.ndarray) -> np.ndarray:
        """Well-filled bins of one packing put whole into the other, what they displace put back."""
        fill = self.fill(giver)
        best = np.argsort(-fill, kind="stable")[:max(1, len(fill) // 2)]
        chosen = np.zeros(len(fill), bool)
        chosen[self.random.choice(best, max(1, len(fill) // INJECTED), replace=False)] = True
        injected = chosen[giver]
        broken = np.zeros(int(taker.max()) + 1, bool)
        broken[taker[injected]] = True
        child = np.where(injected, giver + len(broken), taker)
        return self.best_fit(child, np.flatnonzero(broken[taker] & ~injected))

    def evolve(self, members: list[np.ndarray], generations: int) -> list[np.ndarray]:
        """The best packings after some generations, best first."""
        if not members:
            members = [self.first()]
            while members[0].max() >= self.least and len(members) < POPULATION:
                members.append(self.mutate(members[0]))
        members = sorted(members, key=self.cost)
        for _ in range(generations):
            if self.cost(members[0])[0] <= self.least:
                break
            children = []
            for _ in range(CHILDREN):
                # The better of two for each parent.
                a, b = np.sort(self.random.integers(0, len(members), (2, 2)).min(1))
                child = self.cross(members[a], members[b]) if a != b else self.mutate(members[a])
                children.append(child)
            members = sorted([*members, *children], key=self.cost)[:POPULATION]
        return members


_ISLAND = "shard int, island int, lengths array<int>, rows array<bigint>, members array<array<int>>, bins int, squares bigint"


def _evolved(islands: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """Every island after an epoch: its best packings, and the number of bins and the fill of the first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                island = batch.slice(i, 1).to_pydict()
                shard, number = island["shard"][0], island["island"][0]
                here = Population(np.array(island["lengths"][0], np.int64), capacity, [shard, number, epoch])
                members = here.evolve([np.array(m, np.int64) for m in island["members"][0]], GENERATIONS)[:ELITE + 1]
                bins, squares = here.cost(members[0])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, 1) for c in ("shard", "island", "lengths", "rows")],
                     pa.array([[m.astype(np.int32) for m in members]], pa.list_(pa.list_(pa.int32()))),
                     pa.array([bins], pa.int32()), pa.array([squares], pa.int64())],
                    names=["shard", "island", "lengths", "rows", "members", "bins", "squares"])

    return islands.mapInArrow(run, _ISLAND)


def _migrated(islands: DataFrame) -> DataFrame:
    """Islands with the best packings of the island before them in the ring of their shard."""
    guests = islands.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"),
                            F.slice("members", 1, ELITE).alias("guests"))
    return islands.join(guests, ["shard", "island"]).withColumn("members", F.concat("members", "guests")).drop("guests")


def _packed(loose: DataFrame, shards: int, capacity: int) -> DataFrame:
    """``shard``, ``lengths``, ``rows`` and ``packing`` (each piece's bin) of the best island of each shard."""
    spark = loose.sparkSession
    shard = F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("int").alias("shard")
    dealt = loose.select(shard, F.struct((-F.col("length")).alias("less"), "_row").alias("p")).groupBy("shard").agg(
        F.sort_array(F.collect_list("p")).alias("p"))  # about SHARD pieces
    islands = dealt.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.transform("p", lambda p: (-p["less"]).cast("int")).alias("lengths"), F.col("p._row").alias("rows"),
        F.array().cast("array<array<int>>").alias("members"))
    tasks = min(shards * ISLANDS, 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    before = None
    for epoch in range(EPOCHS):
        islands = staged(_evolved(islands.repartition(tasks, "shard", "island"), capacity, epoch))
        if before is not None:
            unstage(before)
        before = islands
        if epoch < EPOCHS - 1:
            islands = _migrated(islands)
    best = islands.groupBy("shard").agg(F.min_by("island", F.struct("bins", "squares", "island")).alias("island"))
    found = staged(islands.join(best, ["shard", "island"]).select("shard", "lengths", "rows", F.col("members")[0].alias("packing")))
    unstage(before)
    return found


def _placed(packed: DataFrame, capacity: int, level: int, last: bool) -> DataFrame:
    """``_row``, ``length``, ``sequence_id``, ``offset`` of every piece; the id is null where a bin is given up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.column("shard")[i].as_py()
                lengths, packing = (np.array(batch.column(c)[i].as_py(), np.int64) for c in ("lengths", "packing"))
                order = np.argsort(packing, kind="stable")
                ends = np.cumsum(lengths[order])
                bins, first = np.unique(packing[order], return_index=True)
                starts = ends - lengths[order]
                offsets = np.empty(len(lengths), np.int64)
                offsets[order] = starts - np.repeat(starts[first], np.diff([*first, len(order)]))
                fill = np.bincount(packing, lengths)
                kept = np.ones(len(bins), bool)
                if not last:
                    worst = np.argsort(fill, kind="stable")[:1 + len(bins) // GIVEN_UP]
                    kept[worst[fill[worst] < capacity]] = False
                # A level's shards and a shard's bins have numbers of their own.
                ids = np.int64(level) << 56 | np.int64(shard) << 24 | packing
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batch.column("rows")[i].as_py(), pa.int64()), pa.array(lengths),
                     pa.array(ids, mask=~kept[packing]), pa.array(offsets)],
                    names=["_row", "length", "sequence_id", "offset"])

    return packed.mapInArrow(run, "_row bigint, length bigint, sequence_id bigint, offset bigint")


def pack_pieces(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """All rows and columns of a table of pieces, whose ``length`` is at most ``capacity``, with ``sequence_id`` and ``offset``."""
    rows = staged(cut.withColumn("_row", F.monotonically_increasing_id()))
    whole = rows.filter(F.col("length") >= capacity).select(
        "_row", (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    loose = rows.filter(F.col("length") < capacity).select("_row", "length")
    level = 0
    while n := loose.count():
        level += 1
        shards = -(-n // SHARD)
        packed = _packed(loose, shards, capacity)
        placed = staged(_placed(packed, capacity, level, last=shards == 1))
        unstage(packed)
        whole = whole.unionByName(placed.filter("sequence_id IS NOT NULL").select("_row", "sequence_id", "offset"))
        loose = placed.filter("sequence_id IS NULL").select("_row", "length")
    return rows.join(whole, "_row").drop("_row")


def pack_documents(df: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_column: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Per piece: the id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` in it."""
    return pack_pieces(token_pieces(df, vocabulary, capacity, id_column, text), capacity)
