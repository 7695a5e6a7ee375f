"""Spelling variants of a corpus' words, by composing finite-state machines.

Two words are near if one inserted, deleted or replaced code point makes one of the other. The pairs
are what the composition A o T o A accepts, with A the minimal acyclic acceptor of the vocabulary and
T a transducer that copies, makes one edit, and copies again. Before the edit both copies of A are
in the same state, so the pairs fall apart by the initial state they start from, and every initial
state is composed alone:

- Of two near words the shorter of which has m code points, the first m // 2 code points are equal or
  the last m // 2 are. So a word belongs to the states that A, or the acceptor of the words read
  backwards, is in after so many code points, for m its own length and one less.
- A state with more than GROUP words is cut in the same way by what lies between the code points that
  its words share, until it is small; a rest of one or two code points always is.
- A pair that several states accept counts in one of them, the one that shares beginnings first.

T deletes the last of equal code points only, so it accepts each pair in one way.

The words themselves are counted in tasks before the shuffle. A word's ``form`` is its near word of
largest count, the smallest in code-point order of equals, if that is at least FACTOR times as
frequent; ``root`` is the end of the chain of forms. Counts grow along a chain by FACTOR, so its length
is bounded by their logarithm.

Null and empty texts have no words. Repeated rows count each. A null id counts as an empty one where
``change`` asks for it. Empty tables give empty results; columns other than the two named do not matter,
whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.llm.shared import pick, pieces, staged, unstage

# Code points and occurrences that a word has at least, and how much more frequent its form is.
LEAST_LENGTH, LEAST_COUNT, FACTOR = 7, 2, 10
# Words that are composed at a time; more than two code points of the alphabet can be.
GROUP = 20_000
# Different words that a task counts before it sends them on.
COUNTED_WORDS = 200_000
# Hot states that may be broadcast; there are at most four words' worth of states in GROUP words.
BROADCAST_STATES = 100_000

_SMALL = bytes(c + 32 if ord("A") <= c <= ord("Z") else c for c in range(256))

Change = Callable[[str, str], str]


def drop_some(doc_id: str, run: str) -> str:
    """One run in 31 of a document, by a checksum, without one of its code points."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(df: DataFrame, change: Change | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` of the words with at least LEAST_LENGTH code points and LEAST_COUNT occurrences.

    A word is a longest run of letters A-Z, of any case, and of the code points from U+00C0 to U+00FF,
    with A-Z made small. ``change`` may make another word of one, by the text of the document's id;
    it must not make words longer.
    """
    runs = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")  # what is shorter cannot become a word
    rows = pick(df, id_column, text).withColumn(id_column, F.coalesce(F.col(id_column).cast("string"), F.lit("")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for piece in pieces(batches, text):
            ids = piece.column(id_column).to_pylist()
            for doc_id, whole in zip(ids, piece.column(text).to_pylist(), strict=True):
                found = runs.findall(whole.encode().translate(_SMALL).decode()) if whole else []
                if change is None:
                    counts.update(found)
                else:
                    for run, n in Counter(found).items():
                        counts[change(doc_id, run)] += n
                if len(counts) >= COUNTED_WORDS:
                    yield batch()
                    counts.clear()
        yield batch()

    counted = rows.mapInArrow(count, "word string, n bigint").filter(F.length("word") >= LEAST_LENGTH)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


class Acceptor:
    """The minimal acyclic automaton of some strings, which must be ascending. State 0 is the initial one."""

    def __init__(self, strings: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        self._known: dict[tuple, int] = {}
        open_: list[tuple[int, str, int]] = []  # the path of the last string, not minimised yet
        last = ""
        for string in strings:
            shared = 0
            while shared < min(len(last), len(string)) and last[shared] == string[shared]:
                shared += 1
            self._close(open_, shared)
            state = open_[-1][2] if open_ else 0
            for c in string[shared:]:
                self.arcs.append({})
                self.final.append(False)
                new = len(self.arcs) - 1
                self.arcs[state][c] = new
                open_.append((state, c, new))
                state = new
            self.final[state] = True
            last = string
        self._close(open_, 0)

    def _close(self, open_: list[tuple[int, str, int]], depth: int) -> None:
        """Replace states that are done by an equal one, if there is one."""
        while len(open_) > depth:
            before, c, state = open_.pop()
            key = self.final[state], *self.arcs[state].items()
            self.arcs[before][c] = self._known.setdefault(key, state)


class NearPairs:
    """What the composition of an acceptor, one edit and the acceptor accepts, each pair once."""

    def __init__(self, strings: list[str]):
        self.acceptor = Acceptor(strings)
        # Pairs of states: whether both are final, and the arcs that lead on to a pair of final ones.
        self._copying: dict[tuple[int, int], tuple[bool, list[tuple[str, tuple[int, int]]]]] = {}
        self._edits: dict[int, list[tuple[str, str]]] = {}

    def _copied(self, p: int, q: int) -> tuple[int, int]:
        """The pair of states, with all that can be copied from there; words may be too long to recur on."""
        known, arcs, final = self._copying, self.acceptor.arcs, self.acceptor.final
        start = (p, q) if p <= q else (q, p)
        agenda = [start]
        while agenda:
            pair = agenda[-1]
            if pair in known:
                agenda.pop()
                continue
            one, two = arcs[pair[0]], arcs[pair[1]]
            following = [(c, (one[c], two[c]) if one[c] <= two[c] else (two[c], one[c])) for c in one if c in two]
            missing = [n for _, n in following if n not in known]
            if missing:
                agenda += missing
            else:
                known[pair] = final[pair[0]] and final[pair[1]], [(c, n) for c, n in following if any(known[n])]
                agenda.pop()
        return start

    def tails(self, p: int, q: int, but: str = "") -> list[str]:
        """Strings that lead from both states to final ones and do not begin with ``but``."""
        found, agenda = [], [("", self._copied(p, q))]
        while agenda:
            copied, pair = agenda.pop()
            accepted, following = self._copying[pair]
            if accepted:
                found.append(copied)
            agenda += [(copied + c, n) for c, n in following if copied or c != but]
        return found

    def edits(self, state: int) -> list[tuple[str, str]]:
        """Pairs of rests whose first code points are the edit."""
        found = self._edits.get(state)
        if found is None:
            arcs = list(self.acceptor.arcs[state].items())
            found = []
            for i, (c, p) in enumerate(arcs):
                found += [(c + t, t) for t in self.tails(p, state, but=c)]
                for d, q in arcs[i + 1:]:
                    found += [(c + t, d + t) for t in self.tails(p, q)]
            self._edits[state] = found
        return found

    def __iter__(self) -> Iterator[tuple[str, str]]:
        """Pairs of strings, the longer one first."""
        agenda = [("", 0)]
        while agenda:
            copied, state = agenda.pop()
            for a, b in self.edits(state):
                yield copied + a, copied + b
            agenda += [(copied + c, q) for c, q in self.acceptor.arcs[state].items()]


def _counts_here(path: str, m: int, a: str, b: str) -> bool:
    """Whether a pair counts in this state: it has the length, and shares no beginning where the path says end."""
    if min(len(a), len(b)) != m:
        return False
    first, last = 0, 0  # code points that the states so far share
    for step in path:
        half = (m - first - last) // 2
        if step == "b":
            first += half
        elif a[first:first + half] == b[first:first + half]:
            return False
        else:
            last += half
    return True


_STATE = ["path", "m", "first", "last"]


def _halves(rows: DataFrame) -> DataFrame:
    """The two states that a word belongs to within each state: by half of what is between the shared code points."""
    half = "((m - length(first) - length(last)) div 2)"
    return rows.select("word", "n", F.explode(F.array(
        F.expr(f"struct(concat(path, 'b') AS path, m, left(word, int(length(first) + {half})) AS first, last)"),
        F.expr(f"struct(concat(path, 'e') AS path, m, first, right(word, int(length(last) + {half})) AS last)"),
    )).alias("s")).select("word", "n", "s.*")


def initial_states(words: DataFrame, group: int = GROUP) -> DataFrame:
    """``word`` and ``n`` by initial state, of at most ``group`` words each."""
    lengths = F.array(F.length("word"), F.length("word") - 1)
    every = words.select("word", "n", F.lit("").alias("path"), F.explode(lengths).alias("m"), F.lit("").alias("first"), F.lit("").alias("last"))
    rows = _halves(every.filter(F.col("m") >= LEAST_LENGTH))
    done = None
    while True:
        sizes = rows.groupBy(_STATE).agg(F.count(F.lit(1)).alias("_size"))
        # Between the shared code points of a state that is still cut lie two at least.
        hot = staged(sizes.filter((F.col("_size") > group) & (F.expr("m - length(first) - length(last)") >= 2)).select(_STATE))
        n_hot = hot.count()
        if not n_hot:
            return rows if done is None else done.unionByName(rows)
        side = F.broadcast(hot) if n_hot <= BROADCAST_STATES else hot
        settled = rows.join(side, _STATE, "left_anti")
        done = settled if done is None else done.unionByName(settled)
        rows = staged(_halves(rows.join(side, _STATE, "left_semi")))


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """``word``, ``near`` and ``near_n`` for both words of each pair, every pair once."""
    states = initial_states(words, group).groupBy(_STATE).agg(
        F.collect_list("word").alias("words"), F.collect_list("n").alias("counts")).filter("size(words) > 1")

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                columns = [part.column(c) for c in (*_STATE, "words", "counts")]
                word, near, n = [], [], []
                for row in range(part.num_rows):
                    path, m, first, last, words, counts = (c[row].as_py() for c in columns)
                    a, z = len(first), len(last)
                    known = dict(zip(words, counts, strict=True))
                    for x, y in NearPairs(sorted(w[a:len(w) - z] for w in words)):
                        x, y = first + x + last, first + y + last
                        if _counts_here(path, m, x, y):
                            word += (x, y)
                            near += (y, x)
                            n += (known[y], known[x])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(n, pa.int64())], names=["word", "near", "near_n"])

    return states.mapInArrow(compose, "word string, near string, near_n bigint")


def spelling_variants(words: DataFrame, factor: int = FACTOR, group: int = GROUP) -> DataFrame:
    """All of ``word`` and ``n`` with ``form``, ``root``, ``n_near`` and ``form_n``."""
    words = staged(words)
    best = near_pairs(words, group).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    taken = -F.col("best.less") >= factor * F.col("n")
    formed = staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n")))
    most = words.agg(F.max("n")).first()[0] or 0
    longest = 0  # forms that can follow one another
    while factor ** (longest + 1) <= most:
        longest += 1
    roots, reach = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), 1
    while reach < longest:  # each round doubles what has been followed
        roots = staged(roots)
        following = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        roots = roots.join(following, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
        reach *= 2
    found = formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    return found
