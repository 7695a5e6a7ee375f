"""Language-model scores of documents by stupid backoff, over n-gram counts of a whole corpus.

The score of a word after the words before it is the count of the longest n-gram that ends in it and
that the tables have, by the count of the n-gram without it, times BACKOFF for each word the n-gram
is shorter than it could be; at last it is the word's share of all words. A document's score is the
sum of the logarithms. Tables hold the n-grams of the whole corpus; no count is cut off.

- ``gram_counts``: n-grams are exploded, counted within tasks, and added up in hash partitions.
- ``backoff_scores`` joins the exploded n-grams of the documents to that table and sums per document.
  Of a corpus that scores itself the table has every n-gram, so the counts of n-grams and of the
  n-grams that begin the next ones cancel but for two lengths, and only these are exploded: each
  row is a document, an n-gram and whether its count's logarithm is added or taken away. Counts of 1
  add nothing and are not stored.
- Another corpus (``corpus``) lacks some; then all lengths are joined, and the longest that is there
  is taken at each place, with BACKOFF for the rest. A word that it lacks counts as found once.

An n-gram with more than one in HOT of all words may be no join's key: there are at most HOT of a length,
so their counts are sent to all tasks, and no partition of the join is hot. Of a corpus that scores itself the next
frequent ones go with them, up to HOT of a length. Everything else that is sent is linear in the words. N-grams are known by 64-bit hashes. Words are separated by ASCII white space, A-Z count
as small. Null texts and texts without words score 0 over 0 words. Repeated rows and rows without
an id all count and are all scored; empty tables give empty results; other columns do not matter.
Rows are told apart by numbers given while they are read, so ``df`` should come from a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.llm.shared import HASHED_BYTES, pick, pieces, staged, unstage
from leadmill.llm.words import SortedHashes, mix, word_hashes

BACKOFF = 0.4
# N-grams of a length whose counts may be sent to all tasks, 16 bytes each.
HOT = 500_000
# Words that a task counts before it hands on the counts, and exploded n-grams of a join's partition, about.
BATCH_WORDS, PARTITION_GRAMS = 1_000_000, 3_000_000

_FACTOR = np.uint64(0xD1342543DE82EF95)
# The n-gram of no words, which a corpus has as often as it has words.
_EMPTY = 0


def _grams(words: np.ndarray, ends: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of the n-grams of 1 to ``order`` words that end at each word, the word's place in its document,
    and the document's number; a hash stands for nothing where the document has no such n-gram."""
    sizes = np.diff(ends, prepend=0)
    doc = np.repeat(np.arange(len(ends)), sizes)
    place = np.arange(len(words)) - (ends - sizes)[doc]
    grams = [words]
    for _ in range(order - 1):
        longer = np.zeros_like(words)
        longer[1:] = mix(grams[-1][:-1] * _FACTOR + words[1:])
        grams.append(longer)
    return grams, place, doc


def _batch(**columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v.view(np.int64) if isinstance(v, np.ndarray) and v.dtype == np.uint64 else v
                                       for k, v in columns.items()})


def gram_counts(df: DataFrame, order: int, text: str = "text") -> DataFrame:
    """The n-grams of 1 to ``order`` words with their number ``n``, their ``length`` and their ``context``, the n-gram
    without its last word; that of no words has the number of all words."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list[np.ndarray], np.ndarray]] = []

        def counted() -> Iterator[pa.RecordBatch]:
            for k in range(1, order + 1):
                found = np.concatenate([g[k - 1][place >= k - 1] for g, place in held])
                before = [np.concatenate([np.zeros(1, np.uint64), g[k - 2][:-1]])[place >= k - 1]
                          if k > 1 else np.zeros(len(place), np.uint64) for g, place in held]
                gram, first, n = np.unique(found, return_index=True, return_counts=True)
                yield _batch(gram=gram, context=np.concatenate(before)[first], length=np.full(len(gram), k, np.int8), n=n)
            yield _batch(gram=np.zeros(1, np.uint64), context=np.zeros(1, np.uint64), length=np.zeros(1, np.int8),
                         n=np.array([sum(len(place) for _, place in held)]))

        for piece in pieces(batches, 0, HASHED_BYTES):
            grams, place, _ = _grams(*word_hashes(piece.column(0)), order)
            if len(place):
                held.append((grams, place))
            if sum(len(place) for _, place in held) >= BATCH_WORDS:
                yield from counted()
                held = []
        if held:
            yield from counted()

    return (pick(df, text).mapInArrow(explode, "gram long, context long, length byte, n long")
            .groupBy("gram").agg(F.sum("n").alias("n"), F.first("context").alias("context"), F.first("length").alias("length")))


def _words_of(counts: DataFrame) -> int:
    row = counts.filter(F.col("gram") == _EMPTY).first()
    return row["n"] if row else 1


def _often(counts: DataFrame, n_words: int) -> Column:
    """The most frequent n-grams, at most HOT of each length: all with more than one in HOT of the words, and those
    with the counts below that for which there is room."""
    step = F.floor(8 * F.log2("n"))
    sizes: dict[int, list[tuple[int, int]]] = {}
    for length, least, many in counts.groupBy("length", step.alias("step")).agg(F.count("*").alias("many")).collect():
        sizes.setdefault(length, []).append((least, many))  # a row for each eighth of a power of two
    often = F.col("n") * HOT > n_words
    for length, of_step in sizes.items():
        held, from_step = 0, None
        for least, many in sorted(of_step, reverse=True):
            held += many
            if held > HOT:
                break
            from_step = least
        if from_step is not None:
            often |= (F.col("length") == length) & (step >= from_step)
    return often


def backoff_scores(df: DataFrame, order: int = 2, id_column: str = "doc_id", text: str = "text",
                   corpus: DataFrame | None = None) -> DataFrame:
    """Per row: the id, ``n_words`` and ``log_score``, the sum of natural logarithms. The counts are those of
    ``corpus``, or of ``df`` itself."""
    rows = pick(df, id_column, text).withColumn("row", F.monotonically_increasing_id())
    return _scores_by(rows, order, id_column, text, corpus) if corpus is not None else _scores_by_itself(rows, order, id_column, text)


def _scores_by_itself(rows: DataFrame, order: int, id_column: str, text: str) -> DataFrame:
    # Counts of 1 have the logarithm 0, so an n-gram that the table lacks adds nothing.
    counts = staged(gram_counts(rows, order, text).filter("n > 1").select("gram", "n", "length"))
    n_words = _words_of(counts)
    often = _often(counts, n_words) & (F.col("gram") != _EMPTY)
    table = counts.filter(often).select("gram", "n").toArrow()  # at most HOT of each length
    hot, hot_n = table.column("gram").to_numpy().view(np.uint64), table.column("n").to_numpy()
    hot, hot_logs = SortedHashes(hot[np.argsort(hot)]), np.log(hot_n[np.argsort(hot)])
    partitions = 1 + 2 * n_words // PARTITION_GRAMS

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text, HASHED_BYTES):
            words, ends = word_hashes(piece.column(text))
            grams, place, doc = _grams(words, ends, order)
            sizes = np.diff(ends, prepend=0)
            last = place == sizes[doc] - 1
            # Longest n-grams are added, and those that begin the next one's are taken away.
            chosen = [(grams[order - 1], place >= order - 1, 1)]
            if order > 1:
                chosen.append((grams[order - 2], (place >= order - 1) & ~last, -1))
            for k in range(1, order):  # documents of fewer words: all of them
                chosen.append((grams[k - 1], last & (place == k - 1), 1))
            gram, of, sign = (np.concatenate(x) for x in zip(*[
                (g[m], doc[m], np.full(int(m.sum()), s, np.int64)) for g, m, s in chosen], strict=True))
            base = -np.log(n_words) * (sizes if order == 1 else np.minimum(sizes, 1))
            if hot.n:
                known, at = hot.find(gram)
                base = base + np.bincount(of[known], sign[known] * hot_logs[at], len(sizes))
                gram, of, sign = gram[~known], of[~known], sign[~known]
            number = piece.column("row").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(number[of]), pa.array(sign), pa.nulls(len(gram), pa.float64()),
                 pa.nulls(len(gram), pa.int64()), pa.nulls(len(gram), piece.column(id_column).type)],
                names=made.names)
            # A row for the document itself, under a key of its own so that these are dealt out evenly.
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix(number.astype(np.uint64) + _FACTOR).view(np.int64)), piece.column("row"),
                 pa.array(np.zeros(len(number), np.int64)), pa.array(base.astype(float)), pa.array(sizes.astype(np.int64)),
                 piece.column(id_column)], names=made.names)

    made = T.StructType([
        T.StructField("gram", T.LongType()), T.StructField("row", T.LongType()), T.StructField("sign", T.LongType()),
        T.StructField("base", T.DoubleType()), T.StructField("n_words", T.LongType()),
        T.StructField("id", rows.schema[id_column].dataType)])
    exploded = rows.mapInArrow(explode, made)
    light = counts.filter(~often).select("gram", "n")
    joined = exploded.repartition(partitions, "gram").join(light.repartition(partitions, "gram"), "gram", "left")
    joined = joined.filter("n IS NOT NULL OR base IS NOT NULL")  # the others add nothing
    part = F.coalesce("base", F.lit(0.0)) + F.col("sign") * F.log(F.coalesce("n", F.lit(1)).cast("double"))
    return joined.groupBy("row").agg(
        F.first("id", ignorenulls=True).alias(id_column), F.max("n_words").alias("n_words"),
        F.sum(part).alias("log_score")).drop("row")


def _scores_by(rows: DataFrame, order: int, id_column: str, text: str, corpus: DataFrame) -> DataFrame:
    counts = staged(gram_counts(corpus, order))
    n_words = _words_of(counts)
    before = counts.select(F.col("gram").alias("context"), F.col("n").alias("n_before"))
    shares = staged(
        counts.filter("length > 1").join(before, "context").select("gram", "n", (F.log("n") - F.log("n_before")).alias("share"))
        .unionByName(counts.filter("length = 1").select("gram", "n", (F.log("n") - F.log(F.lit(n_words))).alias("share"))))
    unstage(counts)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text, HASHED_BYTES):
            grams, place, doc = _grams(*word_hashes(piece.column(text)), order)
            number = piece.column("row").to_numpy()
            for k in range(1, order + 1):
                m = place >= k - 1
                yield _batch(gram=grams[k - 1][m], row=number[doc[m]], place=place[m],
                             skipped=np.minimum(place[m], order - 1) - (k - 1), length=np.full(int(m.sum()), k))

    exploded = rows.mapInArrow(explode, "gram long, row long, place long, skipped long, length long")
    often = F.col("n") * HOT > n_words
    hot = F.broadcast(shares.filter(often).select("gram", "share"))  # at most HOT of each length
    found = exploded.join(hot, "gram").unionByName(
        exploded.join(hot.select("gram"), "gram", "left_anti").join(shares.filter(~often).select("gram", "share"), "gram", "left")
        .filter("share IS NOT NULL OR length = 1"))
    score = F.coalesce("share", F.lit(-float(np.log(n_words)))) + F.col("skipped") * float(np.log(BACKOFF))
    sums = (found.groupBy("row", "place").agg(F.max_by(score, "length").alias("score"))
            .groupBy("row").agg(F.count("*").alias("n_words"), F.sum("score").alias("log_score")))
    return rows.select("row", id_column).join(sums, "row", "left").select(
        id_column, F.coalesce("n_words", F.lit(0)).alias("n_words"), F.coalesce("log_score", F.lit(0.0)).alias("log_score"))
