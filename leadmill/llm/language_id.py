"""Language of texts by words first, and by ever shorter runs of characters for unseen words.

A word that was learned counts with the logarithm of its share in each language. Any other word
counts with the mean over its character runs of the greatest length of which one is known; only
if none is known, shorter runs are tried. A text's language is the one of the best mean over its
words; equal means go to the smaller name.

Lower-cased runs of letters are the words. A text that is null or has no letter is ``und`` with
score 0; so is every text if nothing could be learned. Repeated rows get the same result, empty
tables an empty one; other columns do not matter, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.llm.shared import pick, pieces

WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"

# About so many documents of each language are learned from, chosen by a hash of the id.
DOCUMENTS_PER_LANGUAGE = 1_000
# Words and runs of characters that a model holds at most: those with the greatest share of any language's
# words or runs, so that a language with little to learn from keeps its frequent ones, too.
MODEL_WORDS, MODEL_RUNS = 100_000, 200_000
LONGEST_RUN = 5
# What a word or run counts in a language that lacks it: this much below its rarest one.
PENALTY = 1.5
# Unseen words that a task remembers.
REMEMBERED_WORDS = 300_000


@dataclass(frozen=True)
class LanguageModel:
    """Rows of logarithms by word and by run of characters; the last row of ``runs`` is for others."""

    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    runs: dict[str, int]
    run_scores: np.ndarray


class Scorer:
    """Scores of words, those of unseen ones kept for a while."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.row_of, self.extra, self.size = dict(self.model.words), [], len(self.model.words)

    def unseen(self, words: list[str]) -> np.ndarray:
        """Each word's mean over its longest runs of which one is known."""
        model = self.model
        other = len(model.runs)
        scores = np.empty((len(words), len(model.languages)), np.float32)
        waiting = list(range(len(words)))
        for length in range(LONGEST_RUN, 0, -1):
            at, ends, settled, later = [], [0], [], []
            for i in waiting:
                padded = f" {words[i]} " if length > 1 else words[i]
                rows = [model.runs.get(padded[j:j + length], other)
                        for j in range(max(1, len(padded) - length + 1))]
                if length == 1 or min(rows) != other:
                    at.extend(rows)
                    ends.append(len(at))
                    settled.append(i)
                else:
                    later.append(i)
            if settled:
                sums = np.add.reduceat(model.run_scores[at], ends[:-1], axis=0)
                scores[settled] = sums / np.diff(ends)[:, None]
            waiting = later
        return scores

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of words, and the table that they are rows of."""
        new = [w for w in set(words) if w not in self.row_of]
        if new:
            self.extra.append(self.unseen(new))
            self.row_of.update(zip(new, range(self.size, self.size + len(new)), strict=True))
            self.size += len(new)
            if len(self.extra) > 1:
                self.extra = [np.concatenate(self.extra)]
        row_of = self.row_of
        numbers = np.array([row_of[w] for w in words], np.int64)
        scores = np.concatenate([self.model.word_scores, *self.extra]) if self.extra else self.model.word_scores
        return numbers, scores

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [WORD.findall((t or "").lower()) for t in texts]
        found = [w if any(c.isalpha() for c in "".join(w)) else [] for w in found]
        out = [(UNDETERMINED, 0.0)] * len(texts)
        lettered = [i for i, w in enumerate(found) if w]
        if not self.model.languages or not lettered:
            return out
        if self.size > len(self.model.words) + REMEMBERED_WORDS:
            self.forget()
        numbers, scores = self.rows([w for i in lettered for w in found[i]])
        sizes = np.array([len(found[i]) for i in lettered])
        starts = np.cumsum(sizes) - sizes
        means = np.add.reduceat(scores[numbers].astype(np.float64), starts, axis=0) / sizes[:, None]
        best = means.argmax(1)
        shares = np.exp(means - means.max(1, keepdims=True))
        confidence = 1 / shares.sum(1)
        for i, b, c in zip(lettered, best.tolist(), confidence.tolist(), strict=True):
            out[i] = self.model.languages[b], c
        return out


def _logarithms(counted: dict[str, dict[str, int]], languages: list[str]) -> np.ndarray:
    """Log shares by row and language, a penalty where a language lacks the row; one row more for others."""
    counts = np.zeros((len(counted) + 1, len(languages)))
    if not languages:
        return counts.astype(np.float32)
    place = {name: i for i, name in enumerate(languages)}
    for row, by_language in enumerate(counted.values()):
        for name, n in by_language.items():
            counts[row, place[name]] = n
    totals = np.maximum(counts.sum(0), 1)
    with np.errstate(divide="ignore"):
        logs = np.log(counts / totals)
    # The same for all languages, so that one with fewer words to learn from has no advantage.
    lowest = np.log(1 / totals.max()) - PENALTY
    return np.where(counts > 0, np.maximum(logs, lowest), lowest).astype(np.float32)


def training_rows(df: DataFrame, learn_from: str, per_language: int = DOCUMENTS_PER_LANGUAGE) -> DataFrame:
    """Text and language of about ``per_language`` rows of each language that satisfy a condition."""
    rows = pick(df, "doc_id", "lang", "text").filter(learn_from).filter("lang IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows"))
    buckets = 1 << 20
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(buckets)) * F.col("_rows") < F.lit(buckets * per_language)
    return rows.join(F.broadcast(sizes), "lang").filter(chosen).filter("text IS NOT NULL").select("lang", "text")


def fit_languages(rows: DataFrame) -> LanguageModel:
    """Learn from a bounded table of ``lang`` and ``text``."""
    letters = F.split(F.lower("text"), r"[^\p{L}]+")
    counted = (rows.select("lang", F.explode(letters).alias("word")).filter("word != ''")
               .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    padded = F.concat(F.lit(" "), "word", F.lit(" "))
    lengths = F.sequence(F.lit(1), F.lit(LONGEST_RUN))
    # Runs of one character do not include the spaces around a word.
    runs = (counted.select("lang", "n", "word", padded.alias("padded"), F.explode(lengths).alias("length"))
            .select("lang", "n", "length", F.when(F.col("length") == 1, F.col("word")).otherwise(F.col("padded")).alias("p"))
            .filter("length(p) >= length")
            .select("lang", "n", F.explode(F.expr(
                "transform(sequence(1, length(p) - length + 1), i -> substring(p, i, length))")).alias("run"))
            .groupBy("lang", "run").agg(F.sum("n").alias("n")))

    def top(df: DataFrame, key: str, limit: int) -> dict[str, dict[str, int]]:
        of_language = df.groupBy("lang").agg(F.sum("n").alias("_all"))
        whole = df.join(F.broadcast(of_language), "lang").groupBy(key).agg(
            F.sum("n").alias("total"), F.max(F.col("n") / F.col("_all")).alias("share"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_language"))
        best = whole.filter("total > 1").orderBy(F.desc("share"), key).limit(limit).collect()
        return {r[key]: r["by_language"] for r in best}

    words, characters = top(counted, "word", MODEL_WORDS), top(runs, "run", MODEL_RUNS)
    languages = sorted({name for c in (words, characters) for by in c.values() for name in by})
    return LanguageModel(
        languages,
        {w: i for i, w in enumerate(words)}, _logarithms(words, languages)[:-1],
        {r: i for i, r in enumerate(characters)}, _logarithms(characters, languages),
    )


def identify_languages(df: DataFrame, model: LanguageModel, id_column: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """The id of every row with ``lang_pred`` and ``score``, the share of the best language."""
    rows = pick(df, id_column, text)
    schema = T.StructType([rows.schema[id_column], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    sent = df.sparkSession.sparkContext.broadcast(model)  # bounded by MODEL_WORDS and MODEL_RUNS

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for piece in pieces(batches, text):
            names, scores = zip(*scorer.predict(piece.column(text).to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [piece.column(id_column), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[id_column, "lang_pred", "score"],
            )

    return rows.mapInArrow(predict, schema)
