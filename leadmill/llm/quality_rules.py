"""Quality of documents: statistics of whole texts, and a decision list learned from labels.

``document_statistics`` counts, per document, what the rules look at. ``learn_rules`` makes an
ordered list of rules for poor documents by sequential covering: a rule grows by the threshold
condition of the best gain on one part of the labelled rows, is pruned on the other part, and the
documents it covers are set aside before the next one. ``apply_rules`` turns the list into one
ordered conditional expression.

A null text counts as no words, so its document fails the base rules and is not kept. Repeated
rows are judged alike; empty tables give empty results; without labels there are no rules and the
base rules alone decide. Other columns of the input do not matter, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.llm.shared import pick, pieces

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct_words", "n_upper_words", "n_digits", "n_shouts", "n_bars"]

# Base rules: fewer words, or a larger percentage of repeated words, fail.
LEAST_WORDS, MOST_REPEATED = 50, 50

# Labelled documents that rules are learned from, those with the smallest hashes of their ids.
LABELLED_ROWS = 20_000
# A rule needs so many conditions at most, and on the rows it is pruned on so much precision.
CONDITIONS, PRECISION = 4, 0.9
# Thresholds that are tried for each statistic when a rule grows.
THRESHOLDS = 64


def _deleted(text: bytes, drop: bytes) -> int:
    return len(text) - len(text.translate(None, drop))


def text_counts(text: str) -> tuple[int, ...]:
    """The COUNTS of one text."""
    raw = text.encode()
    words = raw.split()  # of bytes, this splits at the six ASCII characters of white space
    repeated = 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) < len(windows):
        found = Counter(windows)
        inside = np.zeros(len(words), bool)
        starts = np.array([i for i, w in enumerate(windows) if found[w] > 1])
        for shift in range(3):
            inside[starts + shift] = True
        repeated = int(inside.sum())
    lines = [line for line in raw.split(b"\n") if line.strip(WHITE)]
    return (len(words), len(text) - _deleted(raw, WHITE), _deleted(raw, SYMBOLS), len(lines) - len(set(lines)),
            repeated, len(lines), len(set(words)), sum(map(bytes.isupper, words)),
            _deleted(raw, b"0123456789"), raw.count(b"!"), raw.count(b"|"))


def document_statistics(df: DataFrame, id_column: str = "doc_id", text: str = "text",
                        carried: tuple[str, ...] = ()) -> DataFrame:
    """The id, the COUNTS and the ``carried`` columns of every row."""
    names = [id_column, *[c for c in carried if c != id_column]]
    rows = pick(df, *names, *[text] * (text not in names))
    schema = T.StructType([rows.schema[c] for c in names] + [T.StructField(c, T.LongType()) for c in COUNTS])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            counted = [text_counts(t or "") for t in piece.column(text).to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*counted, strict=True)]
            yield pa.RecordBatch.from_arrays([*map(piece.column, names), *columns], names=[*names, *COUNTS])

    return rows.mapInArrow(count, schema)


def base_failed() -> Column:
    words = F.col("n_words")
    return (words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * words)


def measures() -> dict[str, Column]:
    """What conditions are about: shares that do not depend on a text's length."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "chars_per_word": F.col("word_chars") / words,
        "duplicate_lines": F.col("n_dup_lines") / lines,
        "repeated_words": F.col("n_repeat_words") / words,
        "distinct_words": F.col("n_distinct_words") / words,
        "upper_words": F.col("n_upper_words") / words,
        "digits_per_word": F.col("n_digits") / words,
        "shouts_per_word": F.col("n_shouts") / words,
        "bars_per_word": F.col("n_bars") / words,
        "words_per_line": F.col("n_words") / lines,
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    at_least: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        v = values[self.measure]
        return v >= self.threshold if self.at_least else v <= self.threshold

    def column(self) -> Column:
        made = measures()[self.measure]
        return made >= F.lit(self.threshold) if self.at_least else made <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.measure} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    covered = np.ones(n, bool)
    for condition in rule:
        covered &= condition.holds(values)
    return covered


def _best_condition(values: dict[str, np.ndarray], poor: np.ndarray) -> Condition | None:
    """The condition of the greatest information gain over the rows given."""
    p, n = poor.sum(), len(poor)
    best, best_gain = None, 1e-9
    before = np.log2(p / n)
    for name, v in values.items():
        cuts = np.unique(np.quantile(v, np.linspace(0, 1, THRESHOLDS)))
        for cut in (cuts[1:] + cuts[:-1]) / 2:
            for at_least in (True, False):
                covered = v >= cut if at_least else v <= cut
                hit = (covered & poor).sum()
                if hit:
                    gain = hit * (np.log2(hit / covered.sum()) - before)
                    if gain > best_gain:
                        best, best_gain = Condition(name, at_least, float(cut)), gain
    return best


def learn_rules(values: dict[str, np.ndarray], poor: np.ndarray) -> list[Rule]:
    """An ordered list of rules for poor rows; every third row is for pruning."""
    n = len(poor)
    prune = np.arange(n) % 3 == 2
    left, rules = np.ones(n, bool), []
    while (left & ~prune & poor).any():
        rule: Rule = ()
        inside = left & ~prune
        while len(rule) < CONDITIONS and not poor[inside].all():
            condition = _best_condition({k: v[inside] for k, v in values.items()}, poor[inside])
            if condition is None:
                break
            rule += (condition,)
            inside &= condition.holds(values)
        best, best_worth = (), -1.0
        for length in range(1, len(rule) + 1):
            covered = _covered(rule[:length], values, n) & left & prune
            hits = (covered & poor).sum()
            worth = (hits + 1) / (covered.sum() + 2)  # Laplace, so that few rows prove little
            if hits >= PRECISION * covered.sum() and worth > best_worth:
                best, best_worth = rule[:length], worth
        covered = _covered(best, values, n) & left if best else np.zeros(n, bool)
        if not (covered & ~prune & poor).any() or poor[covered].mean() < PRECISION:
            break
        rules.append(best)
        left &= ~covered
    return rules


def labelled_statistics(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> DataFrame:
    """Measures and label of at most ``limit`` labelled documents that pass the base rules.

    A document with several labels counts as poor if one of them says so.
    """
    known = pick(labels, "doc_id", "quality").dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = pick(docs, "doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    counted = document_statistics(texts).filter(~base_failed())
    return counted.select("doc_id", *[m.alias(k) for k, m in measures().items()]).join(
        F.broadcast(chosen), "doc_id")


def fit_rules(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> list[Rule]:
    """Learn from ``labels`` (doc_id, quality: 0 is poor) and the texts of ``docs``."""
    rows = labelled_statistics(docs, labels, limit).toPandas().sort_values("doc_id", kind="stable")
    rows = rows.drop_duplicates()
    if not len(rows):
        return []
    return learn_rules({k: rows[k].to_numpy(float) for k in measures()}, (rows["quality"] == 0).to_numpy())


def apply_rules(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """``base_failed``, ``failed_rule`` (the first rule that holds, as text) and ``kept``."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        holds = rule[0].column()
        for condition in rule[1:]:
            holds &= condition.column()
        verdict = F.when(holds, F.lit(" and ".join(map(str, rule)))).otherwise(verdict)
    judged = statistics.withColumns({"base_failed": base_failed(), "failed_rule": verdict})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull())
