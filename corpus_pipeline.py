"""A pipeline over documents: each stage is one operator, written as a table and read back.

Rows with a null text fail the quality rules; rows with a null id are judged like all others but
never count as copies; rows that repeat an id are one document, of which one row stays; empty tables
give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.llm.decontaminate import without_passages
from leadmill.llm.ngram_join import near_duplicates
from leadmill.llm.quality_rules import apply_rules, document_statistics, fit_rules
from leadmill.llm.queries import piece_digests, table
from leadmill.llm.secret_scan import scan_secrets, secret_forest
from leadmill.llm.shared import pick, staged, without_ids

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Near copies share five-word shingles from a similarity of 0.8; op7's query has a contract of its own.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the rules learned from labels."""
    rules = fit_rules(docs, table(spark, sf_dir, "labels"))
    judged = apply_rules(document_statistics(docs, carried=tuple(COLUMNS)), rules)
    return judged.filter("kept").select(COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    docs = pick(docs, *COLUMNS)
    found = near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT)
    groups = staged(found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("rows")))
    kept = without_ids(docs, groups.filter("component_id != doc_id").select("doc_id"))
    repeated = groups.filter("component_id = doc_id AND rows > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return without_ids(kept, repeated).unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return without_passages(pick(docs, *COLUMNS), table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets taken out of the text."""
    docs = pick(docs, *COLUMNS)
    forest = secret_forest(docs)
    scanned = scan_secrets(docs, forest, carried=tuple(COLUMNS))
    return scanned.withColumns({
        "text": F.col("redacted"),
        "n_chars": F.when(F.size("secrets") > 0, F.length("redacted").cast("long")).otherwise(F.col("n_chars")),
    }).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every text and of the text decoded from them."""
    return piece_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact),
    ("SentencePiece encoding", encode),
]

# Learned rules and merged vocabularies have no equal in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the result of the last one."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
