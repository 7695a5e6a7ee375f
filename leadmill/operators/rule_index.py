"""Thousands of keyword rules, looked up by words instead of tried one after the other.

Every keyword is entered in an index under one of its words, the one that the fewest keywords have, so that
thousands of keywords may begin alike. The different texts are taken apart into words and joined to
the index, and each place where a keyword may stand is verified letter by letter, with the word boundaries that the regular expressions of :mod:`leadmill.operators.score` have; of the
rules that are left the first wins. Texts are reduced to different ones before they are taken apart, so
a text that many rows share is looked up once, and one rule may have any number of keywords.

All words of a keyword are whole words of a text that it stands in, as its ends are bounded. Keywords of
nothing but signs have no word; they are few, and are tried one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.functions.text import WORD, quoted

# Bytes of the index that may be broadcast.
MAX_BROADCAST_BYTES = 64 << 20
KEYWORDS = "place int, keyword string"


def keyword_table(spark: SparkSession, rules: Sequence[dict]) -> DataFrame:
    """``place`` (1 is the first rule) and ``keyword`` of configured rules, folded as texts are."""
    rows = [(place, folded) for place, rule in enumerate(rules, 1)
            for folded in (" ".join(str(k).casefold().split()) for k in rule.get("keywords", [])) if folded]
    return spark.createDataFrame(rows, KEYWORDS)


def _bounded(df: DataFrame, *texts: str) -> DataFrame:
    """The frame, to be broadcast if its bytes are few enough."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(100)).cast("bigint")
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= MAX_BROADCAST_BYTES else df


def _in_word(c: Column) -> Column:
    return c.rlike(f"^[{WORD}]$")


def _stands(text: Column, at: Column, keyword: Column) -> Column:
    """Whether the keyword is in the text at a place (from 1), between the boundaries of its ends."""
    n = F.length(keyword)
    before = F.when(at > 1, F.substring(text, at - 1, F.lit(1))).otherwise("")
    after = F.substring(text, at + n, F.lit(1))
    # An end that is a letter must not go on as a word; one that is a sign must.
    bounded = (_in_word(before) != _in_word(F.substring(keyword, F.lit(1), F.lit(1)))) & (
        _in_word(after) != _in_word(F.substring(keyword, n, F.lit(1))))
    return (at >= 1) & (F.substring(text, at, n) == keyword) & bounded


def _words(text: str) -> Column:
    """The words of a text, each with the place of its first character, from 1."""
    first = F.regexp_replace(text, f"^[^{WORD}]+", "")
    # Each piece is a word and the signs behind it.
    pieces = F.regexp_extract_all(first, F.lit(f"[{WORD}]+[^{WORD}]*"), F.lit(0))
    start = F.struct((F.length(text) - F.length(first) + 1).alias("at"), F.array().cast("array<struct<word: string, at: int>>").alias("found"))
    word = lambda piece: F.regexp_extract(piece, f"^[{WORD}]+", 0)
    return F.aggregate(
        pieces, start,
        lambda so_far, piece: F.struct((so_far["at"] + F.length(piece)).alias("at"), F.concat(
            so_far["found"], F.array(F.struct(word(piece).alias("word"), so_far["at"].alias("at")))).alias("found")),
        lambda so_far: so_far["found"])


def rule_of_texts(texts: DataFrame, column: str, keywords: DataFrame) -> DataFrame:
    """``column`` and ``place`` of the different texts in which a keyword stands.

    Texts and keywords are folded: small letters, one space between words. ``keywords`` has ``place`` and
    ``keyword``; texts that are null or have no rule are left out.
    """
    different = texts.select(F.col(column).alias("_text")).filter("_text IS NOT NULL").distinct()
    entered = keywords.filter("keyword != ''").groupBy("keyword").agg(F.min("place").alias("place"))
    # Each keyword under the word of it that the fewest keywords have, the first of equals.
    of_keyword = entered.select("keyword", F.explode(_words("keyword")).alias("w")).select("keyword", "w.word", "w.at")
    shared = of_keyword.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    chosen = of_keyword.join(shared, "word").groupBy("keyword").agg(F.min(F.struct("n", "at", "word")).alias("c"))
    index = entered.join(chosen, "keyword").select("keyword", "place", F.col("c.word").alias("_word"), (F.col("c.at") - 1).alias("_lead"))
    words = different.select("_text", F.explode(_words("_text")).alias("w")).select("_text", F.col("w.word").alias("_word"), F.col("w.at").alias("_at"))
    maybe = words.join(_bounded(index, "_word", "keyword"), "_word")
    stands = maybe.filter(_stands(F.col("_text"), F.col("_at") - F.col("_lead"), F.col("keyword")))
    found = stands.select("_text", "place")
    signs = entered.filter(~F.col("keyword").rlike(f"[{WORD}]")).collect()
    for keyword, place in signs:
        between = F.col("_text").rlike(f"(?<=[{WORD}]){quoted(keyword)}(?=[{WORD}])")
        found = found.unionByName(different.filter(between).select("_text", F.lit(place).alias("place")))
    return found.groupBy("_text").agg(F.min("place").alias("place")).withColumnRenamed("_text", column)


def with_first_rule(df: DataFrame, column: str, keywords: DataFrame, into: str) -> DataFrame:
    """All rows with the place of the first rule that has a keyword in the text, else null, as ``into``.

    Spark sees at run time whether the texts that have a rule are few enough to be broadcast, and else
    splits what a frequent text makes too big.
    """
    found = rule_of_texts(df, column, keywords).select(F.col(column).alias("_of"), F.col("place").alias(into))
    return df.join(found, F.col(column) == F.col("_of"), "left").drop("_of")
