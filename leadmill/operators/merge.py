"""Merge the accepted leads that share an e-mail address."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.fixed_values import LEAD_FIELDS, MERGED_DUPLICATE
from leadmill.functions.text import is_present
from leadmill.operators.accept import EMAIL_RULE, Rule, accept_leads, reject_leads
from leadmill.schema import ROW_NUMBER


def _first(c: str) -> Column:
    """Value of the earliest row that has one."""
    return F.min_by(c, F.when(F.col(c).isNotNull(), F.col(ROW_NUMBER)))


def _longest(c: str) -> Column:
    """Longest value, the earliest row of equally long ones."""
    return F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(F.length(c), -F.col(ROW_NUMBER))))


def _best_phone(c: str) -> Column:
    """An international number before others, then as the longest."""
    rank = F.struct(F.col(c).startswith("+"), F.length(c), -F.col(ROW_NUMBER))
    return F.max_by(c, F.when(F.col(c).isNotNull(), rank))


# How one value is chosen per field; every other field takes its first value.
MERGE_POLICY = {
    ROW_NUMBER: F.min,
    "lead_date": F.min,
    "phone": _best_phone,
    "full_name": _longest,
    "title": _longest,
    "company": _longest,
}


def merge_leads(accepted: DataFrame, key: str = "email", count: str | None = None) -> DataFrame:
    """One row per e-mail, each field by its policy; empty fields must be null.

    ``count`` names a column for the number of rows that became one.

    All policies are aggregates with partial results, so a map task sends one row per e-mail
    it holds, whatever share of the rows one e-mail has, and no group is ever gathered. Every
    tie ends in the row number: the result does not depend on the partitioning.
    """
    fields = [c for c in accepted.columns if c != key]
    counted = [F.count(F.lit(1)).alias(count)] if count else []
    merged = accepted.groupBy(key).agg(
        *[MERGE_POLICY.get(c, _first)(c).alias(c) for c in fields], *counted)
    return merged.select(*accepted.columns, *([count] if count else []))


def surviving_rows(accepted: DataFrame, key: str = "email") -> DataFrame:
    """Row numbers that stay, the lowest per e-mail. Moves an e-mail and a number per group."""
    return accepted.groupBy(key).agg(F.min(ROW_NUMBER).alias(ROW_NUMBER)).select(ROW_NUMBER)


def duplicate_rejects(accepted: DataFrame, survivors: DataFrame | None = None) -> DataFrame:
    """The rows merged into another one, as they were.

    The anti join is on the row number, which is unique, so a frequent e-mail is spread evenly.
    ``survivors`` may be any frame with the surviving row numbers, such as the written clean leads.
    """
    kept = surviving_rows(accepted) if survivors is None else survivors.select(ROW_NUMBER)
    return accepted.join(kept, ROW_NUMBER, "left_anti").withColumn(
        "drop_reason", F.lit(MERGED_DUPLICATE)
    )


def all_rejects(
    normalized: DataFrame,
    survivors: DataFrame,
    rules: Sequence[Rule] = (EMAIL_RULE,),
) -> DataFrame:
    """Both kinds of rejects.

    Rows that break a rule are filtered out where they are; only accepted rows are joined with
    the survivors, and those that do not survive are merged duplicates.
    """
    return reject_leads(normalized, rules).unionByName(
        duplicate_rejects(accept_leads(normalized, rules), survivors))


def ordered_rejects(rejects: DataFrame, merged: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rejects in the order of a report: rows that broke a rule, then duplicates beside each other, each by row.

    Duplicates are ordered by the row that they were merged into, which ``merged`` (any frame with the row
    numbers and e-mails of merged leads) has. Rows are dealt to tasks by ranges of this order, sampled by
    Spark, and sorted in them; written files follow one another in it. An e-mail that very many rows share
    is cut by row number like any other range, and in the join by Spark where it is too big.
    """
    duplicate = F.col("drop_reason") == MERGED_DUPLICATE
    into = merged.select(F.col("email").alias("_email"), F.col(ROW_NUMBER).alias("_into"))
    keyed = rejects.join(into, duplicate & (F.col("email") == F.col("_email")), "left")
    order = [F.coalesce(duplicate, F.lit(False)), F.coalesce("_into", F.lit(0)), F.col(ROW_NUMBER)]
    dealt = keyed.repartitionByRange(tasks, *order) if tasks else keyed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).drop("_email", "_into")


def lead_completeness(df: DataFrame) -> DataFrame:
    """Append how many of the lead fields hold a value."""
    present = [is_present(c).cast("int") for c in LEAD_FIELDS if c in df.columns]
    return df.withColumn("completeness", reduce(add, present, F.lit(0)))
