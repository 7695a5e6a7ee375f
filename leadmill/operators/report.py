"""Counts over the results."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.fixed_values import ENRICHED, FAILED, MERGED_DUPLICATE, NOT_ENRICHED, NOT_FOUND
from leadmill.operators.accept import EMAIL_RULE, Rule

# All states that a finished lead can have.
STATES = [ENRICHED, NOT_FOUND, FAILED, NOT_ENRICHED]
REPORT = """raw_rows bigint, clean_rows bigint, rejected_rows bigint, salesforce_ready_rows bigint,
    clean_but_not_salesforce_ready_rows bigint, average_lead_score double, percent_enriched_from_raw double,
    enrichment_status_counts map<string, bigint>, rejection_reason_counts map<string, bigint>"""


def status_counts(clean: DataFrame) -> DataFrame:
    return clean.groupBy("enrichment_status").agg(F.count(F.lit(1)).alias("leads"))


def reason_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("drop_reason").agg(F.count(F.lit(1)).alias("leads"))


def _tally(df: DataFrame, kind: str, label: str, ready=None, score=None) -> DataFrame:
    """Counts of one input by label: a handful of rows, whatever its size."""
    zero = F.lit(0).cast("bigint")
    return df.groupBy(
        F.lit(kind).alias("kind"),
        (F.coalesce(F.col(label).cast("string"), F.lit("None")) if label in df.columns
         else F.lit(None).cast("string")).alias("label"),
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        (zero if ready is None else F.count_if(F.coalesce(ready, F.lit(False)))).alias("ready"),
        (zero if score is None else F.coalesce(F.sum(F.coalesce(score, F.lit(0))), zero)).alias("score"),
    )


def summary_report(raw: DataFrame, clean: DataFrame, rejected: DataFrame) -> DataFrame:
    """The one-row report: totals, mean score, share enriched, and two maps of counts.

    Each input is reduced to counts by label on its own; the second aggregation sees only
    those few rows. Nothing is joined.
    """
    has = {c: c in clean.columns for c in ("salesforce_ready", "lead_score", "enrichment_status")}
    tallies = (
        _tally(raw, "raw", "_no_label")
        .unionByName(_tally(
            clean, "clean", "enrichment_status",
            ready=F.col("salesforce_ready") if has["salesforce_ready"] else None,
            score=F.col("lead_score") if has["lead_score"] else None,
        ))
        .unionByName(_tally(rejected, "rejected", "drop_reason"))
    )

    def total(column: str, condition) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0).cast("bigint"))

    def counts(kind: str) -> Column:
        entry = F.when(
            (F.col("kind") == kind) & F.col("label").isNotNull(),
            F.struct((-F.col("rows")).alias("o"), F.col("label"), F.col("rows")),
        )
        ordered = F.array_sort(F.collect_list(entry))  # most frequent first, then by label
        return F.map_from_entries(F.transform(ordered, lambda e: F.struct(e["label"], e["rows"])))

    kind = F.col("kind")
    totals = tallies.agg(
        total("rows", kind == "raw").alias("raw_rows"),
        total("rows", kind == "clean").alias("clean_rows"),
        total("rows", kind == "rejected").alias("rejected_rows"),
        total("ready", kind == "clean").alias("salesforce_ready_rows"),
        total("score", kind == "clean").alias("score"),
        total("rows", (kind == "clean") & (F.col("label") == ENRICHED)).alias("enriched"),
        counts("clean").alias("enrichment_status_counts"),
        counts("rejected").alias("rejection_reason_counts"),
    )
    return totals.select(
        "raw_rows",
        "clean_rows",
        "rejected_rows",
        "salesforce_ready_rows",
        (F.col("clean_rows") - F.col("salesforce_ready_rows")).alias("clean_but_not_salesforce_ready_rows"),
        F.coalesce(F.try_divide("score", "clean_rows"), F.lit(0.0)).alias("average_lead_score"),
        F.coalesce(F.try_divide("enriched", "raw_rows") * 100, F.lit(0.0)).alias("percent_enriched_from_raw"),
        "enrichment_status_counts",
        "rejection_reason_counts",
    )


# The same report from figures that Spark takes of the frames while they are written.

def raw_figures() -> dict[str, Column]:
    return {"rows": F.count(F.lit(1))}


def clean_figures() -> dict[str, Column]:
    states = {f"state {s}": F.count_if(F.col("enrichment_status") == s) for s in STATES}
    return {"rows": F.count(F.lit(1)), "ready": F.count_if("salesforce_ready"), "score": F.sum("lead_score"), **states}


def rejected_figures(rules: Sequence[Rule] = (EMAIL_RULE,)) -> dict[str, Column]:
    reasons = dict.fromkeys([*(r.reason for r in rules), MERGED_DUPLICATE])
    return {"rows": F.count(F.lit(1)), **{f"reason {r}": F.count_if(F.col("drop_reason") == r) for r in reasons}}


def report_of_figures(spark: SparkSession, raw: dict[str, Any], clean: dict[str, Any], rejected: dict[str, Any]) -> DataFrame:
    """The report of :func:`summary_report` out of the figures above; of no rows a figure may be null."""
    def counts(figures: dict[str, Any], kind: str) -> dict[str, int]:
        named = {n.removeprefix(kind): c for n, c in figures.items() if n.startswith(kind) and c}
        return dict(sorted(named.items(), key=lambda e: (-e[1], e[0])))  # most frequent first, then by label

    rows, n_clean, n_ready = (int(f or 0) for f in (raw.get("rows"), clean.get("rows"), clean.get("ready")))
    states = counts(clean, "state ")
    return spark.createDataFrame([(
        rows, n_clean, int(rejected.get("rows") or 0), n_ready, n_clean - n_ready,
        (clean.get("score") or 0) / n_clean if n_clean else 0.0,
        states.get(ENRICHED, 0) / rows * 100 if rows else 0.0,
        states, counts(rejected, "reason "),
    )], REPORT)
