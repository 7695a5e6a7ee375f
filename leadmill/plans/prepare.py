"""The whole preparation from one normalised table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame

from leadmill.fixed_values import SCORING_RULES
from leadmill.operators.accept import accept_leads
from leadmill.operators.enrich import enrich_leads
from leadmill.operators.finalize import finalize_leads
from leadmill.operators.merge import all_rejects, merge_leads, surviving_rows
from leadmill.operators.normalize import normalize_leads
from leadmill.operators.report import summary_report
from leadmill.operators.score import score_leads
from leadmill.plans.staging import Staging
from leadmill.sources.leads import prepare_leads


class PreparedLeads(NamedTuple):
    clean: DataFrame
    rejected: DataFrame
    summary: DataFrame


def clean_from_merged(
    merged: DataFrame,
    rules: dict | None = None,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    kept: Sequence[str] = (),
) -> DataFrame:
    """Enrich, score and finalise merged leads; narrow from end to end."""
    if enrich is None:
        enriched = enrich_leads(merged, normalized=True)
    else:
        enriched = enrich(merged)
    # A provider's answers are text of any kind, so blanks among them are looked for.
    normalized = enrich is None
    scored = score_leads(enriched, SCORING_RULES if rules is None else rules, normalized)
    return finalize_leads(scored, normalized, kept)


def prepare_all(
    raw: DataFrame,
    row_number: Column | str,
    rules: dict | None = None,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
    countries: DataFrame | None = None,
    staging: Staging | None = None,
) -> PreparedLeads:
    """Clean leads, rejected leads and summary of a raw table.

    The raw table is scanned and normalised once, into a staged table that all three results read by
    column; each of them is lazy. Remove the ``staging`` when they are done with. Row numbers must be
    unique and not null, which ``check_row_numbers`` tells beforehand and ``run_job`` checks by
    itself. To have the results written, with rows numbered 1..n by their place in the input, use ``run_job``.
    """
    staging = staging or Staging(raw.sparkSession)
    normalized = staging.write(normalize_leads(prepare_leads(raw, row_number), countries), "normalized")
    accepted = accept_leads(normalized)
    clean = clean_from_merged(merge_leads(accepted), rules, enrich)
    rejected = all_rejects(normalized, surviving_rows(accepted))
    return PreparedLeads(clean, rejected, summary_report(normalized, clean, rejected))
