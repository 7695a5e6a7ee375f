"""Lead operators, each a ``DataFrame -> DataFrame`` function."""

from leadmill.operators.accept import EMAIL_RULE, MALFORMED_RULE, Rule, accept_leads, reject_leads
from leadmill.operators.enrich import enrich_leads
from leadmill.operators.export import crm_export, reasons_text
from leadmill.operators.finalize import finalize_leads
from leadmill.operators.merge import (
    MERGE_POLICY,
    all_rejects,
    duplicate_rejects,
    lead_completeness,
    merge_leads,
    ordered_rejects,
    surviving_rows,
)
from leadmill.operators.normalize import normalize_leads
from leadmill.operators.provider import (
    ProviderResponse,
    TransientProviderError,
    enrich_with_provider,
    provider_responses,
)
from leadmill.operators.report import reason_counts, status_counts, summary_report
from leadmill.operators.score import compile_rules, first_matching_rule, score_leads

__all__ = [
    "EMAIL_RULE",
    "MALFORMED_RULE",
    "MERGE_POLICY",
    "ProviderResponse",
    "Rule",
    "TransientProviderError",
    "accept_leads",
    "all_rejects",
    "compile_rules",
    "crm_export",
    "duplicate_rejects",
    "enrich_leads",
    "enrich_with_provider",
    "finalize_leads",
    "first_matching_rule",
    "lead_completeness",
    "merge_leads",
    "normalize_leads",
    "ordered_rejects",
    "provider_responses",
    "reason_counts",
    "reasons_text",
    "reject_leads",
    "score_leads",
    "status_counts",
    "summary_report",
    "surviving_rows",
]
