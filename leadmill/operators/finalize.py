"""Give clean leads their final columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.fixed_values import CLEAN_COLUMNS, NOT_ENRICHED, READY_FIELDS
from leadmill.functions.text import is_present
from leadmill.schema import type_of, with_missing_as_null


def _defaults() -> dict[str, Column]:
    none = F.lit(None).cast("string")
    return {
        "industry": none,
        "company_size": none,
        "company_domain": none,
        "enrichment_status": F.lit(NOT_ENRICHED),
        "lead_score": F.lit(0),
        "score_reasons": F.array().cast("array<string>"),
    }


def finalize_leads(scored: DataFrame, normalized: bool = False, kept: Sequence[str] = ()) -> DataFrame:
    """Fill absent columns and empty values, flag leads that may be imported, order columns.

    ``normalized`` says that empty text is null already, which saves looking for blank text;
    ``kept`` columns are passed on as well.
    """
    filled = with_missing_as_null(scored, CLEAN_COLUMNS)
    kinds = {f.name: f.dataType.typeName() for f in filled.schema}

    def present(c: str) -> Column:
        return F.col(c).isNotNull() if normalized else is_present(c, kinds[c])

    ready = F.lit(True)
    for field in READY_FIELDS:
        ready = ready & present(field)
    columns = {
        c: F.when(present(c), F.col(c)).otherwise(default)
        for c, default in _defaults().items()
    }
    columns["salesforce_ready"] = ready
    return filled.withColumns(columns).select(*[F.col(c).cast(type_of(c)) for c in CLEAN_COLUMNS], *kept)
