"""Infer company facts from names, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.fixed_values import (
    COMPANY_INDUSTRY_WORDS,
    COMPANY_SIZE_WORDS,
    DEFAULT_COMPANY_SIZE,
    ENRICHED,
    NOT_FOUND,
    TITLE_INDUSTRY_WORDS,
    UNKNOWN_INDUSTRY,
)
from leadmill.functions.text import col, normalize_text
from leadmill.schema import column_or_null


def _first_label(*lookups: tuple[Column, list[tuple[str, list[str]]]], default: str) -> Column:
    """Label of the first word list of which a word occurs anywhere in its text."""
    labels = []
    for text, lists in lookups:
        for label, words in lists:
            hit = F.lit(False)
            for word in words:
                hit = hit | text.contains(word)
            labels.append(F.when(hit, F.lit(label)))
    return F.coalesce(*labels, F.lit(default))


def infer_industry(company: Column | str, title: Column | str) -> Column:
    return _first_label(
        (F.lower(col(company)), COMPANY_INDUSTRY_WORDS),
        (F.lower(col(title)), TITLE_INDUSTRY_WORDS),
        default=UNKNOWN_INDUSTRY,
    )


def infer_company_size(company: Column | str) -> Column:
    return _first_label((F.lower(col(company)), COMPANY_SIZE_WORDS), default=DEFAULT_COMPANY_SIZE)


def infer_company_domain(company: Column | str) -> Column:
    return F.concat(F.regexp_replace(F.lower(col(company)), r"[^\p{L}\p{N}]+", ""), F.lit(".com"))


def enrich_leads(df: DataFrame, normalized: bool = False) -> DataFrame:
    """Append industry, company size, company domain and status; a missing company is not found.

    ``normalized`` says that the text is clean already, as it is after the merge.
    """
    given = {c: column_or_null(df, c) for c in ("company", "title")}
    known = df.withColumns({f"_{c}": v if normalized else normalize_text(v) for c, v in given.items()})
    found = F.col("_company").isNotNull()
    return known.withColumns({
        "industry": F.when(found, infer_industry("_company", "_title")),
        "company_size": F.when(found, infer_company_size("_company")),
        "company_domain": F.when(found, infer_company_domain("_company")),
        "enrichment_status": F.when(found, F.lit(ENRICHED)).otherwise(F.lit(NOT_FOUND)),
    }).drop("_company", "_title")
