"""The CRM import table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.fixed_values import CRM_NAMES
from leadmill.functions.text import strip
from leadmill.schema import with_missing_as_null


def reasons_text(c: str, kind: T.DataType) -> Column:
    """Reasons as one text: items stripped, blank ones left out, joined by "; "."""
    text = F.col(c)
    if isinstance(kind, T.ArrayType):
        text = F.array_join(F.filter(F.transform(text, strip), lambda item: item != ""), "; ")
    return F.nullif(strip(text), F.lit(""))


def crm_export(clean: DataFrame, ready_only: bool = True) -> DataFrame:
    """Rename to the CRM's columns; by default only the leads that may be imported."""
    if ready_only and "salesforce_ready" in clean.columns:
        clean = clean.filter(F.col("salesforce_ready"))
    full = with_missing_as_null(clean, list(CRM_NAMES))
    values = {c: F.col(c) for c in CRM_NAMES}
    values["score_reasons"] = reasons_text("score_reasons", full.schema["score_reasons"].dataType)
    return full.select(*[values[c].alias(name) for c, name in CRM_NAMES.items()])
