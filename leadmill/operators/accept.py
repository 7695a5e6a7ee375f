"""Split normalised leads into accepted and rejected ones."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.fixed_values import BAD_EMAIL


class Rule(NamedTuple):
    """``reason`` is given to rows where the field is empty."""

    reason: str
    field: str


EMAIL_RULE = Rule(BAD_EMAIL, "email")
MALFORMED_RULE = Rule("malformed_csv_row", "_well_formed")


def drop_reason(rules: Sequence[Rule]) -> Column:
    """Reason of the first rule that a normalised row (empty means null) breaks, else null."""
    return F.coalesce(*[F.when(F.col(r.field).isNull(), F.lit(r.reason)) for r in rules])


def accept_leads(normalized: DataFrame, rules: Sequence[Rule] = (EMAIL_RULE,)) -> DataFrame:
    for rule in rules:
        normalized = normalized.filter(F.col(rule.field).isNotNull())
    return normalized


def reject_leads(normalized: DataFrame, rules: Sequence[Rule] = (EMAIL_RULE,)) -> DataFrame:
    """Rows that break a rule, unchanged, with the reason appended."""
    broken = F.lit(False)
    for rule in rules:
        broken = broken | F.col(rule.field).isNull()
    return normalized.filter(broken).withColumn("drop_reason", drop_reason(rules))
