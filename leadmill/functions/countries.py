"""Keys to look country names up by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill.functions.text import casefold, col


def country_key(c: Column | str) -> Column:
    """Case-folded, "&" spelled out, dots and apostrophes gone, other signs read as blanks."""
    spelled = F.replace(casefold(col(c)), F.lit("&"), F.lit(" and "))
    closed = F.regexp_replace(spelled, "[.'’]+", "")
    return F.trim(F.regexp_replace(closed, r"[^\p{L}\p{N}]+", " "))
