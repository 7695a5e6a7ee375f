"""Person names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill.functions.text import col, normalize_text

_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_MARK = "\x01 "


def title_case(text: Column | str) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others.

    ``initcap`` restarts only after a blank. Where there are other signs than letters and
    blanks, a mark that ends in a blank is put around each of them first and taken out again.
    """
    text = col(text)
    marked = F.regexp_replace(text, f"(?<=[^{_CASED}])|(?=[^{_CASED}])", _MARK)
    restarted = F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))
    return F.when(text.rlike(f"[^{_CASED} ]"), restarted).otherwise(F.initcap(text))


def first_word(text: Column | str) -> Column:
    return F.substring_index(col(text), " ", 1)


def last_word(text: Column | str) -> Column:
    """Last of several words; null when there is one only."""
    text = col(text)
    return F.when(text.contains(" "), F.substring_index(text, " ", -1))


def first_name(full_name: Column | str) -> Column:
    """First word of a name in title case."""
    return first_word(title_case(normalize_text(full_name)))


def last_name(full_name: Column | str) -> Column:
    """Last word of a name in title case; null when the name has one word only."""
    return last_word(title_case(normalize_text(full_name)))
