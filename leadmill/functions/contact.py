"""E-mail addresses and phone numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill.functions.text import SPACE, WORD, casefold, col, normalize_text, strip

_MAIL_CHAR = rf"[^@{SPACE}]"
# One "@", a dot somewhere after it, padding allowed around the address but nowhere inside.
_MAIL = rf"\A[{SPACE}]*{_MAIL_CHAR}+@{_MAIL_CHAR}+\.{_MAIL_CHAR}+[{SPACE}]*\z"

# A spelled extension and everything after it; "5550101x9" has no word boundary before the x.
_EXTENSION = rf"(?is)(?<![{WORD}])(?:ext\.?|x)[{SPACE}]*\p{{Nd}}+(?![{WORD}]).*"


def normalize_email(c: Column | str) -> Column:
    """Lower-cased address, or null when it is not one.

    One regex over the raw value decides, so a filter on "e-mail is not null" costs one match
    per row when Catalyst pushes it below the projection.
    """
    c = col(c)
    return F.when(c.rlike(_MAIL), F.lower(strip(c)))


def email_domain(c: Column | str) -> Column:
    """What follows the last "@", case-folded."""
    c = col(c)
    return F.when(c.contains("@"), casefold(F.substring_index(c, "@", -1)))


def phone_digits(text: Column | str) -> Column:
    """As :func:`normalize_phone`, for text that is normalised already."""
    text = col(text)
    # Only text with an x can hold an extension, which spares most rows the regex.
    has_x = text.contains("x") | text.contains("X")
    number = F.when(has_x, F.regexp_replace(text, _EXTENSION, "")).otherwise(text)
    digits = F.nullif(F.regexp_replace(number, r"\P{Nd}+", ""), F.lit(""))
    return F.concat(F.when(text.startswith("+"), "+").otherwise(""), digits)


def normalize_phone(c: Column | str) -> Column:
    """Digits only, with a leading "+" kept and an extension cut off; no digits means null."""
    return phone_digits(normalize_text(c))
