"""Text cleaning shared by every field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inside a regex class: what Unicode calls white space, plus the four ASCII separators. Java's \s
# is ASCII-only, and a class of a few named sets is matched far faster than one of many ranges.
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
# The same characters one by one.
SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# A word character is a letter, a number or an underscore in any script.
WORD = r"\p{L}\p{N}_"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Drop white space at both ends."""
    return F.btrim(col(c), F.lit(SPACE_CHARS))


def normalize_text(c: Column | str) -> Column:
    """Collapse white space to single blanks, strip; nothing left means null."""
    collapsed = F.trim(F.regexp_replace(col(c), f"[{SPACE}]+", " "))
    return F.nullif(collapsed, F.lit(""))


def casefold(c: Column | str) -> Column:
    """Lower case that also folds the two letters ``lower`` leaves apart."""
    return F.replace(F.replace(F.lower(col(c)), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def is_present(c: Column | str, kind: str = "string") -> Column:
    """True when there is a value: not null, not blank, not NaN, not an empty collection."""
    c = col(c)
    if kind == "string":
        found = c.rlike(f"[^{SPACE}]")
    elif kind in ("array", "map"):
        found = F.size(c) > 0
    elif kind in ("double", "float"):
        found = ~F.isnan(c)
    else:
        found = c.isNotNull()
    return F.coalesce(c.isNotNull() & found, F.lit(False))


def quoted(text: str) -> str:
    """A regular expression for just this text; an end mark inside it is quoted on its own."""
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"
