"""Dates written in many ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill.functions.text import col, normalize_text

_CLOCK = r"(?:2[0-3]|[01]?\d):[0-5]?\d(?::[0-5]?\d(?:\.\d+)?)?(?: ?(?i:[ap]m))?"
_ZONE = r"(?: ?(?:Z|[+-]\d{2}:?\d{2}))?"

_TIME = rf"(?:(?:T|,? ){_CLOCK}{_ZONE})?"
_WEEKDAY = r"(?:(?i:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?i:day)?\.?,? )?"

# The forms a date may have: Y, M and D stand for the groups that hold year, month and day.
# They are tried in order, so the more special form comes first.
_FORMS = [
    # Year first, with a time or not: the date as written counts, whatever the zone.
    *[rf"Y((?!0000)\d{{4}}){sign}M(\d{{1,2}}|\p{{L}}+){sign}D(\d{{1,2}}){_TIME}"
      for sign in "-/"],
    # Slashes: month first, unless the first number cannot be a month.
    rf"D(1[3-9]|[2-9]\d)/M(\d{{1,2}})/Y((?!0000)\d{{4}}|\d\d){_TIME}",
    rf"M(\d{{1,2}})/D(\d{{1,2}})/Y((?!0000)\d{{4}}|\d\d){_TIME}",
    # Dashes: day first, unless the second number cannot be a month.
    rf"M(\d{{1,2}})-D(1[3-9]|[2-9]\d)-Y((?!0000)\d{{4}}){_TIME}",
    rf"D(\d{{1,2}})-M(\d{{1,2}})-Y((?!0000)\d{{4}}){_TIME}",
    rf"D(\d{{1,2}})-M(\p{{L}}+)-Y((?!0000)\d{{4}}|\d\d){_TIME}",
    # Month names in running text.
    rf"{_WEEKDAY}M(\p{{L}}+)\.? D(\d{{1,2}}),? Y((?!0000)\d{{4}}){_TIME}",
    rf"{_WEEKDAY}D(\d{{1,2}}) M(\p{{L}}+)\.? Y((?!0000)\d{{4}}){_TIME}",
    r"Y((?!0000)\d{4})M(\d{2})D(\d{2})",
]


def _one_regex() -> tuple[str, str]:
    """All forms as one regex, and the replacement that brings a match to year-month-day.

    A group of a form that did not match adds nothing to the replacement, so the groups of one
    part are simply listed one after another. Text of no form becomes "--", which is no date.
    """
    groups: dict[str, list[str]] = {"Y": [], "M": [], "D": []}
    count = 0
    forms = []
    for form in _FORMS:
        for part in sorted(groups, key=lambda p: form.index(f"{p}(")):
            count += 1
            groups[part].append(f"${count}")
        for part in groups:
            form = form.replace(f"{part}(", "(")
        forms.append(form)
    return rf"(?s)\A(?:{'|'.join(forms)}|.*)\z", "-".join("".join(groups[p]) for p in "YMD")


_DATE, _YEAR_MONTH_DAY = _one_regex()


def year_month_day(text: Column | str) -> Column:
    """Year, month (a number or a name) and day of clean text, joined by dashes."""
    return F.regexp_replace(col(text), _DATE, _YEAR_MONTH_DAY)


def iso_date(ordered: Column | str) -> Column:
    """ISO text of what :func:`year_month_day` found, null when it is no calendar date.

    A plain cast reads numbers much faster than a date pattern, which only month names need.
    """
    ordered = col(ordered)
    # Years of two digits are those from 1969 to 2068.
    short = F.substring(ordered, 3, 1) == "-"
    century = F.when(F.substring(ordered, 1, 2) <= "68", "20").otherwise("19")
    ordered = F.when(short & (F.substring(ordered, 1, 1) != "-"), F.concat(century, ordered)).otherwise(ordered)
    named = F.try_to_date(F.regexp_replace(ordered, "-(?i:sept)-", "-Sep-"), "yyyy-[MMMM][MMM]-d")
    return F.when(ordered.rlike(r"\p{L}"), named).otherwise(ordered.try_cast("date")).cast("string")


def normalize_date(c: Column | str) -> Column:
    """ISO date text, or null when the value is no calendar date in a supported form.

    Slashes are read month first unless the first number is above 12; dashes day first.
    """
    return iso_date(year_month_day(normalize_text(c)))
