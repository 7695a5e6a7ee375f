"""Normalise every field of a lead."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.functions.contact import normalize_email, phone_digits
from leadmill.functions.countries import country_key
from leadmill.functions.dates import iso_date, year_month_day
from leadmill.functions.names import first_word, last_word, title_case
from leadmill.functions.text import normalize_text
from leadmill.schema import NORMALIZED_COLUMNS
from leadmill.sources.countries import country_dimension

_TEXT_FIELDS = ["full_name", "raw_email", "title", "company", "phone", "source", "country", "lead_date"]


def conform_country(df: DataFrame, dimension: DataFrame, column: str = "country") -> DataFrame:
    """Put the canonical name where the country is known; other cleaned values stay."""
    return (
        df.withColumn("country_key", country_key(column))
        .join(dimension, "country_key", "left")
        .withColumn(column, F.coalesce("canonical_country", column))
        .drop("country_key", "canonical_country")
    )


def normalize_leads(prepared: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """All field normalisers in one narrow pass plus one broadcast join on the country key.

    The text of each field is cleaned in a first projection and read from there, so that the
    white-space regex runs once per cell however often the cleaned value is used.
    """
    kept = [c for c in prepared.columns if c not in NORMALIZED_COLUMNS]
    cleaned = prepared.withColumns(
        {**{c: normalize_text(c) for c in _TEXT_FIELDS}, "email": normalize_email("email")}
    )
    derived = cleaned.withColumns({
        "_titled": title_case("full_name"),
        "phone": phone_digits("phone"),
        "_ordered": year_month_day("lead_date"),
    }).withColumns({
        "lead_date": iso_date("_ordered"),
        "first_name": first_word("_titled"),
        "last_name": last_word("_titled"),
    }).drop("_titled", "_ordered")
    dimension = country_dimension(prepared.sparkSession) if countries is None else countries
    return conform_country(derived, dimension).select(*NORMALIZED_COLUMNS, *kept)
