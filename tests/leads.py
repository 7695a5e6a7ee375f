"""Small frames to test with."""

from leadmill.fixed_values import LEAD_FIELDS
from leadmill.schema import NORMALIZED_LEAD

RAW_SCHEMA = ("n long, Name string, Email string, Title string, Company string, Phone string, "
              "Source string, Country string, `Created At` string")
RAW_DEFAULTS = {
    "Name": "Jo Doe", "Email": "jo@site.io", "Title": "Analyst", "Company": "Site",
    "Phone": "555 0100", "Source": "Web", "Country": "USA", "Created At": "2025-02-03",
}


def raw_frame(spark, *changes):
    """One raw lead per dict of changes against the defaults, numbered from 1 in column ``n``."""
    rows = [(n, *{**RAW_DEFAULTS, **change}.values()) for n, change in enumerate(changes, 1)]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def normalized_frame(spark, *rows):
    """Normalised leads from dicts; fields left out are null."""
    full = [(row.get("source_row_number", n), *[row.get(c) for c in LEAD_FIELDS])
            for n, row in enumerate(rows, 1)]
    return spark.createDataFrame(full, NORMALIZED_LEAD)


def values(spark, function, *texts):
    """What a column function gives for each text."""
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    return [r.v for r in rows.select("n", function("t").alias("v")).orderBy("n").collect()]
