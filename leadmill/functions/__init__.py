"""Column helpers: each takes a ``Column`` (or a column name) and returns a ``Column``."""

from leadmill.functions.contact import email_domain, normalize_email, normalize_phone
from leadmill.functions.countries import country_key
from leadmill.functions.dates import normalize_date
from leadmill.functions.names import first_name, last_name, title_case
from leadmill.functions.text import casefold, is_present, normalize_text, strip

__all__ = [
    "casefold",
    "country_key",
    "email_domain",
    "first_name",
    "is_present",
    "last_name",
    "normalize_date",
    "normalize_email",
    "normalize_phone",
    "normalize_text",
    "strip",
    "title_case",
]
