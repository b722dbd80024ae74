"""The JSON documents held as text in the user table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fields and types of the two JSON documents.
LOGIN_FIELDS = {
    "avg_session_duration": "double",
    "devices": "array<string>",
    "first_login": "string",
    "locations": "array<string>",
    "login_count": "bigint",
    "timestamps": "array<timestamp>",
}
PURCHASE_FIELDS = {
    "avg_price": "double",
    "categories": "string",
    "items": "array<struct<id:bigint>>",
    "payment_method": "string",
    "payment_status": "string",
    "purchase_date": "string",
}

_JSON_BLANKS = " \t\n\r"


def _document(text: Column, fields: dict[str, str], wanted: tuple[str, ...]) -> Column:
    return F.from_json(text, ", ".join(f"{name} {fields[name]}" for name in wanted or fields))


def login_document(text: Column, *wanted: str) -> Column:
    """The login document as a struct of all its fields, or of the ones named."""
    return _document(text, LOGIN_FIELDS, wanted)


def purchase_document(text: Column, *wanted: str) -> Column:
    """The purchase document as a struct of all its fields, or of the ones named."""
    return _document(text, PURCHASE_FIELDS, wanted)


def has_document(text: Column) -> Column:
    """True where parsing ``text`` gives a struct at all.

    ``from_json`` is NULL only for NULL or blank text; malformed text gives a struct
    of NULLs. Testing the text keeps the parser out of the filter, where it would run
    a second time for every row, and lets ``IsNotNull`` reach the parquet scan. Nearly
    every document opens with a brace, so the costlier trim rarely runs.
    """
    blank = F.length(F.btrim(text, F.lit(_JSON_BLANKS))) == 0
    return text.isNotNull() & (F.startswith(text, F.lit("{")) | ~blank)
