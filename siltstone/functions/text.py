"""Tokens and comma lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters removed from a token.
PUNCTUATION = "()[],.!?:;"


def tokens(text: Column) -> Column:
    """Lower-cased parts of ``text`` between single spaces; newlines stay inside a token."""
    return F.split(F.lower(text), " ")


def strip_punctuation(token: Column) -> Column:
    """``token`` without punctuation; empty if nothing else is in it."""
    return F.translate(token, PUNCTUATION, "")


def comma_list(text: Column) -> Column:
    """Parts of a comma list without surrounding white space."""
    return F.transform(F.split(text, ","), lambda part: F.btrim(part, F.lit(" \t\n\r\f\x0b")))


def present(value: Column) -> Column:
    """True for a value that is neither null nor empty."""
    return value.isNotNull() & (value != "")


def in_year(date: Column, data_type: str, year: int) -> Column:
    """Year test for text dates (``YYYY-...``) and for dates or time stamps."""
    if data_type == "string":
        return F.split(date, "-")[0] == str(year)
    return F.year(date) == year
