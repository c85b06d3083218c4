"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_column


# The characters that count as whitespace, in code point order.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_whitespace(text: Column | str) -> Column:
    """Remove tabs, newlines and wide blanks at both ends (``trim`` alone removes plain blanks only)."""
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def normalize_whitespace(text: Column | str) -> Column:
    """Strip both ends and collapse inner runs of whitespace to one blank."""
    return F.regexp_replace(strip_whitespace(text), f"[{WHITESPACE}]+", " ")


def strip_special(text: Column | str) -> Column:
    return F.regexp_replace(as_column(text), "[^a-zA-Z0-9 ]+", "")


def normalize_status(text: Column | str) -> Column:
    return F.initcap(F.lower(strip_whitespace(text)))


def normalize_phone(text: Column | str) -> Column:
    """``+1-XXX-XXXX`` from seven digits, ``+1-XXX-XXX-XXXX`` from ten, with or without the leading 1.

    Other numbers keep their stripped text; a text without digits gives NULL. Applying it twice changes nothing.
    """
    column = as_column(text)
    digits = F.regexp_replace(F.regexp_replace(column, "[^0-9]", ""), "^1(?=([0-9]{7}|[0-9]{10})$)", "")
    part = lambda start, length: F.substring(digits, start, length)
    short = F.concat(F.lit("+1-"), part(1, 3), F.lit("-"), part(4, 4))
    long = F.concat(F.lit("+1-"), part(1, 3), F.lit("-"), part(4, 3), F.lit("-"), part(7, 4))
    kept = F.when(F.length(digits) > 0, strip_whitespace(column))
    return F.when(F.length(digits) == 7, short).when(F.length(digits) == 10, long).otherwise(kept)


def standard_id(value: Column | str, prefix: str = "CUST-", width: int = 3) -> Column:
    """``prefix`` plus the zero-padded id; longer ids keep all their digits."""
    text = as_column(value).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0")))


def route_label(pickup: Column | str, dropoff: Column | str) -> Column:
    return F.concat_ws(" → ", as_column(pickup), as_column(dropoff))


def label_text(pattern: str, value: Column | str) -> Column:
    """``label_text("Vendor %s", c)``; a missing value stays NULL instead of printing "null"."""
    column = as_column(value)
    return F.when(column.isNotNull(), F.format_string(pattern, column.cast("string")))
