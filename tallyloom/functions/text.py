"""Cleaning of free text: ids, names, e-mail addresses, subjects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import STATUS_INACTIVE

_BLANKS = " \t\n\r\f\x0b"


def strip(text: Column) -> Column:
    """Remove blanks of every kind from both ends (``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(_BLANKS))


def strip_dp_prefix(dp_id: Column) -> Column:
    """``DP-4033623`` -> ``4033623``: what follows the last dash."""
    return strip(F.substring_index(dp_id.cast("string"), "-", -1))


def normalize_id(dp_id: Column) -> Column:
    """Drop a trailing ``.0`` left by spreadsheets, then trim. Only ids with ``.0`` meet the pattern."""
    text = dp_id.cast("string")
    return strip(F.when(text.contains(".0"), F.regexp_replace(text, r"\.0$", "")).otherwise(text))


def clean_name(name: Column) -> Column:
    """Upper-case letters and single blanks only; a missing name becomes ''."""
    letters = F.regexp_replace(F.upper(F.coalesce(name, F.lit(""))), "[^A-Z]+", " ")
    return F.trim(letters)


def email_local_part(email: Column) -> Column:
    """The part before ``@``, cleaned like a name."""
    return clean_name(F.substring_index(email, "@", 1))


def fill_status(status: Column) -> Column:
    """A partner without a status has not sold yet: null, '' and 'nan' are Inactive."""
    missing = status.isNull() | F.lower(status).isin("nan", "")
    return F.when(missing, F.lit(STATUS_INACTIVE)).otherwise(status)


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def tokenize_subject(text: Column) -> Column:
    """Lower-case words of a subject line, apostrophes removed."""
    words = F.split(F.lower(F.replace(text, F.lit("'"), F.lit(""))), r"\s+")
    return F.filter(words, lambda w: w != "")


def quoted(text: Column) -> Column:
    return F.concat(F.lit("'"), text, F.lit("'"))
