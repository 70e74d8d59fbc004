"""Tests and clean-ups of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    """NULL instead of an empty string; a string of spaces stays."""
    return F.nullif(text, F.lit(""))


def is_blank(value: Column) -> Column:
    """True for NULL and for an empty string, whatever the column type."""
    return value.isNull() | (value.cast("string") == "")


def says_something(text: Column) -> Column:
    """True when the text holds more than spaces; False for NULL."""
    return F.coalesce(F.trim(text) != "", F.lit(False))
