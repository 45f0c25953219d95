"""Column helpers for the text conventions of the event data."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from daybook.schema import NULL_TEXT

# fixed value: Java's notion of whitespace (Character.isWhitespace)
_BLANK = r"^\p{javaWhitespace}*$"


def empty_to_null(c: Column) -> Column:
    """``''`` reads as NULL; whitespace-only text is kept."""
    return F.nullif(c, F.lit(""))


def is_blank(c: Column) -> Column:
    """NULL, empty or whitespace only (the 'blank' test of the event filters)."""
    return F.coalesce(c.rlike(_BLANK), F.lit(True))


def not_blank(c: Column) -> Column:
    return ~is_blank(c)


def as_text(c: Column) -> Column:
    """Text form used in lines: Java-style doubles, ``true``/``false``."""
    return c.cast("string")


def null_marker(c: Column) -> Column:
    """Value text, or ``\\N`` when NULL or empty."""
    return F.coalesce(empty_to_null(as_text(c)), F.lit(NULL_TEXT))


def from_marker(c: Column) -> Column:
    """Inverse of :func:`null_marker` on one field."""
    return F.nullif(c, F.lit(NULL_TEXT))


def sanitize(c: Column, sep: str = ";") -> Column:
    """Replace the separator, CR and LF by spaces so a line keeps its fields."""
    return F.translate(c, sep + "\r\n", "   ")

