"""Latin-American number text to double / long, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesloom.functions.text import strip

DECIMAL_TEXT = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\z"
INTEGER_TEXT = "^[+-]?[0-9]+\\z"
INFINITY_TEXT = "^[+-]?(?i:inf|infinity)\\z"
GROUPED_TEXT = "^[+-]?[0-9]{1,3}((\\.[0-9]{3}){2,}|(,[0-9]{3}){2,})\\z"
LONG_LIMIT = float(2**63)
# Currency marks removed from number text, in this order.
CURRENCY_MARKS = ("$", "ARS", "ars")


def unmark(c: Column) -> Column:
    """Trimmed text without currency marks."""
    text = strip(c)
    for mark in CURRENCY_MARKS:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return strip(text)


def settle(text: Column, fix_thousands: bool = False) -> Column:
    """Unmarked text with a decimal point and no spaces.

    With both separators present the point groups thousands and the comma is
    decimal; commas alone are all taken as decimal; points alone stay.
    ``fix_thousands`` additionally reads "1.234.567" and "1,234,567" as grouped.
    """
    has_comma, has_point = F.contains(text, F.lit(",")), F.contains(text, F.lit("."))
    settled = (
        F.when(has_comma & has_point, F.translate(text, ",.", "."))
        .when(has_comma, F.translate(text, ",", "."))
        .otherwise(text)
    )
    if fix_thousands:
        settled = F.when(text.rlike(GROUPED_TEXT), F.translate(text, ",.", "")).otherwise(settled)
    return F.replace(settled, F.lit(" "), F.lit(""))


def clean_number_text(c: Column, fix_thousands: bool = False) -> Column:
    """Drop currency marks and settle the decimal separator."""
    return settle(unmark(c), fix_thousands)


def number_text(value: Column, kind: Column | None, cleaned: Column) -> Column:
    """Plain number text of a cell: number cells as they are, flags as 1 / 0."""
    if kind is None:
        return cleaned
    from_flag = F.when(F.lower(value) == "true", F.lit("1")).otherwise(F.lit("0"))
    return F.when(kind == "num", value).when(kind == "bool", from_flag).otherwise(cleaned)


def float_of(text: Column) -> Column:
    """Double of plain number text; text that is no number, or overflows, gives null."""
    value = text.try_cast("double")
    finite = F.abs(value) < F.lit(float("inf"))
    return F.when(text.rlike(DECIMAL_TEXT), F.when(finite, value)).when(
        text.rlike(INFINITY_TEXT), value
    )


def int_of(text: Column) -> Column:
    """Long of plain number text; fractional or out-of-range numbers give null."""
    number = float_of(text)
    whole = (number == F.floor(number)) & (F.abs(number) < F.lit(LONG_LIMIT))
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("long")).otherwise(
        F.when(whole, number.try_cast("long"))
    )


def parse_float(c: Column, kind: Column | None = None, fix_thousands: bool = False) -> Column:
    """Double or null; never NaN."""
    return float_of(number_text(c, kind, clean_number_text(c, fix_thousands)))


def parse_int(c: Column, kind: Column | None = None, fix_thousands: bool = False) -> Column:
    """Long or null.  A fractional or out-of-range number gives null here and is
    reported by :func:`int_error`."""
    return int_of(number_text(c, kind, clean_number_text(c, fix_thousands)))


def int_error(c: Column, kind: Column | None = None, fix_thousands: bool = False) -> Column:
    """True where the value is a number that no long can hold exactly."""
    text = number_text(c, kind, clean_number_text(c, fix_thousands))
    return F.coalesce(float_of(text).isNotNull() & int_of(text).isNull(), F.lit(False))
