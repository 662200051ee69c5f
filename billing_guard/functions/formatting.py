"""Report cell formatting with built-in string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_1dp(rate: Column) -> Column:
    """0.1234 -> ``12.3%``."""
    return F.format_string("%.1f%%", rate * F.lit(100.0))


def amount_2dp(value: Column) -> Column:
    """1234.5 -> ``1,234.50`` (thousands separator, two decimals)."""
    return F.format_number(value, 2)


def fixed_4dp(value: Column) -> Column:
    """0.12345 -> ``0.1235``."""
    return F.format_string("%.4f", value)


def markdown_cell(value: Column) -> Column:
    """Text of a table cell: empty for NULL, bars escaped, line breaks as blanks."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.regexp_replace(F.regexp_replace(text, r"\|", r"\\|"), r"[\r\n]+", " ")


def markdown_row(*cells: Column) -> Column:
    """``| a | b | c |`` from string-convertible cells."""
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[c.cast("string") for c in cells]),
                    F.lit(" |"))
