"""Date parsing and due-date repair (Column -> Column)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: date text formats ---------------------------------------
#: day.month.year with one- or two-digit day and month, four-digit year
DAY_MONTH_YEAR = "d.M.yyyy"
#: the description monitor's parse of its swapped due date
MONTH_DAY_YEAR = "MM.dd.yyyy"
# ---------------------------------------------------------------------------


def parse_day_month_year(text: Column) -> Column:
    """``dd.mm.yyyy`` text to DATE; NULL for empty or invalid text (no exception)."""
    return F.try_to_date(text, DAY_MONTH_YEAR)


def month_segment(text: Column) -> Column:
    """Characters 4-5 (1-based): the month of ``dd.mm.yyyy``."""
    return F.substring(text, 4, 2)


def swap_day_month(text: Column) -> Column:
    """``dd.mm.yyyy`` -> ``mm.dd.yyyy`` by position (NULL stays NULL)."""
    return F.concat(
        F.substring(text, 4, 2), F.lit("."), F.substring(text, 1, 2), F.lit("."),
        F.substring(text, 7, 4),
    )


def swapped_due_date(due_text: Column) -> Column:
    """Description-monitor due date: swap by position, then read as month.day.year.

    The two steps cancel, so ``15.01.2024`` reads as 2024-01-15.
    """
    return F.try_to_date(swap_day_month(due_text), MONTH_DAY_YEAR)


def repaired_due_date(due_text: Column, competence_text: Column) -> Column:
    """Settlement due date.

    When the month segments of due date and competence differ, the due date's
    day and month are swapped before parsing; if that parse fails, the
    competence date with day and month swapped is used.
    """
    differs = month_segment(due_text) != month_segment(competence_text)
    candidate = F.when(differs, swap_day_month(due_text)).otherwise(due_text)
    return F.coalesce(
        parse_day_month_year(candidate),
        parse_day_month_year(swap_day_month(competence_text)),
    )


def days_until(day: Column, as_of: date) -> Column:
    """Whole days from ``day`` to ``as_of`` (positive when ``day`` is earlier)."""
    return F.datediff(F.lit(as_of), day)


def month_bounds(as_of: date) -> tuple[date, date]:
    """First day of ``as_of``'s month and of the following month (half-open range)."""
    start = as_of.replace(day=1)
    nxt = date(start.year + (start.month == 12), start.month % 12 + 1, 1)
    return start, nxt


def in_month_of(day: Column, as_of: date) -> Column:
    """Same calendar month and year as ``as_of``, as a range a Parquet scan can prune."""
    start, nxt = month_bounds(as_of)
    return (day >= F.lit(start)) & (day < F.lit(nxt))
