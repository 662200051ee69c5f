"""Overdue bands ("fase") of the settlement report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: overdue band labels (from day, to day, label) ------------
FASE_BANDS = [
    (1, 30, "A - 1 A 30 | 6%"),
    (31, 60, "B - 31 A 60 | 11%"),
    (61, 90, "C - 61 A 90 | 13%"),
    (91, 120, "D - 91 A 120 | 15%"),
    (121, 180, "E - 121 A 180 | 18%"),
    (181, 240, "F - 181 A 240 | 20%"),
    (241, 270, "G - 241 A 270 | 21%"),
    (271, 300, "H - 271 A 300 | 22%"),
    (301, 330, "I - 301 A 330 | 24%"),
    (331, 360, "J - 331 A 360 | 28%"),
    (361, 540, "K - 361 A 540 | 30%"),
    (541, 720, "L - 541 A 720 | 35%"),
    (721, 1440, "M - 721 A 1440 | 40%"),
    (1441, 1800, "N - 1441 A 1800 | 40%"),
    (1801, 99999, "O - 1801 A 99999 | 40%"),
]
#: label when the days are NULL, not positive, or beyond the last band
NO_BAND = ""
# ---------------------------------------------------------------------------


def fase_label(days: Column) -> Column:
    """Band label for a days-overdue value (first matching band wins)."""
    expr = None
    for lo, hi, label in FASE_BANDS:
        cond = days.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(NO_BAND))
