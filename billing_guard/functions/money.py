"""Exact money arithmetic on DECIMAL columns.

Amounts are summed as DECIMAL(19,2) and every rounding is done exactly on
integers (cents), half away from zero, so the result does not depend on
floating point or on the engine's decimal-division scale rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billing_guard.sources.schemas import MONEY

_WIDE = "decimal(38,0)"


def cents(amount: Column) -> Column:
    """An amount with two decimals as an integral DECIMAL count of cents."""
    return (amount * F.lit(100)).cast(_WIDE)


def from_cents(value: Column) -> Column:
    return (value.cast(_WIDE) / F.lit(100)).cast(MONEY)


def _floor_div(a: Column, b: Column) -> Column:
    """floor(a / b) for a >= 0, b > 0 on integral decimals, computed exactly."""
    return ((a - a % b) / b).cast(_WIDE)


def rounded_quotient(num: Column, den: Column) -> Column:
    """round(num / den) to an integer, half away from zero; NULL when den is 0."""
    n, d = F.abs(num), F.abs(den)
    q = _floor_div(n * F.lit(2) + d, d * F.lit(2))
    negative = (num < 0) != (den < 0)
    return F.when(den == 0, F.lit(None).cast(_WIDE)) \
        .when(negative & (num != 0), -q).otherwise(q)


def round_money_ratio(total: Column, count: Column) -> Column:
    """``round(total / count, 2)`` for an amount total and a row count, exact."""
    return from_cents(rounded_quotient(cents(total), count.cast(_WIDE)))


def proportional_share(payment: Column, part: Column, whole: Column) -> Column:
    """``round(payment * part / whole, 2)``: the part's share of a payment, exact."""
    return from_cents(rounded_quotient(cents(payment) * cents(part), cents(whole)))


def round_to_cents(value: Column) -> Column:
    """Round an exact decimal to 2 places (half away from zero for positives and
    negatives alike: Spark's decimal ROUND is HALF_UP)."""
    return F.round(value, 2).cast(MONEY)
