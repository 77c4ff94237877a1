"""Exact money arithmetic.

Amounts are integer cents at rest and ``decimal(18,2)`` dollars in the marts. Sums widen to
``decimal(28,2)``, so they stay exact past the range where a double loses cents. Ratios are
rounded half-up with integer arithmetic: a decimal division would round twice.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def dollars(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def _hundredths(value: Column) -> Column:
    return (value.cast("decimal(28,2)") * F.lit(100)).cast("decimal(30,0)")


def half_up_ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """``num / den`` rounded half away from zero; NULL when the denominator is zero.

    Both sides may be counts or amounts with at most two decimals.
    """
    n, d = _hundredths(num), F.nullif(_hundredths(den), F.lit(0))
    doubled = F.abs(n) * F.lit(2 * 10**digits) + F.abs(d)
    quotient = F.call_function("div", doubled, F.abs(d) * F.lit(2)).cast("decimal(20,0)")
    unit = F.lit(Decimal(1).scaleb(-digits))
    negative = (n < 0) != (d < 0)
    return F.when(negative, -quotient).otherwise(quotient) * unit


def average(amount: Column) -> Column:
    """Mean amount kept at cents, the result type of averaging a two-decimal column."""
    return half_up_ratio(F.sum(amount), F.count(amount))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return half_up_ratio(part * F.lit(100), whole, digits)
