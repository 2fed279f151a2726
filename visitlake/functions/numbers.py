"""Exact arithmetic on aggregated values.

Averages, percentages and shares are one division followed by one rounding. Doing
that in integers keeps the result independent of row order, partition count and
the scale Spark would pick for a decimal quotient.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _hundredths(value) -> Column:
    """Counts and money (two decimals) both become whole numbers here."""
    return (_column(value) * F.lit(100)).cast(_WIDE)


def ratio(numerator, denominator, places: int = 2, type_: str = "decimal(10,2)") -> Column:
    """``numerator / denominator`` rounded half away from zero to ``places`` digits.

    NULL when the denominator is zero or NULL, so it is safe under ANSI mode.
    Meant for aggregated rows; inputs carry at most two decimals.
    """
    n = _hundredths(numerator)
    d = _hundredths(denominator)
    d = F.when(d != 0, d)
    doubled = F.abs(n) * F.lit(2 * 10**places) + F.abs(d)
    step = F.abs(d) * F.lit(2)
    whole = ((doubled - doubled % step) / step).cast(_WIDE)
    negative = (n < 0) != (d < 0)
    signed = F.when(negative, -whole).otherwise(whole)
    return (signed.cast("decimal(28,0)") * F.lit(Decimal(1).scaleb(-places))).cast(type_)


def percent(part, whole, type_: str = "decimal(28,2)") -> Column:
    """``100 * part / whole`` with two decimals. As wide as money: growth from a sparse period has no bound."""
    return ratio(_column(part) * F.lit(100), whole, 2, type_)


def growth_percent(current, previous) -> Column:
    return percent(_column(current) - _column(previous), previous)


def growth_ratio(current, previous) -> Column:
    """The measure form of growth: a share such as 0.200000, not a percentage."""
    return share(_column(current) - _column(previous), previous)


def share(part, whole) -> Column:
    return ratio(part, whole, 6, "decimal(18,6)")


def mean(total, count, type_: str = "decimal(10,2)") -> Column:
    return ratio(total, count, 2, type_)


def money(total) -> Column:
    """A total, ten digits wider than the ``decimal(18,2)`` of a single amount."""
    return _column(total).cast("decimal(28,2)")


def exact_ratio(total, count) -> Column:
    """A quotient fine enough to order by: 18 decimals, so groups of up to a
    billion rows with different averages never compare equal."""
    return total.cast("decimal(20,0)") / count.cast("decimal(20,0)")


def grouped_digits(value, places: int = 0) -> Column:
    """``1234567`` as ``1,234,567``. Round first: formatting rounds half to even."""
    return F.format_number(value, places)
