"""Calendar expressions on the raw date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def day_type(day: Column) -> Column:
    return F.when(is_weekend(day), "Weekend").otherwise("Weekday")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def age_at(birth: Column, day: Column) -> Column:
    """Whole years lived on ``day``. A 29 February birthday falls on the 28th in
    common years, which is what ``add_months`` does."""
    years = F.year(day) - F.year(birth)
    return years - F.when(F.add_months(birth, years * F.lit(12)) > day, 1).otherwise(0)


def in_period(day: Column, start, end) -> Column:
    """Half-open ``[start, end)``; a plain comparison, so it reaches the scan."""
    return (day >= F.lit(start)) & (day < F.lit(end))


# Calendar columns a fact row can answer from its own date, without a join.
CALENDAR = {
    "Year": lambda d: F.year(d),
    "MonthNumber": lambda d: F.month(d),
    "MonthName": lambda d: F.date_format(d, "MMM"),
    "MonthStart": month_start,
    "YearMonth": lambda d: F.date_format(d, "yyyy-MM"),
    "DayName": lambda d: F.date_format(d, "EEE"),
    "DayType": day_type,
}


def clock_text(hour: Column, minute: Column, second: Column) -> Column:
    two = lambda part: F.lpad(part.cast("string"), 2, "0")
    return F.concat(two(hour), F.lit(":"), two(minute), F.lit(":"), two(second))
