"""Text cleaning and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlake.functions.numbers import grouped_digits, ratio


def full_name(first: Column, last: Column) -> Column:
    """NULL as soon as one part is NULL, unlike ``concat_ws``."""
    return F.concat(first, F.lit(" "), last)


def capitalised(name: Column) -> Column:
    """First letter up, everything else down; not per word."""
    trimmed = F.trim(name)
    return F.concat(
        F.upper(F.substring(trimmed, 1, 1)),
        F.lower(F.substring(trimmed, F.lit(2), F.length(trimmed))),
    )


def not_blank(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit("")).isNotNull()


def normalised_gender(value: Column) -> Column:
    code = F.upper(F.trim(value))
    return F.when(code.isin("M", "MALE"), "Male").when(code.isin("F", "FEMALE"), "Female")


def location_parts(value: Column) -> Column:
    return F.split(value, ",")


def part_from_right(value: Column, k: int) -> Column:
    return F.trim(F.try_element_at(location_parts(value), F.lit(-k)))


def padded_key(prefix: str, number: Column, width: int) -> Column:
    """Zero-padded key that widens instead of truncating once it outgrows ``width``."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0"))


def comparable(value: Column) -> Column:
    """A cell as text for comparison: blanks and NULL markers empty, numbers rounded to
    four decimals, and to none when those are zero. Exact, so large totals keep their cents."""
    text = F.trim(value.cast("string"))
    number = text.try_cast("decimal(38,4)")
    return (
        F.when(text.isNull() | F.upper(text).isin("NULL", "NA", ""), "")
        .when(number.isNull(), text)
        .when(number % 1 != 0, number.cast("string"))
        .otherwise(number.cast("decimal(38,0)").cast("string"))
    )


def money_label(amount: Column) -> Column:
    """Indian units: crore from ten million, lakh from a hundred thousand."""
    crore, lakh = 10_000_000, 100_000
    scaled = lambda unit: grouped_digits(ratio(amount, F.lit(unit), 2, "decimal(28,2)"), 2)
    return (
        F.when(amount.isNull(), "--")
        .when(amount >= crore, F.concat(F.lit("₹"), scaled(crore), F.lit(" Cr")))
        .when(amount >= lakh, F.concat(F.lit("₹"), scaled(lakh), F.lit(" L")))
        .otherwise(F.concat(F.lit("₹"), grouped_digits(ratio(amount, F.lit(1), 0, "decimal(28,0)"))))
    )


def thousands_label(count: Column) -> Column:
    """``12000`` as ``12k``, ``12500`` as ``12.5k``."""
    tenths = ratio(count, F.lit(1000), 1, "decimal(20,1)")
    return F.when(
        count % 1000 == 0, F.concat((count / 1000).cast("bigint").cast("string"), F.lit("k"))
    ).otherwise(F.concat(tenths.cast("string"), F.lit("k")))
