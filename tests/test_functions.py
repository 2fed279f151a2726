import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from visitlake.functions import bands, dates, numbers, text


def value(spark, column, **cells):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in cells.items()))
    return row.select(column.alias("v")).first().v


@pytest.mark.parametrize("num,den,want", [
    (1, 3, "0.33"), (2, 3, "0.67"), (1, 200, "0.01"), (-1, 200, "-0.01"), (-1, 3, "-0.33"), (0, 5, "0.00"),
    (4690, 2000, "2.35"), (-4690, 2000, "-2.35"), (1, 0, None), (None, 2, None), (7, None, None),
])
def test_ratio_rounds_half_away_from_zero(spark, num, den, want):
    got = value(spark, numbers.ratio(F.col("n").cast("bigint"), F.col("d").cast("bigint")), n=num, d=den)
    assert got == (None if want is None else Decimal(want))


def test_ratio_is_exact_for_money(spark):
    got = value(spark, numbers.mean(F.col("t"), F.col("n"), "decimal(18,2)"), t=Decimal("0.45"), n=10)
    assert got == Decimal("0.05")
    big = value(spark, numbers.ratio(F.col("t"), F.col("n"), 6, "decimal(28,6)"), t=Decimal("9" * 20), n=3)
    assert big == Decimal("33333333333333333333.000000")


def test_shares_and_growth_on_zero(spark):
    assert value(spark, numbers.growth_ratio(F.lit(5), F.lit(0))) is None
    assert value(spark, numbers.growth_percent(F.lit(9), F.lit(12))) == Decimal("-25.00")


@pytest.mark.parametrize("birth,day,want", [
    ("2000-05-10", "2020-05-10", 20), ("2000-05-10", "2020-05-09", 19), ("2000-02-29", "2021-02-28", 21),
    ("2000-02-29", "2021-02-27", 20), ("2000-02-29", "2024-02-28", 23), ("2010-01-01", "2005-01-01", -5),
])
def test_age(spark, birth, day, want):
    column = dates.age_at(F.col("b").cast("date"), F.col("d").cast("date"))
    assert value(spark, column, b=birth, d=day) == want


@pytest.mark.parametrize("day,want", [
    ("2024-01-05", "Weekday"), ("2024-01-06", "Weekend"), ("2024-01-07", "Weekend"), ("2024-01-08", "Weekday"),
    ("1899-12-31", "Weekend"),
])
def test_day_type(spark, day, want):
    assert value(spark, dates.day_type(F.col("d").cast("date")), d=day) == want


@pytest.mark.parametrize("age,want", [
    (-3, "0-17"), (17, "0-17"), (18, "18-35"), (35, "18-35"), (36, "36-55"), (55, "36-55"), (56, "56+"),
])
def test_age_band(spark, age, want):
    assert value(spark, bands.age_band(F.col("a")), a=age) == want


def test_wait_colours(spark):
    shades = [value(spark, bands.wait_colour(F.col("w").cast("decimal(10,2)")), w=w) for w in ("25", "25.01", "70", "70.5")]
    assert shades == ["#2E7D74", "#7CAE9E", "#C77B2B", "#AE3B49"]
    assert value(spark, bands.wait_colour(F.lit(None).cast("int"))) == "#DEE6E3"


@pytest.mark.parametrize("name,want", [(" mary ann", "Mary ann"), ("o'NEIL ", "O'neil"), ("x", "X"), ("  ", "")])
def test_capitalised(spark, name, want):
    assert value(spark, text.capitalised(F.col("n")), n=name) == want


def test_full_name_needs_both_parts(spark):
    assert value(spark, text.full_name(F.col("a"), F.lit(None)), a="x") is None
    assert value(spark, text.full_name(F.col("a"), F.col("b")), a="x", b="y") == "x y"


def test_trim_takes_blanks_only(spark):
    assert value(spark, text.not_blank(F.col("a")), a="\t") is True
    assert value(spark, text.not_blank(F.col("a")), a="   ") is False


@pytest.mark.parametrize("cell,want", [
    (" NULL ", ""), ("na", ""), ("", ""), (None, ""), ("3.0", "3"), ("3.14159", "3.1416"), (" abc ", "abc"), ("-2.5", "-2.5000"),
    ("5D", "5D"), ("1E3", "1000"), ("12345678901234567890.25", "12345678901234567890.2500"), ("2024-01-01", "2024-01-01"),
])
def test_comparable(spark, cell, want):
    assert value(spark, text.comparable(F.col("c").cast("string")), c=cell) == want


@pytest.mark.parametrize("amount,want", [
    ("1584479195", "₹158.45 Cr"), ("10000000", "₹1.00 Cr"), ("9999999.99", "₹100.00 L"), ("100000", "₹1.00 L"),
    ("99999.50", "₹100,000"), ("12.34", "₹12"), ("123456789012", "₹12,345.68 Cr"), (None, "--"),
])
def test_money_label(spark, amount, want):
    assert value(spark, text.money_label(F.col("a").cast("decimal(28,2)")), a=amount) == want


@pytest.mark.parametrize("count,want", [(5000, "5k"), (12500, "12.5k"), (7530, "7.5k")])
def test_thousands_label(spark, count, want):
    assert value(spark, text.thousands_label(F.col("c")), c=count) == want


def test_location_parts(spark):
    parts = [value(spark, text.part_from_right(F.col("l"), k), l="A, B ,C") for k in (3, 2, 1, 4)]
    assert parts == ["A", "B", "C", None]


def test_month_start(spark):
    assert value(spark, dates.month_start(F.col("d").cast("date")), d="2024-02-29") == dt.date(2024, 2, 1)
