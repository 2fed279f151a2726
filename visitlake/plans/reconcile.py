"""Comparison of two results, and the figures a published model must show."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.functions.numbers import growth_percent, grouped_digits, ratio
from visitlake.functions.text import comparable
from visitlake.operators.fingerprint import LEAVES, differing, leaf, tree
from visitlake.operators.relational import row_counts, union_periods
from visitlake.operators.windows import with_lag
from visitlake.plans.analysis import q10_top_doctors
from visitlake.plans.facetcells import FacetCells
from visitlake.plans.measures import evaluate
from visitlake.plans.summary import extremes
from visitlake.session import stored
from visitlake.sources.star import Star


def comparable_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and cells as the normalised text that is compared."""
    return df.select(*(F.trim(F.col(c).cast("string")).alias(c) if c in keys else comparable(F.col(c)).alias(c) for c in df.columns))


def differing_rows(expected: DataFrame, actual: DataFrame, keys: list[str], leaves: int = LEAVES) -> tuple[DataFrame, DataFrame]:
    """The normalised rows of both sides whose leaf of the key differs between them.

    One pass over each side takes its leaves' fingerprints; the numbers of those that differ,
    at most ``leaves``, are then sent to a second pass. Equal tables of any size pass no row
    on, and a few differences a few leaves of rows.
    """
    left, right = comparable_rows(expected, keys), comparable_rows(actual, keys)
    trees = [stored(tree(side, keys, side.columns, leaves)) for side in (left, right)]
    bad = stored(differing(*trees).withColumnRenamed("Leaf", "_leaf"))
    return tuple(side.join(F.broadcast(bad), leaf(keys, leaves) == F.col("_leaf"), "left_semi") for side in (left, right))


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str], leaves: int | None = LEAVES) -> DataFrame:
    """Differences cell by cell: ``(<keys>, Column, Expected, Actual)``.

    Cells are compared as normalised text. Only rows in leaves whose fingerprints differ are
    grouped (see ``differing_rows``; both sides are read twice and should be stored tables;
    ``leaves=None`` groups all rows in one pass instead, for results that are small anyway).
    Equal rows cancel out in one grouping over the whole row, so only differing rows go on. A
    key that holds a single row on each side is compared column by column; any other key is
    reported once as ``(row)`` with its row counts, so repeated keys never multiply.
    """
    if expected.columns != actual.columns:
        raise ValueError(f"headers differ: {expected.columns} and {actual.columns}")
    if leaves is None:
        expected, actual = comparable_rows(expected, keys), comparable_rows(actual, keys)
    else:
        expected, actual = differing_rows(expected, actual, keys, leaves)
    cells = [c for c in expected.columns if c not in keys]
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = expected.select(*keys, *cells, one.alias("_e"), none.alias("_a")).unionByName(
        actual.select(*keys, *cells, none.alias("_e"), one.alias("_a"))
    )
    rows = both.groupBy(*keys, *cells).agg(F.sum("_e").alias("_e"), F.sum("_a").alias("_a"))
    rows = rows.filter("_e <> _a").withColumn("_row", F.struct(*cells))
    pairs = rows.groupBy(*keys).agg(
        F.sum("_e").alias("_e"), F.sum("_a").alias("_a"),
        F.max(F.when(F.col("_e") > 0, F.col("_row"))).alias("_want"),
        F.max(F.when(F.col("_a") > 0, F.col("_row"))).alias("_got"),
    )
    single = (F.col("_e") == 1) & (F.col("_a") == 1)
    by_cell = F.array(*(
        F.struct(F.lit(c).alias("Column"), F.col(f"_want.{c}").alias("Expected"), F.col(f"_got.{c}").alias("Actual"))
        for c in cells
    ))
    by_row = F.array(F.struct(
        F.lit("(row)").alias("Column"), F.col("_e").cast("string").alias("Expected"),
        F.col("_a").cast("string").alias("Actual"),
    ))
    differs = lambda d: d["Expected"] != d["Actual"]
    found = F.when(single, F.filter(by_cell, differs)).otherwise(by_row)
    return pairs.select(*keys, F.inline(found))


def first_differences(differences: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """The report shows this many; ``reconcile`` itself returns them all."""
    return differences.orderBy(*keys, "Column").limit(n)


PUBLISHED = [
    "TotalVisits", "DistinctPatients", "TotalRevenue", "AverageBill", "AverageWaitMinutes",
    "AverageSatisfaction", "InsuranceCovered", "SeenWithin30", "SatisfiedVisits", "RepeatPatients",
    "VisitsPerPatient", "ActiveDoctors", "WeekendVisits",
]


def acceptance_figures(star: Star, cells: FacetCells | None = None) -> DataFrame:
    """Every published headline figure as formatted text: ``(Figure, Value)``.

    Growth, age bands and the longest wait are sums of stored ``cells`` if there are some."""
    totals = evaluate(star, PUBLISHED)
    visits, patients = F.col("TotalVisits"), F.col("DistinctPatients")
    count = lambda name: grouped_digits(F.col(name))
    part = lambda name, whole: F.concat(
        count(name), F.lit(" → "), ratio(F.col(name) * 100, whole, 1, "decimal(10,1)").cast("string"), F.lit("%")
    )
    rupees = lambda name: F.concat(
        F.lit("₹"), F.regexp_replace(grouped_digits(F.col(name), 2), r"\.00$", "")
    )
    text = {
        "Total Visits": count("TotalVisits"),
        "Distinct Patients": count("DistinctPatients"),
        "Total Revenue": rupees("TotalRevenue"),
        "Average Bill": rupees("AverageBill"),
        "Average Wait Minutes": F.col("AverageWaitMinutes").cast("string"),
        "Average Satisfaction": F.col("AverageSatisfaction").cast("string"),
        "Insurance Covered": rupees("InsuranceCovered"),
        "Seen Within 30 Min": part("SeenWithin30", visits),
        "Satisfied Visits": part("SatisfiedVisits", visits),
        "Repeat Patients": part("RepeatPatients", patients),
        "Visits per Patient": ratio(visits, patients, 2, "decimal(18,2)").cast("string"),
        "Active Doctors": count("ActiveDoctors"),
        "Weekend Visits": part("WeekendVisits", visits),
    }
    pairs = F.array(*(F.struct(F.lit(k).alias("Figure"), v.alias("Value")) for k, v in text.items()))
    headline = totals.select(F.inline(pairs))

    if cells is None:
        counted = star.flat("Year", "AgeBand").groupBy("Year", "AgeBand").agg(F.count(F.lit(1)).alias("Visits"))
    else:
        counted = cells.by("Year", "AgeBand").select("Year", "AgeBand", "Visits")
    yearly = counted.groupBy("Year").agg(F.sum("Visits").alias("Visits"))
    grown = with_lag(yearly, ["Visits"], 1, "Year").filter("PriorVisits is not null")
    growth = grown.select(
        F.concat(F.lit("Visit growth "), F.col("Year")).alias("Figure"),
        growth_percent(F.col("Visits"), F.col("PriorVisits")).cast("string").alias("Value"),
    )
    bands = counted.groupBy("AgeBand").agg(F.sum("Visits").alias("Visits")).select(
        F.concat(F.lit("Age band "), F.col("AgeBand")).alias("Figure"), grouped_digits(F.col("Visits")).alias("Value")
    )
    longest = extremes(star, cells).filter("Extreme = 'longest'").select(
        F.lit("Longest wait").alias("Figure"),
        F.concat("DepartmentName", F.lit(": "), F.col("AverageWaitMinutes").cast("string"), F.lit(" over "),
                 grouped_digits(F.col("TotalVisits")), F.lit(" visits")).alias("Value"),
    )
    sizes = row_counts({"Leaderboard rows": q10_top_doctors(star), "Departments": star.dims["department"]})
    sizes = sizes.select(F.col("Dataset").alias("Figure"), grouped_digits(F.col("RowCount")).alias("Value"))
    return union_periods([headline, growth, bands, longest, sizes])


def city_counts(patients: DataFrame) -> DataFrame:
    """Patients per clean city."""
    return patients.groupBy("City").agg(F.count(F.lit(1)).alias("Patients"))


def date_shift_growth(star: Star) -> DataFrame:
    """Growth by calendar year next to growth by shifting dates one year.

    Shifting each day of a year back by a year never lands on 29 February, so the second
    form loses the prior year's leap-day visits; the year bucket is the right one.
    """
    day = F.col("VisitDate")
    leap_day = (F.month(day) == 2) & (F.dayofmonth(day) == 29)
    yearly = star.visits("VisitDate").groupBy(F.year(day).alias("VisitYear")).agg(
        F.count(F.lit(1)).alias("TotalVisits"), F.count_if(leap_day).alias("LeapDayVisits")
    )
    yearly = with_lag(yearly, ["TotalVisits", "LeapDayVisits"], 1, "VisitYear")
    prior = F.col("PriorTotalVisits")
    return yearly.select(
        "VisitYear", "TotalVisits", "LeapDayVisits",
        growth_percent(F.col("TotalVisits"), prior).alias("YearBucketGrowthPercent"),
        growth_percent(F.col("TotalVisits"), prior - F.col("PriorLeapDayVisits")).alias("DateShiftGrowthPercent"),
    )
