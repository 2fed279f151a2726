"""Dashboard data: the encoded extract and the aggregates behind each cross-filter."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions.bands import AGE_BANDS, band_order
from visitlake.functions.numbers import money
from visitlake.operators.distribution import PrefixHistogram, cumulative_upto, histogram, percentiles
from visitlake.operators.relational import union_periods
from visitlake.operators.windows import dense_index, small_index
from visitlake.plans.analysis import REPEAT_VISITS, SHORT_WAIT, ranked_doctors
from visitlake.plans.facetcells import FACETS, MEMBERS, FacetCells
from visitlake.plans.measures import visits_in
from visitlake.sources.star import LazyTables, Star

WEEKEND_BIT, MONTH_MASK = 0x80, 0x7F
BYTE_CODES = 256


@dataclass(frozen=True)
class Encoding:
    """Where codes start, how far they go, and the columns each dictionary is ordered by."""

    base_year: int = 2020
    months: int = 72
    bill_offset: int = 3000
    bill_bytes: int = 2
    department: tuple[str, ...] = ("DepartmentID",)
    payment: tuple[str, ...] = ("PaymentMethodID",)

    def month(self, day: Column) -> Column:
        return (F.year(day) - self.base_year) * 12 + F.month(day) - 1

    def month_fits(self, month: Column) -> Column:
        return month.between(0, min(self.months, MONTH_MASK + 1) - 1)

    def wait_fits(self, wait: Column) -> Column:
        return wait.between(0, BYTE_CODES - 1)

    def bill(self, amount: Column) -> Column:
        return F.bround(amount, 0) - self.bill_offset

    def bill_fits(self, bill: Column) -> Column:
        return bill.between(0, BYTE_CODES**self.bill_bytes - 1)


def month_week(day: Column, base_year: int) -> Column:
    """Months since the base year in the low seven bits, the weekend in the eighth."""
    month = (F.year(day) - base_year) * 12 + F.month(day) - 1
    return month.bitwiseOR(F.when(F.weekday(day) >= 5, WEEKEND_BIT).otherwise(0))


def dictionaries(star: Star, coding: Encoding = Encoding()) -> Mapping[str, DataFrame]:
    """Dense 0-based codes per dimension, in key order, each made when it is first read.
    Departments and payment methods have one-byte codes and stop the job beyond them; the
    others may grow."""
    return LazyTables({
        "department": lambda: small_index(star.dims["department"], list(coding.department), "dept", BYTE_CODES),
        "payment": lambda: small_index(star.dims["payment"], list(coding.payment), "pay", BYTE_CODES),
        "doctor": lambda: dense_index(star.dims["doctor"], ["DoctorID"], "doctor"),
        "patient": lambda: dense_index(star.dims["patient"], ["PatientID"], "patient"),
    })


def dictionary_checks(star: Star, coding: Encoding = Encoding()) -> DataFrame:
    """How many keys of each one-byte dictionary do not fit."""
    sizes = [
        star.dims[name].select(*keys).distinct().agg(F.count(F.lit(1)).alias("_n")).select(
            F.lit(f"{name} codes").alias("CheckID"), F.lit("error").alias("Severity"),
            F.greatest(F.col("_n") - BYTE_CODES, F.lit(0)).alias("Violations"),
            F.when(F.col("_n") > BYTE_CODES, F.concat(F.col("_n").cast("string"), F.lit(" keys"))).alias("Sample"),
            (F.col("_n") <= BYTE_CODES).alias("Passed"),
        )
        for name, keys in (("department", coding.department), ("payment", coding.payment))
    ]
    return union_periods(sizes)


def _required(value: Column, fits: Column, what: str) -> Column:
    """``value``, or an error naming the visit: the extract cannot hold it, and a row that
    is left out or cut to its code would falsify every total."""
    message = F.concat(F.lit("visit "), F.coalesce(F.col("VisitID"), F.lit("without an id")), F.lit(f": {what}"))
    return F.when(fits, value).otherwise(F.raise_error(message))


def with_codes(star: Star, codes: Mapping[str, DataFrame], coding: Encoding) -> Star:
    """The star with the codes attached to its dimensions, so that the fact meets each once."""
    keys = {"department": list(coding.department), "payment": list(coding.payment), "doctor": ["DoctorID"], "patient": ["PatientID"]}
    coded = {name: star.dims[name].join(codes[name], on) for name, on in keys.items()}
    return replace(star, dims={**{n: star.dims[n] for n in star.dims if n not in coded}, **coded})


def encode_facts(star: Star, codes: Mapping[str, DataFrame], coding: Encoding = Encoding()) -> DataFrame:
    """One row of small integers per visit. Stops at a visit with an unknown or missing key
    or birth date, or with a month, wait or bill its code cannot hold."""
    df = with_codes(star, codes, coding).flat(
        "VisitID", "VisitDate", "AgeBand", "SatisfactionScore", "WaitTimeMinutes", "BillAmount", "dept", "pay", "doctor", "patient")
    month, wait, bill = coding.month(F.col("VisitDate")), F.col("WaitTimeMinutes"), coding.bill(F.col("BillAmount"))
    known = lambda code, what: _required(F.col(code), F.col(code).isNotNull(), f"unknown {what}")
    age = band_order(F.col("AgeBand"), AGE_BANDS) - 1
    return df.select(
        "VisitID",
        _required(month_week(F.col("VisitDate"), coding.base_year), coding.month_fits(month), "month out of range").alias("monthweek"),
        known("dept", "department").cast("int").alias("dept"), known("pay", "payment method").cast("int").alias("pay"),
        _required(age, age.isNotNull(), "no birth date").alias("age"),
        known("doctor", "doctor").alias("doctor"), F.col("SatisfactionScore").alias("sat"),
        _required(wait, coding.wait_fits(wait), "wait does not fit a byte").alias("wait"),
        _required(bill.cast("int"), coding.bill_fits(bill), f"bill does not fit {coding.bill_bytes} bytes").alias("bill"),
        known("patient", "patient").alias("patient"),
    )


def decode_facts(encoded: DataFrame, codes: Mapping[str, DataFrame], coding: Encoding = Encoding()) -> DataFrame:
    """Codes back to values; the date comes back as its month and day type."""
    month = F.col("monthweek").bitwiseAND(MONTH_MASK)
    weekend = F.col("monthweek").bitwiseAND(WEEKEND_BIT) != 0
    labels = F.array(*(F.lit(label) for _, label in AGE_BANDS))
    df = encoded
    for name, code in (("department", "dept"), ("payment", "pay"), ("doctor", "doctor"), ("patient", "patient")):
        df = df.join(codes[name].withColumnRenamed(code, f"_{code}"), F.col(code) == F.col(f"_{code}"))
    year = F.lit(coding.base_year) + F.floor(month / 12).cast("int")
    return df.select(
        "VisitID", F.make_date(year, month % 12 + 1, F.lit(1)).alias("MonthStart"),
        F.when(weekend, "Weekend").otherwise("Weekday").alias("DayType"),
        *coding.department, *coding.payment, "DoctorID", "PatientID",
        F.element_at(labels, F.col("age") + 1).alias("AgeBand"),
        F.col("sat").alias("SatisfactionScore"), F.col("wait").alias("WaitTimeMinutes"),
        (F.col("bill") + coding.bill_offset).cast("decimal(18,2)").alias("BillAmount"),
    )


def extract_meta(star: Star, codes: Mapping[str, DataFrame], coding: Encoding = Encoding(), source: str = "unknown") -> DataFrame:
    """What a reader of the extract needs: its size and offsets, where it comes from, and
    every code with its name."""
    bands = F.array(*(
        F.struct(F.lit(i).cast("bigint").alias("Code"), F.lit(label).alias("Name"))
        for i, (_, label) in enumerate(AGE_BANDS)
    ))
    none, session = F.lit(None).cast("string"), star.dims["payment"].sparkSession
    parts = [session.range(1).select(F.inline(bands)).select(
        F.lit("age").alias("Dictionary"), "Code", "Name", none.alias("Category")
    )]
    for name, code, keys, label, category in (
        ("department", "dept", coding.department, "DepartmentName", F.col("DepartmentCategory")),
        ("payment", "pay", coding.payment, "PaymentMethod", none),
        ("doctor", "doctor", ("DoctorID",), "DoctorName", none),
    ):
        dim = star.dims[name].join(codes[name], list(keys))
        named = dim.select(
            F.lit(name).alias("Dictionary"), F.col(code).cast("bigint").alias("Code"),
            F.col(label).alias("Name"), category.alias("Category"),
        )
        parts.append(named.distinct())
    figures = [("base year", F.lit(coding.base_year)), ("months", F.lit(coding.months)), ("bill offset", F.lit(coding.bill_offset)),
               ("rows", star.visits("VisitID").agg(F.count(F.lit(1))).scalar()),
               ("patients", star.dims["patient"].agg(F.count_distinct("PatientID")).scalar())]
    row = lambda name, value, note: F.struct(
        F.lit("extract").alias("Dictionary"), value.cast("bigint").alias("Code"), F.lit(name).alias("Name"), note.alias("Category"))
    described = [row(name, value, none) for name, value in figures] + [row("source", F.lit(None), F.lit(source))]
    parts.append(session.range(1).select(F.inline(F.array(*described))))
    return union_periods(parts)


def crossfilter(star: Star, filters: dict | None = None) -> DataFrame:
    """Totals and one row per member of each facet, all under the same filters, from the fact.

    Visits are grouped once to the cells of all facets together; totals and facets are
    sums over those cells. Patients cannot be summed, so they get their own grouping,
    for the total only. ``filters`` may be on any column; ``crossfilter_cells`` answers
    those on members without the fact.
    """
    filters = dict(filters or {})
    rows = visits_in(star, [*FACETS.values(), "BillAmount", "WaitTimeMinutes", "SatisfactionScore"], filters)
    cells = rows.groupBy(*FACETS.values()).agg(
        F.count(F.lit(1)).alias("Visits"), F.sum("BillAmount").alias("Revenue"),
        F.sum("WaitTimeMinutes").alias("WaitMinutes"), F.sum("SatisfactionScore").alias("Scores"),
    )
    frequency = visits_in(star, ["PatientID"], filters).groupBy("PatientID").agg(F.count(F.lit(1)).alias("_n"))
    patients = frequency.agg(
        F.count(F.lit(1)).alias("Patients"), F.count_if(F.col("_n") >= REPEAT_VISITS).alias("RepeatPatients"))
    return _bundle(cells, patients)


def crossfilter_cells(cells: FacetCells, filters: dict | None = None) -> DataFrame:
    """The same from stored cells; filters are on their members and the year."""
    filters = {c: v for c, v in (filters or {}).items() if v}
    if not cells.answers(filters):
        raise ValueError(f"cells know {MEMBERS} and Year, not {sorted(set(filters))}")
    return _bundle(cells.picked(filters), cells.patients(filters))


def _bundle(cells: DataFrame, patients: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("Visits", "Revenue", "WaitMinutes", "Scores")]
    members = cells.groupingSets([[F.col(c)] for c in FACETS.values()], *FACETS.values()).agg(
        *sums, *(F.grouping(c).alias(f"_{name}") for name, c in FACETS.items())
    )
    facet, member = F, F
    for name, column in FACETS.items():
        facet = facet.when(F.col(f"_{name}") == 0, name)
        member = member.when(F.col(f"_{name}") == 0, F.col(column))
    members = members.select(
        facet.alias("Facet"), member.alias("Member"), "Visits", "Revenue", "WaitMinutes", "Scores",
        F.lit(None).cast("bigint").alias("Patients"), F.lit(None).cast("bigint").alias("RepeatPatients"),
    )
    counted = patients.select(F.struct("Patients", "RepeatPatients").alias("_patients")).scalar()
    total = cells.agg(*sums).withColumn("_patients", counted).select(
        F.lit("total").alias("Facet"), F.lit("all").alias("Member"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("Visits", "Revenue", "WaitMinutes", "Scores")),
        F.col("_patients.Patients").alias("Patients"), F.col("_patients.RepeatPatients").alias("RepeatPatients"),
    )
    return total.unionByName(members).withColumn("Revenue", money(F.col("Revenue")))


def leaderboard(star: Star, filters: dict | None = None) -> DataFrame:
    """The doctor ranking of the filtered visits."""
    rows = visits_in(star, ["DoctorID", "SatisfactionScore", "WaitTimeMinutes"], dict(filters or {}))
    return ranked_doctors(rows, star.dims["doctor"])


WAIT_POINTS = {"WaitP10": 10, "WaitP50": 50, "WaitP90": 90}


def waits_of(star: Star, by: list[str], path: str | None = None) -> PrefixHistogram:
    """The stored waits per finest group, read from the fact once."""
    return PrefixHistogram.build(visits_in(star, [*by, "WaitTimeMinutes"], {}), by, "WaitTimeMinutes", path)


def _waits(star: Star, filters: dict | None, waits: PrefixHistogram | None) -> PrefixHistogram | None:
    """Waits per department under the filters, if the stored groups can tell."""
    filters = {c: v for c, v in (filters or {}).items() if v}
    if waits is None or not waits.covers(["DepartmentName", *filters]):
        return None
    keep = [F.col(c).isin(list(values)) for c, values in filters.items()]
    return waits.over(["DepartmentName"], reduce(and_, keep) if keep else None)


def wait_histogram(star: Star, filters: dict | None = None, waits: PrefixHistogram | None = None) -> DataFrame:
    """Visits per department and minute. This and the next two read stored ``waits`` where
    those cover the filters, and the fact otherwise."""
    if (found := _waits(star, filters, waits)) is not None:
        return found.histogram()
    rows = visits_in(star, ["DepartmentName", "WaitTimeMinutes"], dict(filters or {}))
    return histogram(rows, ["DepartmentName"], "WaitTimeMinutes")


def seen_within(star: Star, filters: dict | None = None, waits: PrefixHistogram | None = None) -> DataFrame:
    if (found := _waits(star, filters, waits)) is not None:
        return found.upto(SHORT_WAIT, "SeenWithin30")
    return cumulative_upto(
        wait_histogram(star, filters), ["DepartmentName"], "WaitTimeMinutes", SHORT_WAIT, "SeenWithin30"
    )


def wait_percentiles(star: Star, filters: dict | None = None, waits: PrefixHistogram | None = None) -> DataFrame:
    """Nearest-rank percentiles per department, as the dashboard shows them."""
    if (found := _waits(star, filters, waits)) is not None:
        return found.percentiles(WAIT_POINTS, "nearest")
    rows = visits_in(star, ["DepartmentName", "WaitTimeMinutes"], dict(filters or {}))
    return percentiles(rows, ["DepartmentName"], "WaitTimeMinutes", WAIT_POINTS, "nearest")


def partition_check(star: Star, band: str) -> DataFrame:
    """Payment slices of one age band next to the band itself; they must add up."""
    rows = visits_in(star, ["PaymentMethod", "AgeBand"], {"AgeBand": [band]})
    slices = rows.groupBy("AgeBand", "PaymentMethod").agg(F.count(F.lit(1)).alias("Visits"))
    whole = visits_in(star, ["AgeBand"], {"AgeBand": [band]}).groupBy("AgeBand").agg(F.count(F.lit(1)).alias("BandVisits"))
    summed = slices.groupBy("AgeBand").agg(
        F.sum("Visits").alias("SliceVisits"), F.count(F.lit(1)).alias("Slices")
    )
    joined = summed.join(whole, "AgeBand")
    return joined.withColumn("Agrees", F.col("SliceVisits") == F.col("BandVisits"))
