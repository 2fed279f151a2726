"""Forty measures over the star, evaluated in a filter context.

``evaluate(star, measures, by, filters)`` groups the filtered visits by ``by`` and
returns one column per measure. Plain measures are one aggregation. A measure that looks
outside its own row (prior year, running total, share, rank) is computed from a second
aggregation or from a window over the aggregated rows, never over visits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.functions.bands import wait_colour
from visitlake.functions.dates import CALENDAR, in_period
from visitlake.functions.numbers import exact_ratio, growth_ratio, grouped_digits, mean, money, ratio, share
from visitlake.functions.text import money_label
from visitlake.operators.distribution import PrefixHistogram, percentiles
from visitlake.operators.relational import apply_filters
from visitlake.operators.windows import dense_rank_by_value, dense_ranked, running_total, with_totals
from visitlake.session import stored
from visitlake.sources.star import AGE_COLUMNS, DIMENSION_KEYS, Star
from visitlake.sources.tables import VISIT_COLUMNS
from visitlake.plans.analysis import MIN_RANKED_VISITS, SHORT_WAIT

SATISFIED_SCORE = 4
DATE_COLUMNS = {"VisitDate", *CALENDAR}
DEPARTMENT_COLUMNS = {"DepartmentID", "DepartmentName", "DepartmentCategory"}
DOCTOR_COLUMNS = {"DoctorID", "DoctorName"}

# Aggregates over visits: fact columns needed, and the aggregate. All additive but the last.
ADDITIVE: dict[str, tuple[list[str], Callable[[], Column]]] = {
    "TotalVisits": ([], lambda: F.count(F.lit(1))),
    "TotalRevenue": (["BillAmount"], lambda: F.sum("BillAmount")),
    "InsuranceCovered": (["InsuranceAmount"], lambda: F.sum("InsuranceAmount")),
    "_Waits": (["WaitTimeMinutes"], lambda: F.sum("WaitTimeMinutes")),
    "_Scores": (["SatisfactionScore"], lambda: F.sum("SatisfactionScore")),
    "SeenWithin30": (["WaitTimeMinutes"], lambda: F.count_if(F.col("WaitTimeMinutes") <= SHORT_WAIT)),
    "SatisfiedVisits": (["SatisfactionScore"], lambda: F.count_if(F.col("SatisfactionScore") >= SATISFIED_SCORE)),
    "WeekendVisits": (["DayType"], lambda: F.count_if(F.col("DayType") == "Weekend")),
}
COUNTS = {"TotalVisits", "SeenWithin30", "SatisfiedVisits", "WeekendVisits"}
PER_PATIENT = {"DistinctPatients", "RepeatPatients"}
DOCTOR_COUNT = "ActiveDoctors"
PERCENTILES = {"MedianWaitMinutes": 50, "WaitP10Minutes": 10, "WaitP90Minutes": 90}


@dataclass(frozen=True)
class Measure:
    """``needs`` names other measures or aggregates; ``value`` combines their columns."""

    needs: tuple[str, ...]
    value: Callable[[], Column]


def _c(name: str) -> Column:
    return F.col(name)


def _label(visits: Column, all_visits: Column) -> Column:
    part = grouped_digits(ratio(visits * 100, all_visits, 1, "decimal(10,1)"), 1)
    return F.concat(
        grouped_digits(visits), F.lit(" visits selected  ·  "), part, F.lit("% of all visits")
    )


MEASURES: dict[str, Measure] = {
    "TotalVisits": Measure(("TotalVisits",), lambda: _c("TotalVisits")),
    "DistinctPatients": Measure(("DistinctPatients",), lambda: _c("DistinctPatients")),
    "TotalRevenue": Measure(("TotalRevenue",), lambda: money(_c("TotalRevenue"))),
    "InsuranceCovered": Measure(("InsuranceCovered",), lambda: money(_c("InsuranceCovered"))),
    "PatientPaid": Measure(
        ("TotalRevenue", "InsuranceCovered"), lambda: money(_c("TotalRevenue") - _c("InsuranceCovered"))
    ),
    "InsuranceCoverageRatio": Measure(
        ("TotalRevenue", "InsuranceCovered"), lambda: share(_c("InsuranceCovered"), _c("TotalRevenue"))
    ),
    "AverageBill": Measure(
        ("TotalRevenue", "TotalVisits"), lambda: mean(_c("TotalRevenue"), _c("TotalVisits"), "decimal(18,2)")
    ),
    "AverageWaitMinutes": Measure(("_Waits", "TotalVisits"), lambda: mean(_c("_Waits"), _c("TotalVisits"))),
    "AverageSatisfaction": Measure(("_Scores", "TotalVisits"), lambda: mean(_c("_Scores"), _c("TotalVisits"))),
    "SeenWithin30": Measure(("SeenWithin30",), lambda: _c("SeenWithin30")),
    "SeenWithin30Ratio": Measure(
        ("SeenWithin30", "TotalVisits"), lambda: share(_c("SeenWithin30"), _c("TotalVisits"))
    ),
    "SatisfiedVisits": Measure(("SatisfiedVisits",), lambda: _c("SatisfiedVisits")),
    "SatisfiedRatio": Measure(
        ("SatisfiedVisits", "TotalVisits"), lambda: share(_c("SatisfiedVisits"), _c("TotalVisits"))
    ),
    "MedianWaitMinutes": Measure(("MedianWaitMinutes",), lambda: _c("MedianWaitMinutes")),
    "WaitP10Minutes": Measure(("WaitP10Minutes",), lambda: _c("WaitP10Minutes")),
    "WaitP90Minutes": Measure(("WaitP90Minutes",), lambda: _c("WaitP90Minutes")),
    "WaitBandColour": Measure(
        ("_Waits", "TotalVisits"), lambda: wait_colour(exact_ratio(_c("_Waits"), F.nullif(_c("TotalVisits"), F.lit(0))))
    ),
    "VisitsLY": Measure(("VisitsLY",), lambda: _c("VisitsLY")),
    "VisitGrowthRatio": Measure(
        ("VisitsLY", "TotalVisits"), lambda: growth_ratio(_c("TotalVisits"), _c("VisitsLY"))
    ),
    "RevenueLY": Measure(("RevenueLY",), lambda: money(_c("RevenueLY"))),
    "RevenueGrowthRatio": Measure(
        ("RevenueLY", "TotalRevenue"), lambda: growth_ratio(_c("TotalRevenue"), _c("RevenueLY"))
    ),
    "CumulativeVisits": Measure(("CumulativeVisits", "TotalVisits"), lambda: _c("CumulativeVisits")),
    "CumulativeRevenue": Measure(("CumulativeRevenue", "TotalRevenue"), lambda: money(_c("CumulativeRevenue"))),
    "RevenueShareRatio": Measure(
        ("AllTotalRevenue", "TotalRevenue", "TotalVisits"), lambda: share(_c("TotalRevenue"), _c("AllTotalRevenue"))
    ),
    "VisitShareRatio": Measure(
        ("AllTotalVisits", "TotalRevenue", "TotalVisits"), lambda: share(_c("TotalVisits"), _c("AllTotalVisits"))
    ),
    "RevenueRankInCategory": Measure(("RevenueRankInCategory", "TotalRevenue"), lambda: _c("RevenueRankInCategory")),
    "CategoryRevenueShareRatio": Measure(
        ("CategoryRevenue", "TotalRevenue"), lambda: share(_c("TotalRevenue"), _c("CategoryRevenue"))
    ),
    "WeekendVisits": Measure(("WeekendVisits",), lambda: _c("WeekendVisits")),
    "WeekendShareRatio": Measure(
        ("WeekendVisits", "TotalVisits"), lambda: share(_c("WeekendVisits"), _c("TotalVisits"))
    ),
    "RepeatPatients": Measure(("RepeatPatients",), lambda: _c("RepeatPatients")),
    "RepeatPatientRatio": Measure(
        ("RepeatPatients", "DistinctPatients"), lambda: share(_c("RepeatPatients"), _c("DistinctPatients"))
    ),
    "VisitsPerPatient": Measure(
        ("TotalVisits", "DistinctPatients"), lambda: share(_c("TotalVisits"), _c("DistinctPatients"))
    ),
    "ActiveDoctors": Measure(("ActiveDoctors",), lambda: _c("ActiveDoctors")),
    "PatientsPerDoctor": Measure(
        ("DistinctPatients", "ActiveDoctors"), lambda: share(_c("DistinctPatients"), _c("ActiveDoctors"))
    ),
    "VisitsPerDoctor": Measure(
        ("TotalVisits", "ActiveDoctors"), lambda: share(_c("TotalVisits"), _c("ActiveDoctors"))
    ),
    "DoctorPerformanceRank": Measure(
        ("DoctorPerformanceRank", "TotalVisits", "_Scores", "_Waits"), lambda: _c("DoctorPerformanceRank")
    ),
    "DoctorRankKey": Measure(
        ("TotalVisits", "_Scores", "_Waits"),
        lambda: ratio(_rank_points(), _c("TotalVisits") * WAIT_WEIGHT, 9, "decimal(18,9)"),
    ),
    "DoctorPerformanceRankExact": Measure(
        ("DoctorPerformanceRankExact", "TotalVisits", "_Scores", "_Waits"),
        lambda: _c("DoctorPerformanceRankExact"),
    ),
    "RevenueLabel": Measure(("TotalRevenue",), lambda: money_label(_c("TotalRevenue"))),
    "FilterContextLabel": Measure(
        ("UnfilteredVisits", "TotalVisits"), lambda: _label(_c("TotalVisits"), _c("UnfilteredVisits"))
    ),
}
WAIT_WEIGHT = 100_000  # the rank key gives a minute of wait this fraction of a point


def _rank_points() -> Column:
    """Satisfaction less a sliver of the wait: the rank key times visits and ``WAIT_WEIGHT``."""
    return _c("_Scores").cast("decimal(20,0)") * WAIT_WEIGHT - _c("_Waits").cast("decimal(20,0)")


def visits_in(star: Star, columns: list[str], filters: dict) -> DataFrame:
    """The visits inside the filters, cut to ``columns``. Years become date ranges on the
    visit date, which a scan can prune, instead of ``year(date) = ...``."""
    years = sorted(filters.get("Year") or [])
    others = {c: v for c, v in filters.items() if c != "Year" and v}
    extra = ["VisitDate"] if years else []
    df = star.flat(*dict.fromkeys([*columns, *others, *extra]))
    if years:
        day, inside = F.col("VisitDate"), F.lit(False)
        for year in years:
            first, after = (F.lit(f"{y}-01-01").cast("date") for y in (year, year + 1))
            inside = inside | in_period(day, first, after)
        df = df.filter(inside)
    return apply_filters(df, others)


def _join(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Left join on the grouping columns; NULL groups match each other."""
    if not by:
        row = right.select(F.struct(*right.columns).alias("_row")).scalar()
        left = left.withColumn("_row", row)
        return left.withColumns({c: F.col(f"_row.{c}") for c in right.columns}).drop("_row")
    right = right.select(*(F.col(c).alias(f"_r_{c}") if c in by else F.col(c) for c in right.columns))
    match = F.lit(True)
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(right, match, "left").drop(*(f"_r_{c}" for c in by))


def _only_dimension(star: Star, columns: list[str]) -> str | None:
    """The dimension all of ``columns`` describe, if there is one; its key may be among them."""
    described = [c for c in columns if c not in VISIT_COLUMNS]
    if not described or any(c in CALENDAR or c in AGE_COLUMNS for c in described):
        return None
    owners = {star.owner(c) for c in described}
    name = owners.pop()
    others = [c for c in columns if c in VISIT_COLUMNS]
    return name if not owners and name and all(c == DIMENSION_KEYS[name] for c in others) else None


def _sums_by(star: Star, additive: list[str], by: list[str], filters: dict) -> DataFrame:
    """Additive aggregates of the filtered visits per ``by``.

    When only one dimension is asked about, visits are summed by its key first and meet the
    dimension as one row per key; otherwise rows are flattened.
    """
    aggregates = [ADDITIVE[a][1]().alias(a) for a in additive]
    columns = [c for a in additive for c in ADDITIVE[a][0]]
    active = {c: v for c, v in filters.items() if v}
    name = _only_dimension(star, [*by, *active])
    if name is None or "DayType" in columns:
        return visits_in(star, [*by, *columns], filters).groupBy(*by).agg(*aggregates)
    key = DIMENSION_KEYS[name]
    by_key = star.visits(*dict.fromkeys([key, *columns])).groupBy(key).agg(*aggregates)
    described = [c for c in dict.fromkeys([*by, *active]) if c != key]
    rows = apply_filters(by_key.join(star.dims[name].select(key, *described), key, "left"), active)
    if key in by:
        return rows.select(*by, *additive)
    return rows.groupBy(*by).agg(*_resummed(additive))


def _resummed(additive: list[str]) -> list[Column]:
    """Sums of sums; counts of nothing are zero."""
    return [(F.coalesce(F.sum(a), F.lit(0)) if a in COUNTS else F.sum(a)).alias(a) for a in additive]


def _waits_only(waits: PrefixHistogram | None, additive: list[str], needed: set[str], by: list[str], filters: dict) -> DataFrame | None:
    """Visits and percentiles of the wait out of stored groups, where nothing else is asked for."""
    active = {c: v for c, v in filters.items() if v}
    points = {name: p for name, p in PERCENTILES.items() if name in needed}
    others = needed & (PER_PATIENT | {DOCTOR_COUNT}) or additive != ["TotalVisits"]
    if waits is None or not points or others or not waits.covers([*by, *active]):
        return None
    found = waits.over(by, reduce(and_, (F.col(c).isin(list(v)) for c, v in active.items())) if active else None)
    return _join(found.sizes("TotalVisits"), found.percentiles(points), by)


def _base(star: Star, needed: set[str], by: list[str], filters: dict, waits: PrefixHistogram | None = None) -> DataFrame:
    """Everything that is one aggregation of the filtered visits."""
    additive = [a for a in ADDITIVE if a in needed or a == "TotalVisits"]
    if (out := _waits_only(waits, additive, needed, by, filters)) is not None:
        return out
    columns = [*by, *(c for a in additive for c in ADDITIVE[a][0])]
    patients, doctors = needed & PER_PATIENT, DOCTOR_COUNT in needed
    if "RepeatPatients" in needed or (patients and not doctors):
        rows = visits_in(star, [*columns, "PatientID"], filters).groupBy(*by, "PatientID")
        rows = rows.agg(*(ADDITIVE[a][1]().alias(a) for a in additive))
        out = rows.groupBy(*by).agg(
            *_resummed(additive),
            F.count("PatientID").alias("DistinctPatients"),
            F.count_if(F.col("TotalVisits") > 1).alias("RepeatPatients"),
        )
        if doctors:
            active = visits_in(star, [*by, "DoctorID"], filters).groupBy(*by)
            out = _join(out, active.agg(F.count_distinct("DoctorID").alias(DOCTOR_COUNT)), by)
    elif not doctors:
        out = _sums_by(star, additive, by, filters)
    else:
        aggregates = [ADDITIVE[a][1]().alias(a) for a in additive]
        if patients:
            columns.append("PatientID")
            aggregates.append(F.count_distinct("PatientID").alias("DistinctPatients"))
        columns.append("DoctorID")
        aggregates.append(F.count_distinct("DoctorID").alias(DOCTOR_COUNT))
        out = visits_in(star, columns, filters).groupBy(*by).agg(*aggregates)
    points = {name: p for name, p in PERCENTILES.items() if name in needed}
    if points:
        rows = visits_in(star, [*by, "WaitTimeMinutes"], filters)
        out = _join(out, percentiles(rows, by, "WaitTimeMinutes", points), by)
    return out


def _year_in_context(by: list[str], filters: dict) -> Column | None:
    """The single year a row stands for, if there is one."""
    if "Year" in by:
        return F.col("Year")
    for column in ("MonthStart", "VisitDate"):
        if column in by:
            return F.year(column)
    if "YearMonth" in by:
        return F.substring("YearMonth", 1, 4).cast("int")
    years = filters.get("Year") or []
    return F.lit(years[0]) if len(years) == 1 else None


def _with_prior_year(out: DataFrame, star: Star, by: list[str], filters: dict) -> DataFrame:
    """The whole previous calendar year, whatever part of a year the row shows."""
    year = _year_in_context(by, filters)
    if year is None:
        return out.withColumns(
            {"VisitsLY": F.lit(None).cast("bigint"), "RevenueLY": F.lit(None).cast("decimal(28,2)")}
        )
    kept = [c for c in by if c not in DATE_COLUMNS]
    undated = {c: v for c, v in filters.items() if c not in DATE_COLUMNS}
    if filters.get("Year"):  # rows show those years only, so the scan may skip all but the ones before them
        undated["Year"] = sorted({y - 1 for y in filters["Year"]})
    prior = visits_in(star, [*kept, "Year", "BillAmount"], undated).groupBy(*kept, "Year").agg(
        F.count(F.lit(1)).alias("VisitsLY"), F.sum("BillAmount").alias("RevenueLY")
    )
    prior = prior.withColumn("_year", F.col("Year") + 1).drop("Year")
    return _join(out.withColumn("_year", year), prior, [*kept, "_year"]).drop("_year")


def _chronology(dates: list[str]) -> list[str] | None:
    """The columns that order rows in time, where each row is one stretch of days."""
    months = {"Year", "MonthNumber", "MonthName", "MonthStart", "YearMonth"}
    if "VisitDate" in dates:
        return ["VisitDate"]
    if not set(dates) <= months:
        return None
    for column in ("MonthStart", "YearMonth"):
        if column in dates:
            return [column]
    if {"Year", "MonthNumber"} <= set(dates):
        return ["Year", "MonthNumber"]
    return ["Year"] if dates == ["Year"] else None


def _with_running(out: DataFrame, star: Star, by: list[str], filters: dict) -> DataFrame:
    """Everything selected up to the last calendar day a row stands for, whatever other days
    (of another day type, say) lie before it."""
    dates, kept = [c for c in by if c in DATE_COLUMNS], [c for c in by if c not in DATE_COLUMNS]
    pairs = {"CumulativeVisits": "TotalVisits", "CumulativeRevenue": "TotalRevenue"}
    present = {new: old for new, old in pairs.items() if old in out.columns}
    if not dates:
        return out.withColumns({new: F.col(old) for new, old in present.items()})
    order = _chronology(dates)
    if order:
        return out.withColumns({new: running_total(old, order, kept) for new, old in present.items()})
    daily = visits_in(star, [*kept, "VisitDate", "BillAmount"], filters).groupBy(*kept, "VisitDate").agg(
        *(ADDITIVE[old][1]().alias(new) for new, old in present.items()))
    last = calendar_of(daily).groupBy(*dates).agg(F.max("Date").alias("_last"))
    out = _join(out, last, dates)
    # One row for each last day asked about goes in among the days, and reads the running sum there.
    asked = out.select(*kept, F.col("_last").alias("VisitDate"), *(F.lit(None).alias(new) for new in present)).distinct()
    days = daily.withColumn("_asked", F.lit(0)).unionByName(asked.withColumn("_asked", F.lit(1)))
    days = days.groupBy(*kept, "VisitDate", "_asked").agg(*(F.sum(new).alias(new) for new in present))
    days = days.withColumns({new: running_total(new, ["VisitDate", "_asked"], kept) for new in present})
    found = days.filter("_asked = 1").select(*kept, F.col("VisitDate").alias("_last"), *present)
    return _join(out, found, [*kept, "_last"]).drop("_last")


def _with_department_rank(out: DataFrame, star: Star, by: list[str]) -> DataFrame:
    """Dense rank by revenue among the departments of the row's category; by name alone,
    among the names that share a category with it. NULL where no single department is in context."""
    alias, others = "RevenueRankInCategory", [c for c in by if c not in DEPARTMENT_COLUMNS]
    if not {"DepartmentName", "DepartmentID"} & set(by):
        return out.withColumn(alias, F.lit(None).cast("int"))
    if "DepartmentCategory" in by:
        return dense_ranked(out, ["DepartmentCategory", *others], [F.desc("TotalRevenue")], alias)
    dim = star.dims["department"]
    if "DepartmentID" in by:
        category = dim.select(F.col("DepartmentID").alias("_id"), F.col("DepartmentCategory").alias("_category"))
        ranked = out.join(category, F.col("DepartmentID") == F.col("_id"), "left")
        return dense_ranked(ranked, ["_category", *others], [F.desc("TotalRevenue")], alias).drop("_id", "_category")
    names = dim.select("DepartmentName", "DepartmentCategory").distinct()
    # As many rows as departments have peers, not visits.
    peers = names.join(names.toDF("_peer", "DepartmentCategory"), "DepartmentCategory").select("DepartmentName", "_peer").distinct()
    revenue = out.select(F.col("DepartmentName").alias("_peer"), *others, F.col("TotalRevenue").alias("_theirs"))
    theirs = _join(out.select(*by, "TotalRevenue").join(peers, "DepartmentName"), revenue, ["_peer", *others])
    ranks = theirs.groupBy(*by).agg((F.count_distinct(F.when(F.col("_theirs") > F.col("TotalRevenue"), F.col("_theirs"))) + 1).cast("int").alias(alias))
    return _join(out, ranks, by)


def _with_category_revenue(out: DataFrame, star: Star, by: list[str], filters: dict) -> DataFrame:
    """Revenue of the row's category, or of everything when no category is in context,
    whichever departments are selected."""
    kept = [c for c in by if c not in DEPARTMENT_COLUMNS or c == "DepartmentCategory"]
    wide = {c: v for c, v in filters.items() if c not in DEPARTMENT_COLUMNS or c == "DepartmentCategory"}
    category = _sums_by(star, ["TotalRevenue"], kept, wide).withColumnRenamed("TotalRevenue", "CategoryRevenue")
    return _join(out, category, kept)


DOCTOR_RANKS = {"DoctorPerformanceRank", "DoctorPerformanceRankExact"}


def _per_doctor(star: Star, needed: set[str], by: list[str], filters: dict) -> DataFrame | None:
    """Sums of each doctor, stored, where rows show names but ranks are those of doctors: the
    fact is read once for the names' rows and all ranks."""
    if not needed & DOCTOR_RANKS or "DoctorID" in by or "DoctorName" not in by:
        return None
    additive = [a for a in ADDITIVE if a in needed | {"TotalVisits", "_Scores", "_Waits"}]
    return stored(_sums_by(star, additive, ["DoctorID", *(c for c in by if c not in DOCTOR_COLUMNS)], filters))


def _named(doctors: DataFrame, star: Star, by: list[str]) -> DataFrame:
    """Sums of doctors per name."""
    names = star.dims["doctor"].select("DoctorID", "DoctorName")
    additive = [a for a in ADDITIVE if a in doctors.columns]
    return doctors.join(names, "DoctorID", "left").groupBy(*by).agg(*_resummed(additive))


def _with_doctor_rank(
    out: DataFrame, star: Star, by: list[str], doctors: DataFrame | None, alias: str, points: Column, scale: int
) -> DataFrame:
    """Dense rank by ``points`` per visit among doctors with enough visits; the rest, and
    rows that do not stand for one doctor, stay NULL. ``scale`` is what a score is worth
    in points, so scores from 1 to 5 spread over some 5,000 bins."""
    peers = [c for c in by if c not in DOCTOR_COLUMNS]
    key = exact_ratio(points, _c("TotalVisits"))
    ranked = lambda rows: dense_rank_by_value(
        rows.withColumn("_key", F.when(F.col("TotalVisits") >= MIN_RANKED_VISITS, key)), "_key", alias, Decimal(1000) / scale, peers).drop("_key")
    if "DoctorID" in by:
        return ranked(out)
    if "DoctorName" not in by:
        return out.withColumn(alias, F.lit(None).cast("bigint"))
    # A name stands for a doctor if no other one bears it; the ranks are those of all doctors.
    doctors = ranked(doctors)
    named = star.dims["doctor"].groupBy("DoctorName").agg(F.min("DoctorID").alias("DoctorID"), F.count_distinct("DoctorID").alias("_n"))
    ranks = doctors.join(named.filter("_n = 1").drop("_n"), "DoctorID").select("DoctorName", *peers, alias)
    return _join(out, ranks, ["DoctorName", *peers])


def evaluate(
    star: Star, measures: list[str], by: list[str] = (), filters: dict | None = None, waits: PrefixHistogram | None = None
) -> DataFrame:
    """One row per combination of ``by`` values among the filtered visits.

    Percentiles of the wait asked for alone come from stored ``waits``, if they cover the columns. ``by`` and ``filters`` take fact, calendar, age and dimension columns. Group by
    ``DepartmentCategory`` as well as ``DepartmentName`` where names repeat.
    """
    by, filters = list(by), dict(filters or {})
    needed = {need for name in measures for need in MEASURES[name].needs}
    doctors = _per_doctor(star, needed, by, filters)
    plain = doctors is not None and needed <= {*ADDITIVE, *DOCTOR_RANKS}
    out = _named(doctors, star, by) if plain else _base(star, needed, by, filters, waits)
    if needed & {"VisitsLY", "RevenueLY"}:
        out = _with_prior_year(out, star, by, filters)
    if needed & {"CumulativeVisits", "CumulativeRevenue"}:
        out = _with_running(out, star, by, filters)
    if needed & {"AllTotalRevenue", "AllTotalVisits"}:
        out = with_totals(out, ["TotalVisits", "TotalRevenue"])
    if "RevenueRankInCategory" in needed:
        out = _with_department_rank(out, star, by)
    if "CategoryRevenue" in needed:
        out = _with_category_revenue(out, star, by, filters)
    if "DoctorPerformanceRank" in needed:
        out = _with_doctor_rank(out, star, by, doctors, "DoctorPerformanceRank", _c("_Scores"), 1)
    if "DoctorPerformanceRankExact" in needed:
        out = _with_doctor_rank(out, star, by, doctors, "DoctorPerformanceRankExact", _rank_points(), WAIT_WEIGHT)
    if "UnfilteredVisits" in needed:
        every = star.visits("VisitID").agg(F.count(F.lit(1)).alias("_n"))
        out = out.withColumn("UnfilteredVisits", every.scalar())
    return out.select(*by, *(MEASURES[name].value().alias(name) for name in measures))


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive."""
    first, last = (F.lit(text).cast("date") for text in (start, end))
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("Date"))
    return days.withColumns({name: rule(F.col("Date")) for name, rule in CALENDAR.items()})


def calendar_of(visits: DataFrame) -> DataFrame:
    """Whole calendar years covering the visit dates."""
    span = visits.agg(F.min("VisitDate").alias("_from"), F.max("VisitDate").alias("_to"))
    first, last = F.trunc("_from", "year"), F.last_day(F.add_months(F.trunc("_to", "year"), 11))
    days = span.select(F.explode(F.sequence(first, last)).alias("Date"))
    return days.withColumns({name: rule(F.col("Date")) for name, rule in CALENDAR.items()})
