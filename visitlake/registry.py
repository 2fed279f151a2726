"""Every registered query over the order tables: name -> ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.functions.dates import in_period
from visitlake.functions.numbers import money
from visitlake.operators import quality, relational, windows
from visitlake.plans import checks, clean, crossfilter, generate, packed, reconcile, summary, workloads
from visitlake.plans.analysis import QUERIES
from visitlake.plans.facetcells import FacetCells
from visitlake.plans.measures import calendar_of, evaluate
from visitlake.session import scratch_path, stored
from visitlake.sources import exports, testdata
from visitlake.sources.star import DIMENSION_KEYS, with_doctor_names
from visitlake.sources.tables import VISIT_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
CODING = crossfilter.Encoding(
    base_year=testdata.BASE_YEAR, months=84, bill_offset=testdata.BILL_OFFSET, bill_bytes=3,
    department=("DepartmentCategory", "DepartmentName"),
)


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


_BUILT: dict[tuple[str, ...], object] = {}


def _once(spark: SparkSession, sf: str, name: str, build: Callable[[], object]):
    """What several queries of one application share over one folder of tables, built by the first of them."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def facet_cells(spark: SparkSession, sf: str) -> FacetCells:
    return _once(spark, sf, "cells", lambda: FacetCells.build(testdata.star(spark, sf)))


def stored_waits(spark: SparkSession, sf: str, *by: str):
    return _once(spark, sf, f"waits by {by}", lambda: crossfilter.waits_of(testdata.star(spark, sf), list(by)))


def _analysis(name: str) -> Query:
    return lambda spark, sf: QUERIES[name](testdata.star(spark, sf))


REGISTRY.update({name: _analysis(name) for name in QUERIES})


# Cleaning and consolidation


def _patients(spark, sf):
    return clean.clean_patients(testdata.raw_patients(spark, sf), testdata.city_aliases(spark))


def _departments(spark, sf):
    return clean.clean_departments(testdata.raw_departments(spark, sf))


def _consolidated(spark, sf):
    return clean.consolidate([testdata.visits(spark, sf)], _patients(spark, sf), _departments(spark, sf))


@query
def clean_patients(spark, sf):
    return _patients(spark, sf)


@query
def rejected_patients(spark, sf):
    return clean.rejected_patients(testdata.raw_patients(spark, sf))


@query
def clean_departments(spark, sf):
    return _departments(spark, sf)


@query
def alias_map(spark, sf):
    """Patients per city before and after mapping its spelling."""
    raw = testdata.raw_patients(spark, sf).filter(clean.valid_patient())
    spelled = raw.select(F.trim(F.split("CityStateCountry", ",")[0]).alias("Spelling"))
    counted = spelled.groupBy("Spelling").agg(F.count(F.lit(1)).alias("Patients"))
    return relational.map_values(
        counted.withColumn("City", F.col("Spelling")), "City", testdata.city_aliases(spark)
    )


@query
def doctor_names(spark, sf):
    """Full names from two parts; a missing part makes the name NULL."""
    key = F.col("s_suppkey")
    parts = testdata.table(spark, sf, "supplier").select(
        key.alias("DoctorID"), F.lit("Dr.").alias("FirstName"),
        F.when(key % 10 != 3, F.col("s_name")).alias("LastName"),
    )
    return with_doctor_names(parts).select("DoctorID", "DoctorName")


@query
def dedupe_visits(spark, sf):
    columns = ["VisitID", "VisitDate", "VisitTime", "DoctorID", "DepartmentID", "WaitTimeMinutes"]
    return windows.dedupe_latest(testdata.visits(spark, sf, *columns), "VisitID", ["VisitDate", "VisitTime"])


@query
def consolidate(spark, sf):
    return _consolidated(spark, sf)


@query
def period_split_counts(spark, sf):
    routed = generate.with_period(testdata.visits(spark, sf, "VisitDate", "BillAmount"), "VisitDate", testdata.PERIODS)
    return routed.filter("Period is not null").groupBy("Period").agg(
        F.count(F.lit(1)).alias("Visits"), money(F.sum("BillAmount")).alias("Revenue")
    )


@query
def union_periods(spark, sf):
    """Two tables stacked by column name: orders by order date, lines by ship date."""
    orders = testdata.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Key"), F.col("o_orderdate").alias("Day"), F.lit("order").alias("Source")
    )
    lines = testdata.table(spark, sf, "lineitem").select(
        F.lit("line").alias("Source"), F.col("l_shipdate").alias("Day"), F.col("l_orderkey").alias("Key")
    )
    whole = relational.union_periods([orders, lines]).groupBy(F.year("Day").alias("Year"), "Source")
    return whole.agg(F.count(F.lit(1)).alias("RowCount"), F.max("Key").alias("LastKey"))


@query
def period_point_scan(spark, sf):
    """A half-open range on the raw date column, pruned by the scan."""
    orders = testdata.table(spark, sf, "orders")
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("1996-02-28", "1996-03-02"))
    inside = orders.filter(in_period(F.col("o_orderdate"), start, end))
    return inside.select("o_orderkey", F.col("o_orderdate").cast("date").alias("VisitDate"))


@query
def row_count_report(spark, sf):
    return relational.row_counts({
        "Raw patients": testdata.raw_patients(spark, sf),
        "Clean patients": _patients(spark, sf),
        "Raw departments": testdata.raw_departments(spark, sf),
        "Clean departments": _departments(spark, sf),
        "Consolidated visits": _consolidated(spark, sf),
    })


@query
def gen_visits(spark, sf):
    """One generated visit per order."""
    numbers = testdata.table(spark, sf, "orders").select((F.col("o_orderkey") + 1).alias("n"))
    return generate.generate_visits(numbers)


@query
def gen_visits_kpis(spark, sf):
    visits = gen_visits(spark, sf)
    return visits.groupBy(F.year("VisitDate").alias("VisitYear"), "DepartmentID").agg(
        F.count(F.lit(1)).alias("Visits"), money(F.sum("BillAmount")).alias("Revenue"),
        money(F.sum("InsuranceAmount")).alias("Insurance"),
        F.sum("WaitTimeMinutes").alias("WaitMinutes"), F.sum("SatisfactionScore").alias("Scores"),
        F.count_distinct("PatientID").alias("Patients"),
    )


# Exports


@query
def model_fact_export(spark, sf):
    return exports.model_table(_consolidated(spark, sf), "visits")


@query
def model_dim_export(spark, sf):
    return exports.model_table(_patients(spark, sf), "patient")


@query
def csv_roundtrip(spark, sf):
    load = QUERIES["q03_doctor_patient_load"](testdata.star(spark, sf))
    return exports.round_trip(spark, load, scratch_path(spark, "csv"))


@query
def manifest_counts(spark, sf):
    star = testdata.star(spark, sf)
    results = {
        name: QUERIES[name](star) for name in ("q02_annual_growth", "q06_department_rank", "q12_diagnosis_treatment")
    }
    return exports.export_all(results, scratch_path(spark, "exports"), "orders")


# Quality


@query
def dq_row_counts(spark, sf):
    """Raw lines against consolidated visits per period: what duplicates and unknown keys cost."""
    count = F.count(F.lit(1)).alias("RowCount")
    by_period = lambda df: generate.with_period(df, "VisitDate", testdata.PERIODS).groupBy("Period").agg(count)
    return quality.expected_counts(
        by_period(_consolidated(spark, sf)), by_period(testdata.visits(spark, sf, "VisitDate")), "Period"
    )


@query
def dq_duplicates(spark, sf):
    return quality.unique_key(testdata.visits(spark, sf, "VisitID"), "VisitID", "unique VisitID")


@query
def dq_measures(spark, sf):
    columns = [
        "VisitID", "VisitDate", "DischargeDate", "BillAmount", "InsuranceAmount",
        "SatisfactionScore", "WaitTimeMinutes",
    ]
    rules = checks.measure_rules("1995-07-01", "2001-01-01")
    return quality.row_rules(testdata.visits(spark, sf, *columns), rules, "VisitID")


@query
def dq_orphans(spark, sf):
    star = testdata.star(spark, sf)
    dims = {
        **star.dims,
        "patient": _patients(spark, sf),
        "department": _departments(spark, sf),
    }
    by_key = {DIMENSION_KEYS[name]: dim for name, dim in dims.items()}
    return quality.orphans(star.visits, by_key)


@query
def dq_soundalike(spark, sf):
    return quality.soundalikes(_patients(spark, sf), "City")


@query
def dq_alias_leftover(spark, sf):
    """Misspelt cities in the raw rows, and none of them after cleaning."""
    alias = testdata.city_aliases(spark)
    raw = testdata.raw_patients(spark, sf).filter(clean.valid_patient())
    spelled = raw.select(F.trim(F.split("CityStateCountry", ",")[0]).alias("City"))
    return quality.leftover_variants(spelled, "City", alias, "raw cities").unionByName(
        quality.leftover_variants(_patients(spark, sf), "City", alias, "clean cities")
    )


@query
def dq_constraints(spark, sf):
    star = testdata.star(spark, sf)
    return checks.constraint_checks(star, testdata.PERIOD_START, testdata.PERIOD_END)


@query
def dq_unique_names(spark, sf):
    """Part brands and types repeat, so the proxy names are not unique."""
    return checks.unique_names(testdata.star(spark, sf))


@query
def dq_month_gaps(spark, sf):
    return checks.month_gaps(testdata.visits(spark, sf, "VisitDate"))


@query
def city_counts(spark, sf):
    return reconcile.city_counts(_patients(spark, sf))


@query
def xf_encode_checks(spark, sf):
    fact = testdata.visits(spark, sf, "VisitID", "VisitDate", "WaitTimeMinutes", "BillAmount")
    rules = checks.code_width_rules(CODING)
    sizes = crossfilter.dictionary_checks(testdata.star(spark, sf), CODING)
    return quality.row_rules(fact, rules, "VisitID").unionByName(sizes)


# Measures


def _measures(name: str, measures: list[str], by: list[str], filters: dict | None = None) -> None:
    REGISTRY[name] = lambda spark, sf: evaluate(testdata.star(spark, sf), measures, by, filters)


_measures(
    "m_base",
    ["TotalVisits", "DistinctPatients", "TotalRevenue", "InsuranceCovered", "PatientPaid",
     "InsuranceCoverageRatio", "AverageBill", "AverageWaitMinutes", "AverageSatisfaction"],
    ["Year", "PaymentMethod"],
)
_measures(
    "m_service",
    ["SeenWithin30", "SeenWithin30Ratio", "SatisfiedVisits", "SatisfiedRatio", "WaitBandColour"],
    ["DepartmentCategory", "DepartmentName"],
)


@query
def m_wait_percentiles(spark, sf):
    measures = ["MedianWaitMinutes", "WaitP10Minutes", "WaitP90Minutes"]
    return evaluate(testdata.star(spark, sf), measures, ["DoctorID"], waits=stored_waits(spark, sf, "DoctorID"))


_measures(
    "m_yoy", ["TotalVisits", "VisitsLY", "VisitGrowthRatio", "TotalRevenue", "RevenueLY", "RevenueGrowthRatio"],
    ["PaymentMethod", "Year"], {"Year": [1996, 1998, 1999]},
)
_measures(
    "m_cumulative", ["TotalVisits", "CumulativeVisits", "CumulativeRevenue"], ["DepartmentCategory", "MonthStart"]
)
_measures(
    "m_cumulative_mixed", ["TotalVisits", "CumulativeVisits", "CumulativeRevenue"], ["MonthNumber", "Year", "DayType"]
)
_measures("m_dept_rank_by_name", ["TotalRevenue", "RevenueRankInCategory"], ["DepartmentName"])
_measures("m_doctor_ranks_by_name", ["TotalVisits", "DoctorPerformanceRank", "DoctorPerformanceRankExact"], ["DoctorName"])
_measures(
    "m_share", ["TotalVisits", "RevenueShareRatio", "VisitShareRatio"], ["DoctorID"], {"DayType": ["Weekday"]}
)
_measures(
    "m_dept_rank", ["TotalRevenue", "RevenueRankInCategory", "CategoryRevenueShareRatio"],
    ["DepartmentCategory", "DepartmentName"], {"DepartmentName": [f"Brand#{i}" for i in range(1, 13)]},
)
_measures("m_calendar", ["TotalVisits", "WeekendVisits", "WeekendShareRatio"], ["YearMonth"])
_measures(
    "m_patients", ["TotalVisits", "DistinctPatients", "RepeatPatients", "RepeatPatientRatio", "VisitsPerPatient"],
    ["Year"],
)
_measures("m_doctors", ["ActiveDoctors", "PatientsPerDoctor", "VisitsPerDoctor"], ["PaymentMethod"])
_measures(
    "m_doctor_ranks", ["TotalVisits", "DoctorPerformanceRank", "DoctorRankKey", "DoctorPerformanceRankExact"],
    ["DoctorID", "DoctorName"],
)
_measures("m_labels", ["RevenueLabel", "FilterContextLabel"], ["DepartmentName"], {"DayType": ["Weekend"]})


@query
def calendar(spark, sf):
    """The calendar covering the orders, with the orders of each day."""
    orders = testdata.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("VisitDate"))
    daily = orders.groupBy(F.col("VisitDate").alias("Date")).agg(F.count(F.lit(1)).alias("_n"))
    days = calendar_of(orders).join(daily, "Date", "left")
    return days.withColumn("Orders", F.coalesce("_n", F.lit(0))).drop("_n")


@query
def age_columns(spark, sf):
    star = testdata.star(spark, sf)
    rows = star.flat("AgeAtVisit", "AgeBand", "AgeBandOrder")
    return rows.groupBy("AgeAtVisit", "AgeBand", "AgeBandOrder").agg(F.count(F.lit(1)).alias("Visits"))


@query
def star_view(spark, sf):
    """The flattened star: fact, calendar, age and every dimension."""
    return testdata.star(spark, sf).flat(
        "VisitID", "VisitDate", "Year", "MonthStart", "DayType", "PatientID", "AgeAtVisit", "AgeBand",
        "DoctorID", "DoctorName", "DepartmentCategory", "DepartmentName", "DiagnosisName", "TreatmentName",
        "PaymentMethod", "BillAmount", "InsuranceAmount", "SatisfactionScore", "WaitTimeMinutes",
    )


@query
def date_shift_growth(spark, sf):
    return reconcile.date_shift_growth(testdata.star(spark, sf))


# Cross-filter


def _encoded(spark, sf):
    star = testdata.star(spark, sf)
    codes = crossfilter.dictionaries(star, CODING)
    return star, codes, crossfilter.encode_facts(star, codes, CODING)


@query
def xf_encode(spark, sf):
    return _encoded(spark, sf)[2]


def _summed(decoded: DataFrame) -> DataFrame:
    return decoded.groupBy("MonthStart", "DayType", "DepartmentName", "AgeBand").agg(
        F.count(F.lit(1)).alias("Visits"), F.sum("WaitTimeMinutes").alias("WaitMinutes"),
        F.sum("SatisfactionScore").alias("Scores"), money(F.sum("BillAmount")).alias("Revenue"),
        F.count_distinct("PatientID").alias("Patients"),
    )


@query
def xf_roundtrip(spark, sf):
    """The encoded extract decoded and summed up again."""
    _, codes, encoded = _encoded(spark, sf)
    return _summed(crossfilter.decode_facts(encoded, codes, CODING))


def _packed(spark, sf):
    """The extract as bytes, the width of each column, and the codes."""
    _, codes, encoded = _encoded(spark, sf)
    counts = [packed.width_of(testdata.table(spark, sf, name).count()) for name in ("supplier", "customer")]
    sizes = packed.widths(CODING, *counts)
    return packed.pack(encoded, sizes), sizes, codes


@query
def xf_packed(spark, sf):
    return packed.totals(_packed(spark, sf)[0])


@query
def xf_packed_roundtrip(spark, sf):
    """The packed extract unpacked, decoded and summed up again."""
    chunks, sizes, codes = _packed(spark, sf)
    rows = packed.unpack(chunks, sizes).withColumnRenamed("Row", "VisitID")
    return _summed(crossfilter.decode_facts(rows, codes, CODING))


@query
def xf_meta(spark, sf):
    star = testdata.star(spark, sf)
    return crossfilter.extract_meta(star, crossfilter.dictionaries(star, CODING), CODING, "orders")


FILTERS = {
    "xf_overview": {},
    "xf_filter_year": {"Year": [1996, 1999]},
    "xf_filter_daytype": {"DayType": ["Weekend"]},
    "xf_filter_dept": {"DepartmentName": ["Brand#20"]},
    "xf_filter_narrow": {
        "Year": [1995], "DepartmentName": ["Brand#20"], "DayType": ["Weekend"],
        "PaymentMethod": ["Urgent"], "AgeBand": ["36-55"],
    },
}


def _crossfilter(filters: dict) -> Query:
    return lambda spark, sf: crossfilter.crossfilter_cells(facet_cells(spark, sf), filters)


REGISTRY.update({name: _crossfilter(filters) for name, filters in FILTERS.items()})


@query
def xf_leaderboard(spark, sf):
    return crossfilter.leaderboard(testdata.star(spark, sf), {"DayType": ["Weekend"]})


@query
def xf_wait_histogram(spark, sf):
    return crossfilter.wait_histogram(testdata.star(spark, sf), waits=stored_waits(spark, sf, "DepartmentName", "Year"))


@query
def xf_seen_within(spark, sf):
    return crossfilter.seen_within(testdata.star(spark, sf), {"Year": [1997]}, stored_waits(spark, sf, "DepartmentName", "Year"))


@query
def xf_wait_percentiles(spark, sf):
    return crossfilter.wait_percentiles(testdata.star(spark, sf), waits=stored_waits(spark, sf, "DepartmentName", "Year"))


@query
def xf_partition_check(spark, sf):
    return crossfilter.partition_check(testdata.star(spark, sf), "36-55")


# Reconciliation and summary


def _service(visits: DataFrame) -> DataFrame:
    return visits.groupBy("DepartmentID").agg(
        F.count(F.lit(1)).alias("Visits"), F.sum("WaitTimeMinutes").alias("WaitMinutes")
    )


@query
def reconcile_values(spark, sf):
    """Departments whose figures change when duplicate visits are removed."""
    columns = ["VisitID", "VisitDate", "VisitTime", "DoctorID", "DepartmentID", "WaitTimeMinutes"]
    latest = windows.dedupe_latest(testdata.visits(spark, sf, *columns), "VisitID", ["VisitDate", "VisitTime"])
    raw = testdata.visits(spark, sf, "DepartmentID", "WaitTimeMinutes")  # without the headers
    return reconcile.reconcile(stored(_service(raw)), stored(_service(latest)), ["DepartmentID"])


@query
def reconcile_keys(spark, sf):
    """Patients in the visits against the cleaned patient list, both ways."""
    return relational.key_diff(testdata.visits(spark, sf, "PatientID"), _patients(spark, sf), ["PatientID"])


@query
def acceptance_figures(spark, sf):
    return reconcile.acceptance_figures(testdata.star(spark, sf), facet_cells(spark, sf))


@query
def exec_demand(spark, sf):
    return summary.demand(testdata.star(spark, sf))


@query
def exec_wait_tiers(spark, sf):
    return summary.wait_tiers(testdata.star(spark, sf), Decimal("0.05"))


@query
def exec_extremes(spark, sf):
    return summary.extremes(testdata.star(spark, sf), facet_cells(spark, sf))


# Workloads

_WORKLOADS = {
    "wl_monthly": (workloads.monthly, ["VisitDate", "BillAmount"]),
    "wl_annual": (workloads.annual, ["VisitDate", "BillAmount"]),
    "wl_department": (workloads.department, ["DepartmentID", "WaitTimeMinutes", "SatisfactionScore"]),
    "wl_doctor_load": (workloads.doctor_load, ["DoctorID", "PatientID"]),
    "wl_top_doctors": (workloads.top_doctors, ["DoctorID", "WaitTimeMinutes", "SatisfactionScore"]),
    "wl_payment": (workloads.payment, ["PaymentMethodID", "BillAmount"]),
    "wl_point_lookup": (
        lambda visits: workloads.point_lookup(visits, 123), ["PatientID", "VisitID", "VisitDate", "BillAmount"]
    ),
    "wl_full_scan": (workloads.full_scan, ["BillAmount", "InsuranceAmount"]),
}


def _workload(job, columns: list[str]) -> Query:
    return lambda spark, sf: job(testdata.visits(spark, sf, *columns))


REGISTRY.update({name: _workload(*spec) for name, spec in _WORKLOADS.items()})


@query
def bench_summary(spark, sf):
    """The summary over a run log read from the event stream."""
    user, value = F.col("user_id"), F.round(F.col("value") * 100).cast("bigint")
    log = testdata.table(spark, sf, "events").select(
        F.when(F.col("event_id") % 2 == 0, "clustered").otherwise("indexed").alias("Phase"),
        (user % 8 + 1).cast("int").alias("Position"),
        F.when(user % 8 == 3, F.lit(500)).otherwise(value + user % 100).alias("LogicalReads"),
        (value * 37 + 1000).alias("ElapsedUs"),
    )
    return workloads.bench_summary(log, "clustered", "indexed")
