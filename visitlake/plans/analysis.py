"""The twelve business queries.

Each takes a ``Star`` and returns a lazy DataFrame. Facts are aggregated by their own
keys before any dimension is joined, windows run on the aggregated rows, and averages
are kept as sums and counts until the last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions.bands import AGE_BANDS, band_order
from visitlake.functions.dates import day_type, month_start
from visitlake.functions.numbers import exact_ratio, growth_percent, mean, money, percent
from visitlake.operators.relational import join_dim, per_entity, rollup_dim
from visitlake.operators.windows import dense_ranked, running_total, top_with_ties, with_lag, with_totals
from visitlake.sources.star import DIMENSION_KEYS, Star

SHORT_WAIT = 30
MIN_RANKED_VISITS, TOP_RANKS = 100, 10
REPEAT_VISITS = 2


def visits_count() -> Column:
    return F.count(F.lit(1))


def _sums(*names: str) -> dict[str, Column]:
    every = {
        "TotalVisits": visits_count(),
        "Revenue": F.sum("BillAmount"),
        "Waits": F.sum("WaitTimeMinutes"),
        "Scores": F.sum("SatisfactionScore"),
        "ShortWaits": F.count_if(F.col("WaitTimeMinutes") <= SHORT_WAIT),
    }
    return {name: every[name] for name in names}


def _dim(star: Star, name: str, *columns: str) -> tuple[str, DataFrame]:
    key = DIMENSION_KEYS[name]
    return key, star.dims[name].select(key, *columns)


def q01_operating_kpis(star: Star) -> DataFrame:
    fact = star.visits("PatientID", "BillAmount", "WaitTimeMinutes", "SatisfactionScore")
    sums = _sums("TotalVisits", "Revenue", "Waits", "Scores")
    totals = per_entity(fact, [], "PatientID", sums, "DistinctPatients")
    totals = totals.withColumn("TotalVisits", F.coalesce("TotalVisits", F.lit(0)))
    n = F.col("TotalVisits")
    return totals.select(
        "TotalVisits", "DistinctPatients",
        money(F.col("Revenue")).alias("TotalBilledRevenueINR"),
        mean(F.col("Revenue"), n, "decimal(18,2)").alias("AverageBillINR"),
        mean(F.col("Waits"), n).alias("AverageWaitMinutes"),
        mean(F.col("Scores"), n).alias("AverageSatisfaction"),
    )


def annual_growth(star: Star) -> DataFrame:
    yearly = star.visits("VisitDate", "BillAmount").groupBy(F.year("VisitDate").alias("VisitYear"))
    yearly = yearly.agg(*(c.alias(n) for n, c in _sums("TotalVisits", "Revenue").items()))
    yearly = with_lag(yearly, ["TotalVisits", "Revenue"], 1, "VisitYear")
    return yearly.select(
        "VisitYear", "TotalVisits", money(F.col("Revenue")).alias("TotalRevenueINR"),
        growth_percent(F.col("TotalVisits"), F.col("PriorTotalVisits")).alias("VisitGrowthPercent"),
        growth_percent(F.col("Revenue"), F.col("PriorRevenue")).alias("RevenueGrowthPercent"),
    )


def q02_annual_growth(star: Star) -> DataFrame:
    return annual_growth(star).orderBy("VisitYear")


def q03_doctor_patient_load(star: Star) -> DataFrame:
    fact = star.visits("DoctorID", "PatientID")
    load = per_entity(fact, ["DoctorID"], "PatientID", _sums("TotalVisits"), "DistinctPatients")
    named = join_dim(load, _dim(star, "doctor", "DoctorName")[1], "DoctorID")
    return named.select("DoctorID", "DoctorName", "DistinctPatients", "TotalVisits").orderBy(
        F.desc("DistinctPatients"), F.desc("TotalVisits"), "DoctorID"
    )


def q04_payment_mix(star: Star) -> DataFrame:
    mix = rollup_dim(
        star.visits("PaymentMethodID", "BillAmount"), [_dim(star, "payment", "PaymentMethod")],
        ["PaymentMethod"], _sums("TotalVisits", "Revenue"),
    )
    return with_totals(mix, ["TotalVisits", "Revenue"]).select(
        "PaymentMethod", "TotalVisits", money(F.col("Revenue")).alias("TotalRevenueINR"),
        percent(F.col("Revenue"), F.col("AllRevenue")).alias("RevenueSharePercent"),
    ).orderBy(F.desc("TotalRevenueINR"))


def q05_age_band(star: Star) -> DataFrame:
    rows = star.flat("DOB", "AgeBand", "BillAmount").filter("DOB is not null")
    banded = rows.groupBy(F.col("AgeBand").alias("AgeGroup")).agg(
        *(c.alias(n) for n, c in _sums("TotalVisits", "Revenue").items())
    )
    return banded.select(
        "AgeGroup", "TotalVisits",
        mean(F.col("Revenue"), F.col("TotalVisits"), "decimal(18,2)").alias("AverageBillINR"),
    ).orderBy(band_order(F.col("AgeGroup"), AGE_BANDS))


def q06_department_rank(star: Star) -> DataFrame:
    performance = rollup_dim(
        star.visits("DepartmentID", "BillAmount"),
        [_dim(star, "department", "DepartmentCategory", "DepartmentName")],
        ["DepartmentCategory", "DepartmentName"], _sums("TotalVisits", "Revenue"),
    )
    ranked = dense_ranked(
        performance, ["DepartmentCategory"], [F.desc("Revenue")], "RevenueRankWithinCategory"
    )
    return ranked.select(
        "DepartmentCategory", "DepartmentName", "TotalVisits",
        money(F.col("Revenue")).alias("TotalRevenueINR"), "RevenueRankWithinCategory",
    ).orderBy("DepartmentCategory", "RevenueRankWithinCategory", "DepartmentName")


def service_risk(star: Star) -> DataFrame:
    service = rollup_dim(
        star.visits("DepartmentID", "WaitTimeMinutes", "SatisfactionScore"),
        [_dim(star, "department", "DepartmentName")], ["DepartmentName"],
        _sums("TotalVisits", "Waits", "Scores", "ShortWaits"),
    )
    n = F.col("TotalVisits")
    return service.select(
        "DepartmentName", "TotalVisits",
        mean(F.col("Scores"), n).alias("AverageSatisfaction"),
        mean(F.col("Waits"), n).alias("AverageWaitMinutes"),
        percent(F.col("ShortWaits"), n).alias("VisitsWithin30MinutesPercent"),
    )


def q07_department_service_risk(star: Star) -> DataFrame:
    return service_risk(star).orderBy(F.desc("AverageWaitMinutes"), "AverageSatisfaction", "DepartmentName")


def q08_weekday_weekend(star: Star) -> DataFrame:
    fact = star.visits("VisitDate", "BillAmount")
    split = fact.groupBy(day_type(F.col("VisitDate")).alias("DayType"))
    split = split.agg(*(c.alias(n) for n, c in _sums("TotalVisits", "Revenue").items()))
    return split.select(
        "DayType", "TotalVisits", money(F.col("Revenue")).alias("TotalRevenueINR"),
        mean(F.col("Revenue"), F.col("TotalVisits"), "decimal(18,2)").alias("AverageBillINR"),
    ).orderBy(F.when(F.col("DayType") == "Weekday", 1).otherwise(2))


def q09_monthly_trend(star: Star) -> DataFrame:
    monthly = star.visits("VisitDate").groupBy(month_start(F.col("VisitDate")).alias("MonthStart"))
    monthly = monthly.agg(visits_count().alias("TotalVisits"))
    monthly = with_lag(monthly, ["TotalVisits"], 12, "MonthStart")
    growth = growth_percent(F.col("TotalVisits"), F.col("PriorTotalVisits"))
    return monthly.select(
        "MonthStart", "TotalVisits",
        running_total("TotalVisits", ["MonthStart"]).alias("CumulativeVisits"),
        growth.alias("YearOverYearVisitGrowthPercent"),
    ).orderBy("MonthStart")


def ranked_doctors(fact: DataFrame, doctors: DataFrame) -> DataFrame:
    """Doctors with enough visits, best ten ranks by exact averages, ties kept."""
    performance = fact.groupBy("DoctorID").agg(
        *(c.alias(n) for n, c in _sums("TotalVisits", "Scores", "Waits").items())
    )
    eligible = performance.filter(F.col("TotalVisits") >= MIN_RANKED_VISITS)
    n = F.col("TotalVisits")
    order = [exact_ratio(F.col("Scores"), n).desc(), exact_ratio(F.col("Waits"), n).asc(), n.desc()]
    best = top_with_ties(eligible, order, TOP_RANKS, "PerformanceRank")
    return join_dim(best, doctors.select("DoctorID", "DoctorName"), "DoctorID").select(
        "PerformanceRank", "DoctorID", "DoctorName", "TotalVisits",
        mean(F.col("Scores"), n).alias("AverageSatisfaction"),
        mean(F.col("Waits"), n).alias("AverageWaitMinutes"),
    ).orderBy("PerformanceRank", "DoctorID")


def q10_top_doctors(star: Star) -> DataFrame:
    return ranked_doctors(
        star.visits("DoctorID", "SatisfactionScore", "WaitTimeMinutes"), star.dims["doctor"]
    )


def q11_repeat_patients(star: Star) -> DataFrame:
    frequency = star.visits("PatientID").groupBy("PatientID").agg(visits_count().alias("TotalVisits"))
    totals = frequency.agg(
        visits_count().alias("DistinctPatients"),
        F.count_if(F.col("TotalVisits") >= REPEAT_VISITS).alias("RepeatPatients"),
        F.sum("TotalVisits").alias("TotalVisits"),
    )
    patients = F.col("DistinctPatients")
    return totals.select(
        "DistinctPatients", "RepeatPatients",
        percent(F.col("RepeatPatients"), patients).alias("RepeatPatientRatePercent"),
        mean(F.col("TotalVisits"), patients).alias("AverageVisitsPerPatient"),
    )


def q12_diagnosis_treatment(star: Star) -> DataFrame:
    counts = rollup_dim(
        star.visits("DiagnosisID", "TreatmentID"),
        [_dim(star, "diagnosis", "DiagnosisName"), _dim(star, "treatment", "TreatmentName")],
        ["DiagnosisName", "TreatmentName"], {"TreatmentCount": visits_count()},
    )
    top = top_with_ties(counts, [F.desc("TreatmentCount")], 1, "TreatmentRank", ["DiagnosisName"])
    return top.select("DiagnosisName", "TreatmentName", "TreatmentCount").orderBy(
        "DiagnosisName", "TreatmentName"
    )


QUERIES = {
    query.__name__: query
    for query in (
        q01_operating_kpis, q02_annual_growth, q03_doctor_patient_load, q04_payment_mix,
        q05_age_band, q06_department_rank, q07_department_service_risk, q08_weekday_weekend,
        q09_monthly_trend, q10_top_doctors, q11_repeat_patients, q12_diagnosis_treatment,
    )
}
