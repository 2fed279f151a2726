"""The generated dataset against its published figures."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from visitlake.plans.analysis import QUERIES
from visitlake.plans.generate import PERIODS, generate_visits, numbers, split_by_period, with_period
from visitlake.plans.measures import evaluate
from visitlake.plans.reconcile import acceptance_figures, date_shift_growth
from visitlake.sources.star import Star
from visitlake.sources.tables import SCHEMAS

VISITS = 50_000


def keyed(spark, count, prefix, width, id_column, **names):
    key = F.concat(F.lit(prefix), F.lpad((F.col("id") + 1).cast("string"), width, "0"))
    return spark.range(count).select(key.alias(id_column), *(c.alias(n) for n, c in names.items()))


@pytest.fixture(scope="module")
def star(spark):
    visits = generate_visits(numbers(spark, VISITS)).cache()
    return Star.of(
        visits,
        patient=keyed(spark, 2431, "P", 4, "PatientID", DOB=F.make_date(F.lit(1960), F.lit(1), F.lit(1))),
        doctor=keyed(spark, 200, "D", 3, "DoctorID", DoctorName=F.concat(F.lit("Doctor "), F.col("id") + 1)),
        department=keyed(
            spark, 33, "DEP", 2, "DepartmentID", DepartmentName=F.concat(F.lit("Dep "), F.col("id") + 1),
            DepartmentCategory=F.concat(F.lit("Cat "), F.col("id") % 6),
        ),
        diagnosis=keyed(spark, 40, "DX", 2, "DiagnosisID", DiagnosisName=F.concat(F.lit("Dx "), F.col("id") + 1)),
        treatment=keyed(spark, 30, "TR", 2, "TreatmentID", TreatmentName=F.concat(F.lit("Tr "), F.col("id") + 1)),
        payment=keyed(spark, 4, "PM", 2, "PaymentMethodID", PaymentMethod=F.concat(F.lit("Pay "), F.col("id") + 1)),
    )


def test_schema_is_the_declared_one(star):
    declared = [(f.name, f.dataType) for f in SCHEMAS["visits"]]
    built = star.visits(*SCHEMAS["visits"].fieldNames())
    assert [(f.name, f.dataType) for f in built.schema] == declared


def test_kpis(star):
    (row,) = rows(QUERIES["q01_operating_kpis"](star))
    want = (50000, 2431, "1584479195.00", "31689.58", "45.69", "3.16")
    assert tuple(map(str, row)) == tuple(map(str, want))


def test_annual_growth(star):
    got = [(r.VisitYear, r.TotalVisits, str(r.TotalRevenueINR), str(r.VisitGrowthPercent), str(r.RevenueGrowthPercent))
           for r in QUERIES["q02_annual_growth"](star).collect()]
    assert got == [
        (2020, 5000, "158088435.00", "None", "None"), (2021, 6000, "190252715.00", "20.00", "20.35"),
        (2022, 7500, "237813455.00", "25.00", "25.00"), (2023, 8500, "269308205.00", "13.33", "13.24"),
        (2024, 10500, "332779790.00", "23.53", "23.57"), (2025, 12500, "396236595.00", "19.05", "19.07"),
    ]


def test_top_doctors_keep_ties(star):
    got = [(r.PerformanceRank, r.DoctorID, r.TotalVisits, str(r.AverageSatisfaction), str(r.AverageWaitMinutes))
           for r in QUERIES["q10_top_doctors"](star).collect()]
    assert got == [
        (1, "D132", 154, "3.47", "41.43"), (2, "D058", 154, "3.47", "41.05"), (3, "D151", 154, "3.47", "41.51"),
        (4, "D077", 308, "3.46", "41.58"), (5, "D071", 154, "3.45", "41.71"), (6, "D098", 154, "3.45", "41.73"),
        (6, "D119", 154, "3.45", "41.73"), (7, "D010", 153, "3.44", "41.50"), (8, "D073", 308, "3.44", "41.57"),
        (9, "D056", 308, "3.44", "41.61"), (10, "D159", 154, "3.43", "41.58"),
    ]


def test_departments(star):
    service = {r.DepartmentName: r for r in QUERIES["q07_department_service_risk"](star).collect()}
    assert (service["Dep 20"].TotalVisits, str(service["Dep 20"].AverageWaitMinutes)) == (8638, "67.27")
    assert (service["Dep 1"].TotalVisits, str(service["Dep 1"].AverageWaitMinutes)) == (6135, "41.29")
    assert len(service) == 33


def test_weekdays_months_patients(star):
    days = {r.DayType: r.TotalVisits for r in QUERIES["q08_weekday_weekend"](star).collect()}
    assert days == {"Weekday": 35717, "Weekend": 14283}
    months = QUERIES["q09_monthly_trend"](star).collect()
    assert len(months) == 72 and months[-1].CumulativeVisits == VISITS
    assert [m.CumulativeVisits for m in months[:4]] == [434, 820, 1254, 1664]
    (row,) = rows(QUERIES["q11_repeat_patients"](star))
    assert tuple(map(str, row)) == ("2431", "1945", "80.01", "20.57")


def test_result_sizes(star):
    sizes = {name: query(star).count() for name, query in QUERIES.items()}
    assert sizes["q03_doctor_patient_load"] == 200 and sizes["q06_department_rank"] == 33
    assert sizes["q04_payment_mix"] == 4 and sizes["q12_diagnosis_treatment"] == 40


def test_measures(star):
    (row,) = evaluate(
        star, ["InsuranceCovered", "SeenWithin30", "SatisfiedVisits", "RepeatPatients", "ActiveDoctors", "WeekendVisits"]
    ).collect()
    assert row.InsuranceCovered == Decimal("625205809.70")
    assert (row.SeenWithin30, row.SatisfiedVisits, row.RepeatPatients) == (8247, 19821, 1945)
    assert (row.ActiveDoctors, row.WeekendVisits) == (200, 14283)


def test_acceptance_figures(star):
    figures = {r.Figure: r.Value for r in acceptance_figures(star).collect()}
    assert figures["Total Revenue"] == "₹1,584,479,195"
    assert figures["Average Bill"] == "₹31,689.58"
    assert figures["Insurance Covered"] == "₹625,205,809.70"
    assert figures["Seen Within 30 Min"] == "8,247 → 16.5%"
    assert figures["Repeat Patients"] == "1,945 → 80.0%"
    assert figures["Visit growth 2021"] == "20.00"
    assert figures["Longest wait"] == "Dep 20: 67.27 over 8,638 visits"
    assert (figures["Leaderboard rows"], figures["Departments"]) == ("11", "33")


def test_leap_day_trap(star):
    by_year = {r.VisitYear: r for r in date_shift_growth(star).collect()}
    assert by_year[2020].LeapDayVisits == 12
    assert str(by_year[2021].YearBucketGrowthPercent) == "20.00"
    assert str(by_year[2021].DateShiftGrowthPercent) == "20.29"


def test_periods(spark, star, tmp_path):
    path = str(tmp_path / "staging")
    split_by_period(star.visits("VisitID", "VisitDate"), "VisitDate", PERIODS, path)
    counts = {str(r.Period): r["count"] for r in spark.read.parquet(path).groupBy("Period").count().collect()}
    assert counts == {"2020-2021": 11000, "2022-2023": 16000, "2024": 10500, "2025": 12500}


def test_period_edges(spark):
    days = spark.sql("SELECT explode(array(date'2019-12-31', date'2020-01-01', date'2021-12-31', date'2022-01-01', date'2026-01-01')) AS VisitDate")
    got = [r.Period for r in with_period(days, "VisitDate", PERIODS).orderBy("VisitDate").collect()]
    assert got == [None, "2020-2021", "2020-2021", "2022-2023", None]


def test_scales_past_six_digits(spark):
    few = spark.sql("SELECT explode(array(1L, 999999L, 1000000L, 3000000000L)) AS n")
    got = [r.VisitID for r in generate_visits(few, 4_000_000_000).orderBy("VisitDate").collect()]
    assert sorted(got) == ["V000001", "V1000000", "V3000000000", "V999999"]


def test_larger_totals_keep_yearly_shares(spark):
    year = F.year("VisitDate")
    got = generate_visits(numbers(spark, 500_000), 500_000).groupBy(year.alias("y")).count()
    assert {r.y: r["count"] for r in got.collect()} == {
        2020: 50000, 2021: 60000, 2022: 75000, 2023: 85000, 2024: 105000, 2025: 125000
    }
