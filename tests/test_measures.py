"""Filter-context rules and cross-filter properties on a small, hand-checked star."""

import datetime as dt
from decimal import Decimal

import pytest

from tests.conftest import rows
from visitlake.plans import crossfilter
from visitlake.plans.analysis import QUERIES
from visitlake.plans.measures import MEASURES, calendar, evaluate
from visitlake.plans.summary import extremes, wait_tiers
from visitlake.sources.star import Star
from visitlake.sources.tables import SCHEMAS


def visit(i, day, patient="P1", doctor="D1", department="E1", pay="M1", bill=100, wait=20, score=4):
    date = dt.date.fromisoformat(day)
    return (f"V{i}", patient, doctor, department, "X1", "T1", pay, date, "08:00:00", date,
            Decimal(bill), Decimal(bill) / 4, score, wait)


VISITS = [
    visit(1, "2020-02-29", bill=100), visit(2, "2020-03-02", department="E2", bill=300, wait=31),
    visit(3, "2021-01-04", patient="P2", bill=50), visit(4, "2021-03-06", bill=70, doctor="D2", wait=60, score=1),
    visit(5, "2021-03-08", pay="M2", department="E3", bill=300, wait=30), visit(6, "2023-05-05", patient="P2", bill=10),
]


@pytest.fixture(scope="module")
def star(spark):
    make = lambda name, data: spark.createDataFrame(data, SCHEMAS[name])
    return Star.of(
        make("visits", VISITS),
        patient=make("patient", [
            ("P1", "A B", "Male", dt.date(1990, 3, 1), "Delhi", "S", "C"),
            ("P2", "C D", "Female", dt.date(2010, 1, 4), "Pune", "S", "C")]),
        doctor=make("doctor", [("D1", "Doc 1", "Male", 3), ("D2", "Doc 2", "Female", 4), ("D3", "Doc 3", "Male", 5)]),
        department=make("department", [("E1", "Heart", "Inner"), ("E2", "Lung", "Inner"), ("E3", "Bone", "Outer")]),
        diagnosis=make("diagnosis", [("X1", "Dx")]), treatment=make("treatment", [("T1", "Tr")]),
        payment=make("payment", [("M1", "Cash"), ("M2", "Card")]),
    )


def test_forty_measures():
    assert len(MEASURES) == 40


def test_every_measure_evaluates(star):
    row = evaluate(star, list(MEASURES)).first()
    assert row.TotalVisits == 6 and row.TotalRevenue == Decimal(830) and row.PatientPaid == Decimal("622.50")
    assert row.InsuranceCoverageRatio == Decimal("0.250000") and row.WaitBandColour == "#7CAE9E"
    assert row.VisitsLY is None and row.RevenueRankInCategory is None and row.DoctorPerformanceRank is None
    assert row.CumulativeVisits == 6 and row.RevenueShareRatio == 1
    assert row.FilterContextLabel == "6 visits selected  ·  100.0% of all visits"


def test_nothing_selected(star):
    row = evaluate(star, [m for m in MEASURES], [], {"PatientID": ["nobody"]}).first()
    assert (row.TotalVisits, row.DistinctPatients, row.RepeatPatients, row.SeenWithin30) == (0, 0, 0, 0)
    assert row.AverageBill is None and row.SatisfiedRatio is None and row.WaitBandColour == "#DEE6E3"
    assert row.RevenueLabel == "--"


def test_prior_year_is_the_whole_year_whatever_the_month(star):
    got = {r.MonthStart: (r.VisitsLY, r.RevenueLY) for r in evaluate(star, ["VisitsLY", "RevenueLY"], ["MonthStart"]).collect()}
    assert got[dt.date(2021, 1, 1)] == (2, Decimal(400)) and got[dt.date(2020, 2, 1)] == (None, None)
    assert got[dt.date(2023, 5, 1)] == (None, None)


def test_prior_year_ignores_date_slicers_and_keeps_others(star):
    by = evaluate(star, ["TotalVisits", "VisitsLY", "VisitGrowthRatio"], ["Year"], {"Year": [2021], "PaymentMethod": ["Cash"]})
    assert rows(by) == [(2021, 2, 2, Decimal("0.000000"))]
    one = evaluate(star, ["VisitsLY"], [], {"Year": [2021], "DayType": ["Weekend"]}).first()
    assert one.VisitsLY == 2
    two = evaluate(star, ["VisitsLY"], [], {"Year": [2020, 2021]}).first()
    assert two.VisitsLY is None


def test_running_totals_stay_inside_the_selection(star):
    got = rows(evaluate(star, ["CumulativeVisits", "CumulativeRevenue"], ["Year"], {"Year": [2021, 2023]}))
    assert got == [(2021, 3, Decimal(420)), (2023, 4, Decimal(430))]
    everything = evaluate(star, ["CumulativeVisits"], ["DayType"], {"Year": [2021, 2023]})
    assert max(r.CumulativeVisits for r in everything.collect()) == 4


def test_shares_are_of_the_selection(star):
    got = rows(evaluate(star, ["RevenueShareRatio", "VisitShareRatio"], ["PaymentMethod"], {"Year": [2021]}))
    assert got == [("Card", Decimal("0.714286"), Decimal("0.333333")), ("Cash", Decimal("0.285714"), Decimal("0.666667"))]


def test_category_share_ignores_the_department_slicer(star):
    by = ["DepartmentCategory", "DepartmentName"]
    got = rows(evaluate(star, ["RevenueRankInCategory", "CategoryRevenueShareRatio"], by, {"DepartmentName": ["Heart"]}))
    assert got == [("Inner", "Heart", 1, Decimal("0.433962"))]
    ranks = rows(evaluate(star, ["RevenueRankInCategory"], by))
    assert ranks == [("Inner", "Heart", 2), ("Inner", "Lung", 1), ("Outer", "Bone", 1)]


def test_patients_are_recounted_in_each_context(star):
    measures = ["DistinctPatients", "RepeatPatients", "VisitsPerPatient", "ActiveDoctors", "PatientsPerDoctor"]
    assert rows(evaluate(star, measures, ["Year"])) == [
        (2020, 1, 1, Decimal(2), 1, Decimal(1)), (2021, 2, 1, Decimal("1.500000"), 2, Decimal(1)),
        (2023, 1, 0, Decimal(1), 1, Decimal(1)),
    ]
    total = evaluate(star, measures).first()
    assert (total.DistinctPatients, total.RepeatPatients) == (2, 2)


def test_doctor_ranks_need_enough_visits(spark, star):
    many = [visit(i, "2021-01-04", doctor="D1", score=3, wait=10) for i in range(100)]
    many += [visit(i, "2021-01-04", doctor="D2", score=3, wait=20) for i in range(150)]
    many += [visit(i, "2021-01-04", doctor="D3", score=5) for i in range(99)]
    busy = Star.of(spark.createDataFrame(many, SCHEMAS["visits"]), **star.dims)
    got = rows(evaluate(busy, ["DoctorPerformanceRank", "DoctorRankKey", "DoctorPerformanceRankExact"], ["DoctorID"]))
    assert got == [
        ("D1", 1, Decimal("2.999900000"), 1), ("D2", 1, Decimal("2.999800000"), 2), ("D3", None, Decimal("4.999800000"), None)
    ]
    top = rows(QUERIES["q10_top_doctors"](busy).select("PerformanceRank", "DoctorID"))
    assert top == [(1, "D1"), (2, "D2")]


def test_calendar(spark):
    days = calendar(spark, "2020-01-01", "2025-12-31")
    assert days.count() == 2192
    leap = days.filter("Date = date'2020-02-29'").first()
    assert (leap.Year, leap.MonthName, leap.YearMonth, leap.DayName, leap.DayType) == (2020, "Feb", "2020-02", "Sat", "Weekend")


def test_flat_joins_only_what_is_asked(star):
    plan = star.flat("DepartmentName", "BillAmount")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    assert star.flat("Year", "WaitTimeMinutes")._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0


def test_facets_add_up_to_the_total(star):
    for filters in ({}, {"Year": [2021]}, {"DayType": ["Weekend"]}, {"DepartmentName": ["Heart"]}, {"AgeBand": ["0-17"]}):
        bundle = crossfilter.crossfilter(star, filters).collect()
        (total,) = [r for r in bundle if r.Facet == "total"]
        for facet in crossfilter.FACETS:
            members = [r for r in bundle if r.Facet == facet]
            assert sum(r.Visits for r in members) == total.Visits
            assert sum(r.Revenue for r in members) == total.Revenue
            assert sum(r.WaitMinutes for r in members) == total.WaitMinutes


def test_crossfilter_totals(star):
    total = crossfilter.crossfilter(star, {"Year": [2021]}).filter("Facet = 'total'").first()
    assert (total.Visits, total.Patients, total.RepeatPatients, total.Scores) == (3, 2, 1, 9)
    empty = crossfilter.crossfilter(star, {"Year": [1999]}).collect()
    assert len(empty) == 1 and empty[0].Visits == 0 and empty[0].Patients == 0


def test_an_empty_filter_list_keeps_everything(star):
    assert crossfilter.crossfilter(star, {"Year": [], "PaymentMethod": []}).filter("Facet='total'").first().Visits == 6


def test_payment_slices_partition_an_age_band(star):
    row = crossfilter.partition_check(star, "18-35").first()
    assert row.Agrees and row.BandVisits == 4 and row.Slices == 2


def test_encoding_round_trip(star):
    coding = crossfilter.Encoding(base_year=2020, bill_offset=0)
    codes = crossfilter.dictionaries(star, coding)
    encoded = crossfilter.encode_facts(star, codes, coding)
    by_id = {r.VisitID: r for r in encoded.collect()}
    assert (by_id["V1"].monthweek, by_id["V4"].monthweek, by_id["V5"].monthweek) == (1 | 0x80, 14 | 0x80, 14)
    assert (by_id["V5"].dept, by_id["V5"].pay, by_id["V4"].doctor, by_id["V3"].patient) == (2, 1, 1, 1)
    decoded = crossfilter.decode_facts(encoded, codes, coding)
    columns = ["VisitID", "MonthStart", "DayType", "DepartmentID", "PaymentMethodID", "DoctorID", "PatientID",
               "AgeBand", "SatisfactionScore", "WaitTimeMinutes", "BillAmount"]
    assert rows(decoded.select(*columns)) == rows(star.flat(*columns))
    meta = rows(crossfilter.extract_meta(star, codes, coding).filter("Dictionary = 'department'"))
    assert meta == [("department", 0, "Heart", "Inner"), ("department", 1, "Lung", "Inner"), ("department", 2, "Bone", "Outer")]


def test_percentiles_are_ordered(star):
    for r in crossfilter.wait_percentiles(star).collect():
        assert r.WaitP10 <= r.WaitP50 <= r.WaitP90


def test_summary(star):
    tiers = {r.DepartmentName: (r.WaitTier, r.WaitColour) for r in wait_tiers(star).collect()}
    assert tiers == {"Bone": (1, "#7CAE9E"), "Heart": (1, "#7CAE9E"), "Lung": (1, "#7CAE9E")}
    both = {r.Extreme: r.DepartmentName for r in extremes(star).collect()}
    assert both == {"longest": "Lung", "shortest": "Heart"}  # equal waits, lower satisfaction


def test_one_dimension_at_a_time(star):
    by_doctor = evaluate(star, ["TotalVisits", "AverageBill"], ["DoctorID", "DoctorName"])
    assert rows(by_doctor) == [("D1", "Doc 1", 5, Decimal("152.00")), ("D2", "Doc 2", 1, Decimal("70.00"))]
    inner = {"DepartmentCategory": ["Inner"], "DepartmentName": []}
    assert rows(evaluate(star, ["TotalVisits", "SatisfiedVisits"], ["DepartmentName"], inner)) == [("Heart", 4, 3), ("Lung", 1, 1)]
    assert rows(evaluate(star, ["TotalVisits", "TotalRevenue"], [], {"DepartmentName": ["Heart"]})) == [(4, Decimal(230))]
    assert rows(evaluate(star, ["TotalVisits", "TotalRevenue"], [], {"DepartmentName": ["None"]})) == [(0, None)]
    assert rows(evaluate(star, ["WeekendVisits"], ["DepartmentName"])) == [("Bone", 0), ("Heart", 2), ("Lung", 0)]


def test_null_groups_are_kept_apart(spark, star):
    lost = spark.createDataFrame([visit(1, "2021-01-04", department="E9"), visit(2, "2022-01-04", department="E9")], SCHEMAS["visits"])
    orphaned = Star.of(lost, **star.dims)
    got = rows(evaluate(orphaned, ["TotalVisits", "VisitsLY", "MedianWaitMinutes"], ["DepartmentName", "Year"]))
    assert got == [(None, 2021, 1, None, Decimal("20.00")), (None, 2022, 1, 1, Decimal("20.00"))]


def test_names_shared_by_two_keys_are_merged(spark, star):
    shared = spark.createDataFrame([("E1", "Heart", "Inner"), ("E2", "Heart", "Inner"), ("E3", "Bone", "Outer")], SCHEMAS["department"])
    merged = Star.of(star.visits(*SCHEMAS["visits"].fieldNames()), **{**star.dims, "department": shared})
    got = {r.DepartmentName: r.TotalVisits for r in QUERIES["q06_department_rank"](merged).collect()}
    assert got == {"Heart": 5, "Bone": 1}
