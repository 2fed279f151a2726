"""Input the test tables do not hold: cells, keys, dates and sizes at and beyond the limits."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.conftest import d, rows
from visitlake.functions import bands, numbers, text
from visitlake.operators.windows import dense_rank_by_value, small_index
from visitlake.plans import crossfilter
from visitlake.plans.generate import split_by_period
from visitlake.plans.measures import evaluate
from visitlake.sources import exports
from visitlake.sources.star import Star
from visitlake.sources.tables import SCHEMAS, read_export, read_table


def visit(number, patient="P1", doctor="D1", department="A1", day=dt.date(2021, 3, 5), bill="4000.00", wait=20, payment="PM1"):
    return (f"V{number}", patient, doctor, department, "X1", "T1", payment, day, "10:00:00", day, d(bill), d("0.00"), 4, wait)


def star_of(spark, visits):
    make = lambda name, data: spark.createDataFrame(data, SCHEMAS[name])
    born = dt.date(1980, 1, 1)
    return Star.of(
        make("visits", visits),
        patient=make("patient", [("P1", "A", "Male", born, "c", "s", "x"), ("P2", "B", "Male", None, "c", "s", "x")]),
        doctor=make("doctor", [("D1", "Ann", "Female", 3), ("D2", "Bob", "Male", 4), ("D3", "Eve", "Female", 5), ("D4", "Eve", "Female", 5)]),
        department=make("department", [("A1", "Heart", "Acute"), ("A2", "Lung", "Acute"), ("B1", "Skin", "Other")]),
        payment=make("payment", [("PM1", "Cash"), ("PM2", "Card")]),
    )


def encoded(star, **coding):
    chosen = replace(crossfilter.Encoding(), **coding)
    return crossfilter.encode_facts(star, crossfilter.dictionaries(star, chosen), chosen)


def test_encoder_holds_what_fits(spark):
    star = star_of(spark, [visit(1), visit(2, doctor="D2", department="B1", payment="PM2", day=dt.date(2020, 1, 4))])
    got = {r.VisitID: r for r in encoded(star).collect()}
    assert (got["V1"].monthweek, got["V1"].age, got["V1"].bill) == (14, 2, 1000) and got["V2"].monthweek == 128
    assert (got["V2"].dept, got["V2"].pay, got["V2"].doctor) == (2, 1, 1)


@pytest.mark.parametrize("bad, what", [
    ({"patient": "P9"}, "birth date|patient"), ({"patient": None}, "birth date|patient"), ({"patient": "P2"}, "birth date"),
    ({"doctor": "D9"}, "doctor"), ({"department": None}, "department"), ({"payment": "PM9"}, "payment"),
    ({"day": dt.date(2032, 1, 5)}, "month"), ({"day": dt.date(2019, 5, 6)}, "month"), ({"day": None}, "month|birth"),
    ({"wait": 256}, "wait"), ({"wait": None}, "wait"), ({"bill": "70000.00"}, "bill"), ({"bill": "2000.00"}, "bill"),
])
def test_encoder_stops_at_what_it_cannot_hold(spark, bad, what):
    with pytest.raises(Exception, match=f"V2: .*({what})"):
        encoded(star_of(spark, [visit(1), visit(2, **bad)])).collect()


def test_encoder_stops_at_too_many_keys(spark):
    with pytest.raises(Exception, match="more than 3 keys"):
        small_index(spark.range(4), ["id"], "code", 3).collect()
    assert small_index(spark.range(3), ["id"], "code", 3).count() == 3


def test_encoder_meets_each_dimension_once(spark):
    star = star_of(spark, [visit(1)])
    plan = encoded(star)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 4


def test_metadata_reads_no_large_dictionary(spark):
    codes = crossfilter.dictionaries(star_of(spark, [visit(1)]))
    meta = crossfilter.extract_meta(star_of(spark, [visit(1), visit(2)]), codes, source="here")
    found = {r.Name: (r.Code, r.Category) for r in meta.filter("Dictionary = 'extract'").collect()}
    assert found == {"rows": (2, None), "base year": (2020, None), "months": (72, None), "bill offset": (3000, None),
                     "patients": (2, None), "source": (None, "here")}
    assert "patient" not in codes._built


CELLS = [("plain", "a"), (" padded ", "\tb "), ("", None), (None, ""), ('say "hi", ok', "x,y"), ("two\nlines", "three\r\n\nof them"), ('"', "\\"), ("\\\"", "é ñ")]


def test_csv_keeps_every_cell(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i}", a) for i, (a, _) in enumerate(CELLS)] + [(f"m{i}", b) for i, (_, b) in enumerate(CELLS)], SCHEMAS["payment"])
    assert exports.export_csv(df, str(tmp_path / "cells")).rows == 2 * len(CELLS)
    assert rows(read_export(spark, str(tmp_path / "cells"), df.schema)) == rows(df)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_bytes("﻿PaymentMethod,more,PaymentMethodID\nCash,1,PM01\n\"say \"\"hi\"\", ok\",2,PM02\n".encode())
    got = read_table(spark, str(path), SCHEMAS["payment"], "csv")
    assert rows(got) == [("PM01", "Cash"), ("PM02", 'say "hi", ok')]
    with pytest.raises(ValueError, match="no column DoctorID"):
        read_table(spark, str(path), "DoctorID string", "csv")


def test_manifest_counts_what_was_written(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", "c")], SCHEMAS["payment"])
    assert exports.export_all({"one": df}, str(tmp_path), "s").first().RowCount == 1


def test_names_are_not_cut(spark):
    name = "x" * 60
    assert spark.range(1).select(text.capitalised(F.lit(name))).first()[0] == "X" + name[1:]


def test_growth_has_no_ceiling(spark):
    got = spark.range(1).select(numbers.growth_percent(F.lit(500_000_000).cast("bigint"), F.lit(3).cast("bigint"))).first()[0]
    assert str(got) == "16666666566.67"


def test_rows_outside_every_period_are_written_and_counted(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2020, 5, 1)), (2, dt.date(2031, 1, 1)), (3, None)], "id int, day date")
    assert split_by_period(df, "day", [("first", "2020-01-01", "2021-01-01")], str(tmp_path / "p")) == 2
    back = spark.read.parquet(str(tmp_path / "p"))
    assert {r.id: r.Period for r in back.collect()} == {1: "first", 2: "outside", 3: "outside"}


def test_no_birth_date_has_no_band(spark):
    star = star_of(spark, [visit(1), visit(2, patient="P2"), visit(3, patient=None)])
    for columns in (["AgeBand", "AgeBandOrder"], ["AgeBand", "AgeBandOrder", "AgeAtVisit"]):
        assert rows(star.flat("VisitID", *columns).select("VisitID", "AgeBand", "AgeBandOrder")) == [
            ("V1", "36-55", 3), ("V2", None, None), ("V3", None, None)]
    assert spark.range(1).select(bands.banded(F.lit(None).cast("int"), bands.WAIT_SCORES)).first()[0] is None


def test_running_totals_follow_the_calendar(spark):
    days = [dt.date(2020, 1, 31), dt.date(2020, 2, 28), dt.date(2020, 2, 29), dt.date(2021, 1, 4), dt.date(2021, 2, 1)]
    star = star_of(spark, [visit(i, day=day) for i, day in enumerate(days)])
    total = lambda *by: {tuple(r)[:-1]: r.CumulativeVisits for r in evaluate(star, ["CumulativeVisits"], list(by)).collect()}
    want = {(1, 2020): 1, (2, 2020): 3, (1, 2021): 4, (2, 2021): 5}
    assert total("MonthNumber", "Year") == want
    assert {(k[1].month, k[1].year): v for k, v in total("MonthName", "MonthStart").items()} == want
    assert total("DayType", "Year", "MonthNumber") == {
        ("Weekday", 2020, 1): 1, ("Weekday", 2020, 2): 2, ("Weekend", 2020, 2): 3, ("Weekday", 2021, 1): 4, ("Weekday", 2021, 2): 5}
    assert total("DayName") == {("Fri",): 5, ("Sat",): 5, ("Mon",): 5}


def test_department_ranks_by_any_name_of_a_department(spark):
    star = star_of(spark, [visit(1), visit(2, department="A2"), visit(3, department="A2"), visit(4, department="B1")])
    rank = lambda *by: {tuple(r)[:-1]: r.RevenueRankInCategory for r in evaluate(star, ["RevenueRankInCategory"], list(by)).collect()}
    assert rank("DepartmentName") == {("Heart",): 2, ("Lung",): 1, ("Skin",): 1}
    assert rank("DepartmentID") == {("A1",): 2, ("A2",): 1, ("B1",): 1}
    assert rank("DepartmentCategory", "DepartmentID") == {("Acute", "A1"): 2, ("Acute", "A2"): 1, ("Other", "B1"): 1}
    assert set(rank("DepartmentCategory").values()) == {None}


def test_doctor_ranks_by_name(spark):
    visits = [visit(f"{n}-{i}", doctor=f"D{n}", wait=10 * n) for n in (1, 2, 3, 4) for i in range(100)]
    got = {r.DoctorName: (r.DoctorPerformanceRank, r.DoctorPerformanceRankExact) for r in evaluate(
        star_of(spark, visits), ["DoctorPerformanceRank", "DoctorPerformanceRankExact"], ["DoctorName"]).collect()}
    assert got == {"Ann": (1, 1), "Bob": (1, 2), "Eve": (None, None)}


def test_missing_peers_are_peers_of_each_other(spark):
    df = spark.createDataFrame([(None, d("2")), (None, d("1")), ("a", d("1"))], "g string, v decimal(4,1)")
    got = dense_rank_by_value(df, "v", "r", 1000, ["g"])
    assert rows(got) == [("a", d("1.0"), 1), (None, d("1.0"), 2), (None, d("2.0"), 1)] or {tuple(r) for r in got.collect()} == {
        ("a", d("1.0"), 1), (None, d("1.0"), 2), (None, d("2.0"), 1)}


def test_prior_year_reads_the_years_before_only(spark, sf_dir):
    from visitlake.registry import REGISTRY

    plan = REGISTRY["m_yoy"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "o_orderdate" in line]
    assert pushed and any("1995-01-01" in line for line in pushed)
