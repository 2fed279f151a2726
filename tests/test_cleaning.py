import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from visitlake.operators.relational import key_diff, map_values, row_counts, union_periods
from visitlake.plans import clean
from visitlake.sources.tables import SCHEMAS, VISIT_COLUMNS, literal_rows

BORN = dt.date(1990, 4, 1)
GOOD = ("P1", " abhay", "  PATEL ", "m", BORN, "Ahmedabad, Gujarat, India")


def raw_patients(spark, *changes):
    base = dict(zip(SCHEMAS["patient_raw"].fieldNames(), GOOD, strict=True))
    return spark.createDataFrame([{**base, **c} for c in changes], SCHEMAS["patient_raw"])


def alias(spark):
    return literal_rows(spark, ["Variant", "Canonical"], [("Chennnai", "Chennai")])


def test_clean_patient(spark):
    got = rows(clean.clean_patients(raw_patients(spark, {}), alias(spark)))
    assert got == [("P1", "Abhay Patel", "Male", BORN, "Ahmedabad", "Gujarat", "India")]


def test_gender_spellings(spark):
    spelled = [{"PatientID": str(i), "Gender": g} for i, g in enumerate(["m", " Female ", "MALE", "F", "X", None, ""])]
    got = clean.clean_patients(raw_patients(spark, *spelled), alias(spark))
    assert {r.PatientID: r.Gender for r in got.collect()} == {"0": "Male", "1": "Female", "2": "Male", "3": "Female"}


def test_alias_is_applied(spark):
    placed = raw_patients(
        spark, {"CityStateCountry": "Chennnai, Tamil Nadu, India"},
        {"PatientID": "P2", "CityStateCountry": " Chennai ,Tamil Nadu,India"},
    )
    assert {r.City for r in clean.clean_patients(placed, alias(spark)).collect()} == {"Chennai"}


def test_rejected_rows_are_reported(spark):
    bad = [
        {"PatientID": "a", "FirstName": "  "}, {"PatientID": "b", "LastName": None}, {"PatientID": "c", "Gender": "X"},
        {"PatientID": "d", "DOB": None}, {"PatientID": "e", "CityStateCountry": "A,B"},
        {"PatientID": "f", "CityStateCountry": "A,B,C,D"}, {"PatientID": "g", "CityStateCountry": None},
        {"PatientID": "dummy", **dict.fromkeys(SCHEMAS["patient_raw"].fieldNames()[1:])},
    ]
    raw = raw_patients(spark, {}, *bad)
    kept, rejected = clean.clean_patients(raw, alias(spark)), clean.rejected_patients(raw)
    assert kept.count() == 1
    reasons = {r.PatientID: r.Reasons for r in rejected.collect()}
    assert reasons["a"] == "blank first name" and reasons["f"] == "location is not three parts"
    assert reasons["dummy"].count(";") == 4 and len(reasons) == 8


def test_clean_departments(spark):
    raw = spark.createDataFrame(
        [("D1", "Dept- X", " Care ", " Cardiology "), ("D2", "Dept- ", None, None), ("D3", "Dept- ", "Care", "  ")],
        "DepartmentID string, DepartmentName string, DepartmentCategory string, Specialization string",
    )
    assert rows(clean.clean_departments(raw)) == [("D1", "Cardiology", "Care")]


def visit(visit_id, patient="P1", department="D1", date="2024-01-01", time="08:00:00", wait=10, doctor="A"):
    day = dt.date.fromisoformat(date)
    return (visit_id, patient, doctor, department, "X", "T", "M", day, time, day, None, None, 3, wait)


def consolidated(spark, *visits):
    frame = spark.createDataFrame(list(visits), SCHEMAS["visits"])
    half = len(visits) // 2
    parts = [spark.createDataFrame(list(part), SCHEMAS["visits"]) for part in (visits[:half], visits[half:])]
    shuffled = parts[1].select(*reversed(frame.columns))
    patients = spark.createDataFrame([("P1",), ("P2",)], "PatientID string")
    departments = spark.createDataFrame([("D1",)], "DepartmentID string")
    return clean.consolidate([parts[0], shuffled], patients, departments)


def test_latest_visit_wins(spark):
    got = consolidated(
        spark, visit("V1", date="2024-01-01", wait=1), visit("V1", date="2024-01-02", wait=2),
        visit("V1", date="2024-01-02", time="09:00:00", wait=3), visit("V1", date="2023-12-31", wait=4),
    )
    assert got.columns == VISIT_COLUMNS
    assert [(r.VisitID, r.WaitTimeMinutes) for r in got.collect()] == [("V1", 3)]


def test_full_ties_are_broken_by_the_other_columns(spark):
    one = [visit("V1", wait=5, doctor="A"), visit("V1", wait=7, doctor="B"), visit("V1", wait=6, doctor="B")]
    picks = {tuple((r.DoctorID, r.WaitTimeMinutes) for r in consolidated(spark, *order).collect())
             for order in (one, one[::-1], [one[1], one[0], one[2]])}
    assert picks == {(("B", 7),)}


def test_latest_version_pointing_nowhere_drops_the_visit(spark):
    got = consolidated(
        spark, visit("V1", patient="P1", date="2024-01-01"), visit("V1", patient="P9", date="2024-02-01"),
        visit("V2", department="D9"), visit("V3"),
    )
    assert [r.VisitID for r in got.collect()] == ["V3"]


def test_key_diff_collapses_repeats(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (3,), (3,), (3,)], "k int")
    assert rows(key_diff(left, right, ["k"])) == [(1, "left"), (3, "right")]


def test_row_counts_and_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("y", 2)], "t string, n int")
    assert rows(union_periods([a, b])) == [(1, "x"), (2, "y")]
    assert rows(row_counts({"a": a, "none": a.filter("false")})) == [("a", 1), ("none", 0)]


def test_unmapped_values_stay(spark):
    df = spark.createDataFrame([("Chennnai", 1), ("Delhi", 2), (None, 3)], "City string, n int")
    assert rows(map_values(df, "City", alias(spark)).orderBy("n")) == [(None, 3), ("Chennai", 1), ("Delhi", 2)]


def test_empty_input(spark):
    empty = raw_patients(spark, {}).filter(F.lit(False))
    assert clean.clean_patients(empty, alias(spark)).count() == 0
    assert clean.rejected_patients(empty).count() == 0
