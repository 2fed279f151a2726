import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows
from visitlake.operators import quality
from visitlake.plans import checks
from visitlake.plans.crossfilter import Encoding, dictionaries, encode_facts
from visitlake.sources.star import DIMENSION_KEYS, Star
from visitlake.sources.tables import SCHEMAS, VISIT_COLUMNS, literal_rows


def visit(i, **changes):
    row = {
        "VisitID": f"V{i}", "PatientID": "P1", "DoctorID": "D1", "DepartmentID": "E1", "DiagnosisID": "X1",
        "TreatmentID": "T1", "PaymentMethodID": "M1", "VisitDate": dt.date(2024, 1, 5), "VisitTime": "08:00:00",
        "DischargeDate": dt.date(2024, 1, 5), "BillAmount": Decimal("100.00"), "InsuranceAmount": Decimal("100.00"),
        "SatisfactionScore": 5, "WaitTimeMinutes": 0,
    }
    return {**row, **changes}


def star(spark, visits, patients=None):
    one = lambda schema, row: spark.createDataFrame([row], SCHEMAS[schema])
    people = patients or [("P1", "A B", "Male", dt.date(1990, 1, 1), "Delhi", "S", "C")]
    return Star.of(
        spark.createDataFrame(visits, SCHEMAS["visits"]),
        patient=spark.createDataFrame(people, SCHEMAS["patient"]),
        doctor=one("doctor", ("D1", "Doc", "Male", 60)), department=one("department", ("E1", "Dep", "Cat")),
        diagnosis=one("diagnosis", ("X1", "Dx")), treatment=one("treatment", ("T1", "Tr")),
        payment=one("payment", ("M1", "Cash")),
    )


def alias(spark):
    return literal_rows(spark, ["Variant", "Canonical"], [("Chennnai", "Chennai")])


def broken(df):
    return {r.CheckID: (r.Violations, r.Sample) for r in df.collect() if not r.Passed}


def test_clean_data_passes_every_check(spark):
    expected = spark.createDataFrame([("visits", 1), ("patient", 1)], "Dataset string, RowCount bigint")
    results = checks.run_checks(star(spark, [visit(1)]), alias(spark), None, "2020-01-01", "2026-01-01", fail=True)
    assert broken(results) == {}
    counted = quality.expected_counts(expected, expected.withColumn("RowCount", expected.RowCount + 2), "Dataset")
    assert broken(counted) == {"rows patient": (2, "1 of 3"), "rows visits": (2, "1 of 3")}


@pytest.mark.parametrize("changes,check", [
    ({"VisitDate": dt.date(2019, 12, 31)}, "visit not before the first day"),
    ({"VisitDate": dt.date(2026, 1, 1), "DischargeDate": dt.date(2026, 1, 1)}, "visit not after the last day"),
    ({"DischargeDate": dt.date(2024, 1, 4)}, "discharge after visit"),
    ({"BillAmount": Decimal("-1.00"), "InsuranceAmount": Decimal("-1.00")}, "bill not negative"),
    ({"InsuranceAmount": Decimal("100.01")}, "insurance within bill"),
    ({"SatisfactionScore": 0}, "satisfaction 1 to 5"), ({"SatisfactionScore": 6}, "satisfaction 1 to 5"),
    ({"WaitTimeMinutes": -1}, "wait not negative"),
    ({"PatientID": "P9"}, "orphan PatientID"), ({"DoctorID": "D9"}, "orphan DoctorID"),
    ({"PaymentMethodID": "M9"}, "orphan PaymentMethodID"),
])
def test_each_broken_rule_is_found(spark, changes, check):
    results = checks.constraint_checks(star(spark, [visit(1), visit(2, **changes)]), "2020-01-01", "2026-01-01")
    found = broken(results)
    assert found[check][0] == 1
    with pytest.raises(quality.QualityError, match=check):
        quality.enforce(results)


def test_null_measures_count_as_fine_but_null_keys_do_not(spark):
    found = broken(checks.constraint_checks(
        star(spark, [visit(1, BillAmount=None, WaitTimeMinutes=None), visit(2, DoctorID=None)]), "2020-01-01", "2026-01-01"
    ))
    assert found == {"DoctorID present": (1, "V2"), "orphan DoctorID": (1, None)}


def test_duplicates_and_repeated_orphans(spark):
    found = broken(checks.constraint_checks(
        star(spark, [visit(1), visit(1), visit(2), visit(3, DepartmentID="E7"), visit(4, DepartmentID="E8"),
                     visit(5, DepartmentID="E8")]), "2020-01-01", "2026-01-01"))
    assert found == {"unique VisitID": (1, "V1"), "orphan DepartmentID": (3, "E7")}


def test_soundalikes(spark):
    people = [(f"P{i}", "A B", "Male", dt.date(1990, 1, 1), c, "S", "C")
              for i, c in enumerate(["Chennnai", "Chennai", "Chennai", "Delhi"])]
    s = star(spark, [visit(1)], people)
    assert rows(quality.soundalikes(s.dims["patient"], "City")) == [("C500", 2, "Chennai / Chennnai")]
    found = broken(checks.run_checks(s, alias(spark), None, "2020-01-01", "2026-01-01"))
    assert found["city spellings"] == (1, "Chennai / Chennnai")
    assert found["city variants mapped"] == (1, "Chennnai")


@pytest.mark.parametrize("name,code", [
    ("Ashcraft", "A261"), ("Tymczak", "T522"), ("Pfister", "P236"), ("Jackson", "J250"), ("Chennnai", "C500"),
])
def test_phonetic_code(spark, name, code):
    assert spark.range(1).select(F.soundex(F.lit(name))).first()[0] == code


def test_code_widths(spark):
    rules = checks.code_width_rules(Encoding(base_year=2020, months=72, bill_offset=3000, bill_bytes=2))
    visits = [
        visit(1, BillAmount=Decimal("3000.00")), visit(2, BillAmount=Decimal("2999.00")),
        visit(3, BillAmount=Decimal("68535.00")), visit(4, BillAmount=Decimal("68536.00")),
        visit(5, BillAmount=Decimal("5000.00"), WaitTimeMinutes=256),
        visit(6, BillAmount=Decimal("5000.00"), VisitDate=dt.date(2026, 1, 1)),
    ]
    found = broken(quality.row_rules(spark.createDataFrame(visits, SCHEMAS["visits"]), rules, "VisitID"))
    assert found == {"bill code": (2, "V2"), "wait code": (1, "V5"), "month code": (1, "V6")}


@pytest.mark.parametrize("coding", [Encoding(months=72), Encoding(months=400), Encoding(bill_bytes=3, bill_offset=0), Encoding(bill_bytes=1)])
def test_checks_and_encoder_draw_the_same_borders(spark, coding):
    top = 256**coding.bill_bytes - 1 + coding.bill_offset
    last = min(coding.months, 128) - 1
    day = lambda month: dt.date(coding.base_year + month // 12, month % 12 + 1, 1)
    good = {"VisitDate": day(0), "BillAmount": Decimal(coding.bill_offset), "WaitTimeMinutes": 0}
    for change in ({}, {"BillAmount": Decimal(top)}, {"BillAmount": Decimal(top + 1)}, {"BillAmount": Decimal(coding.bill_offset - 1)},
                   {"VisitDate": day(last)}, {"VisitDate": day(last + 1)}, {"VisitDate": dt.date(coding.base_year - 1, 12, 31)},
                   {"WaitTimeMinutes": 255}, {"WaitTimeMinutes": 256}, {"WaitTimeMinutes": -1}):
        s = star(spark, [visit(1, **{**good, **change})])
        fits = not broken(quality.row_rules(s.visits("VisitID", "VisitDate", "BillAmount", "WaitTimeMinutes"), checks.code_width_rules(coding), "VisitID"))
        try:
            encode_facts(s, dictionaries(s, coding), coding).collect()
            encoded = True
        except Exception as error:
            assert "VisitID" in str(error) or "visit V1" in str(error)
            encoded = False
        assert fits == encoded, change


def test_the_profile_equals_the_checks_taken_one_by_one(spark):
    rng = random.Random(5)
    pick = lambda *values: rng.choice(values)
    visits = [visit(rng.randrange(150), PatientID=pick("P1", "P2", None), DoctorID=pick("D1", "D7", "D8"), DepartmentID=pick("E1", None),
                    SatisfactionScore=pick(0, 3, 5, None), WaitTimeMinutes=pick(-4, 3), VisitDate=pick(dt.date(2019, 1, 1), dt.date(2024, 1, 5))) for _ in range(300)]
    visits += [visit("", VisitID=None), visit("", VisitID=None)]
    s = star(spark, visits)
    rules = [*checks.measure_rules("2020-01-01", "2026-01-01"), *checks.not_null_rules(["VisitID", "PatientID"])]
    dims = {DIMENSION_KEYS[name]: dim for name, dim in s.dims.items()}
    facts = s.visits(*VISIT_COLUMNS)
    want = rows(quality.row_rules(facts, rules, "VisitID")) + rows(quality.unique_key(facts, "VisitID", "unique VisitID"))
    for key, dim in dims.items():
        missing = facts.join(dim.select(key), key, "left_anti").agg(F.count(F.lit(1)), F.min(key)).first()
        want.append((f"orphan {key}", "error", missing[0], missing[1], missing[0] == 0))
    got = rows(quality.profile(facts, "VisitID", rules, unique=True, dims=dims))
    assert got == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))
    empty = rows(quality.profile(facts.limit(0), "VisitID", rules, unique=True, dims=dims))
    assert len(empty) == len(got) and all(r[2:] == (0, None, True) for r in empty)


def test_samples_of_numbers_are_the_smallest_number(spark):
    facts = spark.createDataFrame([(10, 100), (9, 100), (10, 20)], "id long, ref long")
    dim = spark.createDataFrame([(7,)], "ref long")
    got = {r.CheckID: (r.Violations, r.Sample) for r in quality.profile(facts, "id", [quality.Rule("low", F.col("id") > 0)], True, {"ref": dim}).collect()}
    assert got == {"low": (3, "9"), "unique id": (1, "10"), "orphan ref": (3, "20")}


def test_many_spellings_of_one_code(spark):
    """More than are shown, in more than one slice."""
    names = ["Chen" + "".join("aeiou"[i // 5**k % 5] for k in range(4)) for i in range(300)] + ["Delhi"]
    df = spark.createDataFrame([(n,) for n in names], "City string")
    row = quality.soundalikes(df, "City").filter("Code = 'C500'").first()
    same = sorted(set(names) - {"Delhi"})
    assert (row.Spellings, row.Collision) == (len(same), " / ".join(same[: quality.SHOWN]) + " / …")
    assert quality.spellings(df, "City").filter("Code = 'C500'").count() == len(same)
    plan = plan_of(quality.soundalikes(df, "City")).split("== Physical Plan ==")[1]
    assert plan.index("collect_list") < plan.index("WindowGroupLimit")


def test_warnings_do_not_stop_a_run(spark):
    df = spark.createDataFrame([visit(1)], SCHEMAS["visits"])
    results = quality.row_rules(df, [quality.Rule("odd wait", F.col("WaitTimeMinutes") == 0, "warning")], "VisitID")
    assert broken(results) == {"odd wait": (1, "V1")}
    quality.enforce(results)


def test_month_gaps(spark):
    days = spark.sql("SELECT explode(array(date'2023-11-30', date'2024-01-01', date'2024-01-31', date'2024-04-01')) AS VisitDate")
    assert broken(checks.month_gaps(days)) == {"months without a gap": (3, "3 of 6")}
    assert broken(checks.month_gaps(days.filter("VisitDate < date'2023-12-01'"))) == {}
    assert broken(checks.month_gaps(days.filter("false"))) == {}


def test_entries_of_a_profile_are_hashed_once_and_join_nothing(spark):
    """Keys of a fact and of its dimensions meet in one hash grouping, whole numbers as numbers."""
    facts = spark.createDataFrame([(1, 5, 7, None), (1, 5, 8, "a"), (2, 2**60 + 1, 10, "b"), (None, None, 9, "b")], "id long, big long, few int, name string")
    dims = {"big": spark.createDataFrame([(2**60,), (5,), (None,)], "big long"),
            "few": spark.createDataFrame([("7",), ("07",)], "few string"), "name": spark.createDataFrame([("b",), ("b",), (None,)], "name string")}
    found = quality.profile(facts, "id", [quality.Rule("low", F.col("few") > 7)], True, dims)
    got = {r.CheckID: (r.Violations, r.Sample) for r in found.collect()}
    assert got == {"low": (3, "1"), "unique id": (1, "1"), "orphan big": (2, str(2**60 + 1)), "orphan few": (3, "8"), "orphan name": (2, "a")}
    plan = plan_of(found).split("== Physical Plan ==")[1]
    assert "HashAggregate(keys=[_check" in plan and "_text" not in "".join(line for line in plan.splitlines() if "Join" in line)
