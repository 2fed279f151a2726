"""Random cases against plain Python."""

import calendar
import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.test_measures import VISITS, visit
from visitlake.functions import dates, numbers
from visitlake.oracle import SQL
from visitlake.operators.windows import dedupe_latest
from visitlake.plans import crossfilter
from visitlake.plans.generate import generate_visits
from visitlake.plans.measures import evaluate
from visitlake.plans.reconcile import reconcile
from visitlake.sources.star import Star
from visitlake.sources.tables import SCHEMAS


def half_up(value: Fraction, places: int) -> Decimal:
    scaled = abs(value) * 10**places
    whole = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return Decimal(whole if value >= 0 else -whole).scaleb(-places)


def test_ratio(spark):
    rng = random.Random(11)
    cases = [(i, rng.randrange(-10**rng.randrange(1, 16), 10**15), rng.choice([0, 1, 2, 8, 400, 999, 10**9 + 7]) or 1) for i in range(1500)]
    df = spark.createDataFrame(cases, "i int, n bigint, d bigint")
    got = df.select("i", numbers.ratio(F.col("n"), F.col("d"), 2, "decimal(28,2)").alias("v")).collect()
    for row in got:
        _, n, d = cases[row.i]
        assert row.v == half_up(Fraction(n, d), 2), (n, d)


def test_age(spark):
    rng = random.Random(5)
    start = dt.date(1930, 1, 1)
    days = [start + dt.timedelta(days=rng.randrange(0, 36500)) for _ in range(1500)]
    days += [dt.date(y, 2, 29) for y in range(1932, 2020, 4)]
    cases = [(i, b, b + dt.timedelta(days=rng.choice([0, 364, 365, 366, 730, 1095, 1460, 1461, rng.randrange(0, 30000)])))
             for i, b in enumerate(days)]

    def birthday(born, year):
        last = calendar.monthrange(year, born.month)[1]
        return dt.date(year, born.month, min(born.day, last))

    df = spark.createDataFrame(cases, "i int, b date, d date")
    for row in df.select("i", dates.age_at(F.col("b"), F.col("d")).alias("v")).collect():
        _, born, day = cases[row.i]
        assert row.v == day.year - born.year - (birthday(born, day.year) > day), (born, day)


def test_dedupe_with_a_hot_key(spark):
    rng = random.Random(2)
    data = [(rng.choice(["hot", f"k{rng.randrange(40)}"]), rng.randrange(5), rng.randrange(3), rng.randrange(3)) for _ in range(4000)]
    best = defaultdict(tuple)
    for k, d, t, x in data:
        best[k] = max(best[k], (d, t, x))
    df = spark.createDataFrame(data, "k string, d int, t int, x int").repartition(9)
    assert {r.k: (r.d, r.t, r.x) for r in dedupe_latest(df, "k", ["d", "t"]).collect()} == dict(best)


def test_generated_rows_past_32_bits(spark):
    rng = random.Random(8)
    ns = sorted({*rng.sample(range(1, 50_001), 400), 1, 486, 487, 5000, 5001, 37500, 37501, 50000, 271_182, 300_000, 5_000_000, 10**9})
    source = f"SELECT unnest({ns}::BIGINT[]) AS n"
    sql = SQL["gen_visits"].replace("SELECT o_orderkey + 1 AS n FROM orders", source)
    assert source in sql
    cursor = duckdb.connect().execute(sql)
    columns = [c[0] for c in cursor.description]
    df = generate_visits(spark.createDataFrame([(n,) for n in ns], "n bigint")).select(*columns)
    assert sorted(map(tuple, df.collect())) == sorted(cursor.fetchall())


DIMENSION = {
    "E1": ("Heart", "Inner"), "E2": ("Lung", "Inner"), "E3": ("Bone", "Outer"), "E4": ("Skin", "Outer"),
}
PAY = {"M1": "Cash", "M2": "Card"}


@pytest.fixture(scope="module")
def crowd(spark):
    rng = random.Random(21)
    visits = list(VISITS)
    for i in range(100, 500):
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(0, 1400))
        patient = "P1" if rng.random() < 0.4 else f"P{rng.randrange(2, 30)}"
        visits.append(visit(i, day.isoformat(), patient, f"D{rng.randrange(1, 4)}", rng.choice(list(DIMENSION)),
                            rng.choice(list(PAY)), rng.randrange(10, 900), rng.randrange(5, 90), rng.randrange(1, 6)))
    make = lambda name, data: spark.createDataFrame(data, SCHEMAS[name])
    star = Star.of(
        make("visits", visits).cache(),
        patient=make("patient", [(f"P{i}", "A B", "Male", dt.date(1940 + 3 * i, 2, 28), "X", "Y", "Z") for i in range(1, 30)]),
        doctor=make("doctor", [(f"D{i}", f"Doc {i}", "Male", i) for i in range(1, 4)]),
        department=make("department", [(k, *v) for k, v in DIMENSION.items()]),
        diagnosis=make("diagnosis", [("X1", "Dx")]), treatment=make("treatment", [("T1", "Tr")]),
        payment=make("payment", list(PAY.items())),
    )
    flat = []
    for v in visits:
        name, category = DIMENSION[v[3]]
        flat.append({"Year": v[7].year, "DepartmentName": name, "DepartmentCategory": category, "PaymentMethod": PAY[v[6]],
                     "DayType": "Weekend" if v[7].weekday() >= 5 else "Weekday", "PatientID": v[1], "bill": v[10], "wait": v[13]})
    return star, flat


def inside(row, filters):
    return all(not kept or row[c] in kept for c, kept in filters.items())


CONTEXTS = [
    (["Year"], {}), (["Year", "PaymentMethod"], {"DayType": ["Weekday"]}), (["PaymentMethod"], {"Year": [2021, 2022]}),
    (["DepartmentCategory", "DepartmentName"], {"DepartmentName": ["Heart", "Bone"], "Year": [2022]}),
    (["DepartmentCategory", "DepartmentName", "Year"], {"DepartmentCategory": ["Inner"]}), ([], {"Year": [2022]}),
]


@pytest.mark.parametrize("by,filters", CONTEXTS)
def test_filter_contexts(crowd, by, filters):
    star, flat = crowd
    measures = ["TotalVisits", "TotalRevenue", "DistinctPatients", "RepeatPatients", "VisitsLY", "RevenueShareRatio",
                "CategoryRevenueShareRatio"]
    got = {tuple(r[c] for c in by): tuple(r[m] for m in measures) for r in evaluate(star, measures, by, filters).collect()}
    kept = [r for r in flat if inside(r, filters)]
    selected = sum(r["bill"] for r in kept)
    want = {}
    for key in {tuple(r[c] for c in by) for r in kept}:
        context = dict(zip(by, key, strict=True))
        rows = [r for r in kept if all(r[c] == v for c, v in context.items())]
        patients = Counter(r["PatientID"] for r in rows)
        year = context.get("Year", filters["Year"][0] if len(filters.get("Year", [])) == 1 else None)
        undated = {c: v for c, v in filters.items() if c not in ("Year", "DayType")}
        prior = sum(inside(r, undated) and r["Year"] == (year or 0) - 1
                    and all(r[c] == v for c, v in context.items() if c != "Year") for r in flat)
        wide = {c: v for c, v in filters.items() if c != "DepartmentName"}
        peers = sum(r["bill"] for r in flat if inside(r, wide)
                    and all(r[c] == v for c, v in context.items() if c != "DepartmentName"))
        revenue = sum(r["bill"] for r in rows)
        want[key] = (len(rows), revenue, len(patients), sum(n > 1 for n in patients.values()), prior or None,
                     half_up(Fraction(revenue) / Fraction(selected), 6), half_up(Fraction(revenue) / Fraction(peers), 6))
    assert got == want


@pytest.mark.parametrize("filters", [{}, {"Year": [2021], "PaymentMethod": ["Card"]}, {"DayType": ["Weekend"], "DepartmentName": ["Lung", "Skin"]}])
def test_crossfilter_members(crowd, filters):
    star, flat = crowd
    kept = [r for r in flat if inside(r, filters)]
    bundle = crossfilter.crossfilter(star, filters).collect()
    for facet, column in (("department", "DepartmentName"), ("payment", "PaymentMethod")):
        assert {r.Member: r.Visits for r in bundle if r.Facet == facet} == Counter(r[column] for r in kept)
    (total,) = [r for r in bundle if r.Facet == "total"]
    patients = Counter(r["PatientID"] for r in kept)
    assert (total.Visits, total.Patients, total.WaitMinutes) == (len(kept), len(patients), sum(r["wait"] for r in kept))
    assert total.RepeatPatients == sum(n > 1 for n in patients.values())


def test_reconcile_counts_every_difference(spark):
    rng = random.Random(4)
    left = [(i, rng.choice("ab"), rng.randrange(3)) for i in range(300)]
    right = [(i, rng.choice("ab") if rng.random() < 0.2 else a, n) for i, a, n in left if rng.random() > 0.1]
    other = {i: a for i, a, _ in right}
    schema = "k int, a string, n int"
    got = reconcile(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"])
    want = {(str(i), "(row)") if i not in other else (str(i), "a") for i, a, _ in left if other.get(i) != a}
    assert {(r.k, r.Column) for r in got.collect()} == want


def test_age_band_by_birthdays_equals_age_band_by_age(spark):
    rng = random.Random(17)
    born = [dt.date(1930, 1, 1) + dt.timedelta(days=rng.randrange(0, 30000)) for _ in range(600)] + [dt.date(1984, 2, 29)] * 40
    people = [(f"P{i}", "A B", "Male", b, "X", "Y", "Z") for i, b in enumerate(born)]
    visits = []
    for i, b in enumerate(born):
        year = b.year + rng.choice([17, 18, 19, 35, 36, 55, 56, 60])
        day = dt.date(year, b.month, min(b.day, 28)) + dt.timedelta(days=rng.randrange(-1, 3))
        visits.append(visit(i, day.isoformat(), f"P{i}"))
    visits.append(visit(9999, "2020-01-01", "unknown"))
    star = Star.of(spark.createDataFrame(visits, SCHEMAS["visits"]), patient=spark.createDataFrame(people, SCHEMAS["patient"]))
    short = {r.VisitID: (r.AgeBand, r.AgeBandOrder) for r in star.flat("VisitID", "AgeBand", "AgeBandOrder").collect()}
    full = {r.VisitID: (r.AgeBand, r.AgeBandOrder) for r in star.flat("VisitID", "AgeAtVisit", "AgeBand", "AgeBandOrder").collect()}
    assert short == full and len(short) == len(visits)
