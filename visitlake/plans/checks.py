"""The rules of the visit model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.functions.dates import month_start
from visitlake.operators.quality import (
    Rule, enforce, expected_counts, leftover_variants, profile, row_rules, soundalike_check, unique_key,
)
from visitlake.operators.relational import row_counts, union_periods
from visitlake.plans.crossfilter import Encoding
from visitlake.sources.star import DIMENSION_KEYS, Star
from visitlake.sources.tables import VISIT_COLUMNS


def measure_rules(start: str, end: str) -> list[Rule]:
    """Dates in range and in order, amounts and scores within their limits."""
    bill, insurance = F.col("BillAmount"), F.col("InsuranceAmount")
    return [
        Rule("visit not before the first day", F.col("VisitDate") < _date(start)),
        Rule("visit not after the last day", F.col("VisitDate") >= _date(end)),
        Rule("discharge after visit", F.col("DischargeDate") < F.col("VisitDate")),
        Rule("bill not negative", bill < 0),
        Rule("insurance not negative", insurance < 0),
        Rule("insurance within bill", insurance > bill),
        Rule("satisfaction 1 to 5", ~F.col("SatisfactionScore").between(1, 5)),
        Rule("wait not negative", F.col("WaitTimeMinutes") < 0),
    ]


def _date(text: str):
    return F.lit(text).cast("date")


def not_null_rules(columns: list[str]) -> list[Rule]:
    return [Rule(f"{c} present", F.col(c).isNull()) for c in columns]


def doctor_rules() -> list[Rule]:
    return [Rule("experience 0 to 60", ~F.col("ExperienceYears").between(0, 60))]


def patient_rules() -> list[Rule]:
    return [Rule("gender known", ~F.col("Gender").isin("Male", "Female"))]


def alias_rules() -> list[Rule]:
    return [Rule("alias differs from canonical", F.col("Variant") == F.col("Canonical"))]


def code_width_rules(coding: Encoding) -> list[Rule]:
    """Whether each value fits the code the encoded extract stores it in, by the encoder's own bounds."""
    return [
        Rule("month code", ~coding.month_fits(coding.month(F.col("VisitDate")))),
        Rule("wait code", ~coding.wait_fits(F.col("WaitTimeMinutes"))),
        Rule("bill code", ~coding.bill_fits(coding.bill(F.col("BillAmount")))),
    ]


def constraint_checks(star: Star, start: str, end: str) -> DataFrame:
    """Primary keys, foreign keys and checks of the consolidated fact, which is read once."""
    rules = [*measure_rules(start, end), *not_null_rules(["VisitID", *DIMENSION_KEYS.values()])]
    by_key = {DIMENSION_KEYS[name]: dim for name, dim in star.dims.items()}
    return union_periods([
        profile(star.visits(*VISIT_COLUMNS), "VisitID", rules, unique=True, dims=by_key),
        *(unique_key(dim, key, f"unique {key} in its dimension") for key, dim in by_key.items()),
    ])


def month_gaps(visits: DataFrame) -> DataFrame:
    """Months without a visit between the first and the last one. The prior-year
    comparison counts twelve rows back, which is a year only when there are none."""
    months = visits.filter("VisitDate is not null").select(month_start(F.col("VisitDate")).alias("_m")).distinct()
    span = months.agg(F.min("_m").alias("_a"), F.max("_m").alias("_b"), F.count(F.lit(1)).alias("_n"))
    length = F.coalesce(F.round(F.months_between("_b", "_a")).cast("bigint") + 1, F.lit(0))
    sample = F.when(length > F.col("_n"), F.concat_ws(" of ", F.col("_n"), length))
    return span.select(
        F.lit("months without a gap").alias("CheckID"), F.lit("error").alias("Severity"),
        (length - F.col("_n")).alias("Violations"), sample.alias("Sample"), (length == F.col("_n")).alias("Passed"),
    )


def unique_names(star: Star) -> DataFrame:
    """Names the queries group by; where two keys share one, their rows are merged."""
    names = {"department": "DepartmentName", "diagnosis": "DiagnosisName",
             "treatment": "TreatmentName", "payment": "PaymentMethod"}
    return union_periods([
        unique_key(star.dims[name], column, f"unique {column}") for name, column in names.items()
    ])


def run_checks(
    star: Star, alias: DataFrame, expected: DataFrame | None, start: str, end: str, fail: bool = False
) -> DataFrame:
    """Every check of the model in one table; raises when ``fail`` and one is broken.

    The fact and the dimensions should be stored tables: each check reads them anew.
    """
    patients = star.dims["patient"]
    checks = [
        constraint_checks(star, start, end),
        unique_names(star),
        month_gaps(star.visits("VisitDate")),
        row_rules(patients, patient_rules(), "PatientID"),
        row_rules(star.dims["doctor"], doctor_rules(), "DoctorID"),
        soundalike_check(patients, "City", "city spellings"),
        leftover_variants(patients, "City", alias, "city variants mapped"),
        row_rules(alias, alias_rules(), "Variant"),
    ]
    if expected is not None:
        counted = row_counts({"visits": star.visits("VisitID"), **star.dims})
        checks.append(expected_counts(counted, expected, "Dataset"))
    results = union_periods(checks)
    if fail:
        enforce(results)
    return results
