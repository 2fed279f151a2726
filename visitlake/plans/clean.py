"""Raw dimensions to clean ones, period tables to one fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions.text import (
    capitalised, full_name, location_parts, normalised_gender, not_blank, part_from_right,
)
from visitlake.operators.relational import keep_matching, map_values, union_periods
from visitlake.operators.windows import dedupe_latest
from visitlake.sources.tables import MODEL_COLUMNS, VISIT_COLUMNS

LOCATION_PARTS = 3


def has_three_parts(location: Column) -> Column:
    return F.size(location_parts(location)) == LOCATION_PARTS


def valid_patient() -> Column:
    return (
        not_blank(F.col("FirstName")) & not_blank(F.col("LastName"))
        & normalised_gender(F.col("Gender")).isNotNull()
        & F.col("DOB").isNotNull() & has_three_parts(F.col("CityStateCountry"))
    )


def clean_patients(raw: DataFrame, alias: DataFrame) -> DataFrame:
    location = F.col("CityStateCountry")
    cleaned = raw.filter(valid_patient()).select(
        "PatientID",
        full_name(capitalised(F.col("FirstName")), capitalised(F.col("LastName"))).alias("FullName"),
        normalised_gender(F.col("Gender")).alias("Gender"),
        "DOB",
        part_from_right(location, 3).alias("City"),
        part_from_right(location, 2).alias("State"),
        part_from_right(location, 1).alias("Country"),
    )
    return map_values(cleaned, "City", alias).select(*MODEL_COLUMNS["patient"])


def rejected_patients(raw: DataFrame) -> DataFrame:
    """The rows ``clean_patients`` leaves out, with every rule they break."""
    location = F.col("CityStateCountry")
    checks = {
        "blank first name": not_blank(F.col("FirstName")),
        "blank last name": not_blank(F.col("LastName")),
        "unknown gender": normalised_gender(F.col("Gender")).isNotNull(),
        "no birth date": F.col("DOB").isNotNull(),
        "location is not three parts": has_three_parts(location),
    }
    reasons = F.concat_ws("; ", *(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()))
    return raw.select("PatientID", reasons.alias("Reasons")).filter("Reasons <> ''")


def clean_departments(raw: DataFrame) -> DataFrame:
    kept = raw.filter(not_blank(F.col("Specialization")) & not_blank(F.col("DepartmentCategory")))
    return kept.select(
        "DepartmentID",
        F.trim("Specialization").alias("DepartmentName"),
        F.trim("DepartmentCategory").alias("DepartmentCategory"),
    )


def consolidate(staging: list[DataFrame], patients: DataFrame, departments: DataFrame) -> DataFrame:
    """One row per visit, the latest version, for known patients and departments only.

    De-duplication comes first: a visit whose latest version points nowhere is dropped,
    not replaced by an older version.
    """
    latest = dedupe_latest(union_periods(staging), "VisitID", ["VisitDate", "VisitTime"])
    known = keep_matching(latest, departments, "DepartmentID")
    return keep_matching(known, patients, "PatientID").select(*VISIT_COLUMNS)
