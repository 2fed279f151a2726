"""Deterministic synthetic visits: every column is arithmetic on the visit number, so the
job is a map without a shuffle and runs at any row count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from visitlake.functions.bands import WAIT_SCORES, banded
from visitlake.functions.dates import clock_text, in_period, is_weekend
from visitlake.functions.text import padded_key
from visitlake.sources.tables import VISIT_COLUMNS

# The last visit number of each year out of 50,000 visits, and the
# half-open date ranges of the period tables.
BASE_VISITS = 50_000
YEAR_ENDS = [(5_000, 2020), (11_000, 2021), (18_500, 2022), (27_000, 2023), (37_500, 2024), (50_000, 2025)]
PERIODS = [
    ("2020-2021", "2020-01-01", "2022-01-01"),
    ("2022-2023", "2022-01-01", "2024-01-01"),
    ("2024", "2024-01-01", "2025-01-01"),
    ("2025", "2025-01-01", "2026-01-01"),
]
# The two departments with their own volume, wait and price rules.
EMERGENCY, CARDIOLOGY = 20, 1
PATIENTS_SEEN_ONCE, PATIENTS_RETURNING = 486, 1945
BASE_PRICE, EMERGENCY_SURCHARGE = 2_500, 9_000
DOCTORS, DEPARTMENTS, DIAGNOSES, TREATMENTS, PAYMENT_METHODS = 200, 33, 40, 30, 4


def numbers(spark: SparkSession, visits: int) -> DataFrame:
    return spark.range(1, visits + 1).select(F.col("id").alias("n"))


def _div(value: Column, by: int) -> Column:
    return ((value - value % by) / by).cast("bigint")


def _cycle(value: Column, length: int) -> Column:
    return value % length + 1


def _year_ends(total: int) -> list[tuple[int, int]]:
    return [(end * total // BASE_VISITS, year) for end, year in YEAR_ENDS]


def generate_visits(numbers: DataFrame, total: int = BASE_VISITS) -> DataFrame:
    """The 14 visit columns for the visit numbers in ``n`` (1-based).

    The yearly volumes keep their proportions when ``total`` differs from 50,000; numbers
    past ``total`` belong to the last year. Arithmetic is in 64 bits.
    """
    n = F.col("n").cast("bigint")
    ends = _year_ends(total)
    year, start = F, F
    for (end, label), (previous, _) in zip(ends[:-1], [(0, None), *ends[:-2]], strict=True):
        year, start = year.when(n <= end, label), start.when(n <= end, previous)
    year, start = year.otherwise(ends[-1][1]), start.otherwise(ends[-2][0])
    df = numbers.select(n.alias("n"), year.alias("_year"), (n - 1 - start).alias("_seq"))

    seq, n = F.col("_seq"), F.col("n")
    leap_days = F.when(F.col("_year").isin(2020, 2024), 366).otherwise(365)
    day = ((seq * 37 + _div(seq, 7) * 11) % leap_days).cast("int")
    slot = n % 20
    df = df.select(
        "n",
        F.date_add(F.make_date(F.col("_year"), F.lit(1), F.lit(1)), day).alias("VisitDate"),
        F.when(n <= PATIENTS_SEEN_ONCE, n)
        .otherwise(PATIENTS_SEEN_ONCE + _cycle(n * 37 + _div(n, 11) * 17, PATIENTS_RETURNING))
        .alias("_patient"),
        _cycle(n * 29 + _div(n, 13) * 7, DOCTORS).alias("_doctor"),
        F.when(slot <= 2, EMERGENCY)
        .when(slot <= 4, CARDIOLOGY)
        .otherwise(_cycle(n * 17 + _div(n, 7) * 5, DEPARTMENTS))
        .alias("_department"),
        _cycle(n * 7 + _div(n, 9) * 3, PAYMENT_METHODS).alias("_payment"),
    )

    department, emergency = F.col("_department"), F.col("_department") == EMERGENCY
    df = df.withColumn("_diagnosis", _cycle(n * 11 + department * 3 + _div(n, 17), DIAGNOSES))
    df = df.withColumn(
        "_treatment",
        F.when(n % 10 <= 6, _cycle(F.col("_diagnosis") - 1, TREATMENTS))
        .otherwise(_cycle(n * 13 + department, TREATMENTS)),
    )
    typical_wait = (
        F.when(emergency, 50).when(department == CARDIOLOGY, 24).otherwise((department % 7) * 4 + 12)
    )
    weekend_wait = F.when(is_weekend(F.col("VisitDate")), 8).otherwise(0)
    df = df.withColumn("WaitTimeMinutes", (typical_wait + (n * 17) % 31 + weekend_wait).cast("int"))
    price = (
        department * 475 + F.col("_treatment") * 190 + (n * 7919) % 35000
        + BASE_PRICE + F.when(emergency, EMERGENCY_SURCHARGE).otherwise(0)
    )
    df = df.withColumn("BillAmount", price.cast("decimal(18,2)"))

    covered = F.when(n % 5 == 0, 0).otherwise(n % 51 + 25).cast("decimal(4,0)")
    stay = F.when(emergency, n % 5 + 1).otherwise(n % 3).cast("int")
    return df.select(
        padded_key("V", n, 6).alias("VisitID"),
        padded_key("P", F.col("_patient"), 4).alias("PatientID"),
        padded_key("D", F.col("_doctor"), 3).alias("DoctorID"),
        padded_key("DEP", department, 2).alias("DepartmentID"),
        padded_key("DX", F.col("_diagnosis"), 2).alias("DiagnosisID"),
        padded_key("TR", F.col("_treatment"), 2).alias("TreatmentID"),
        padded_key("PM", F.col("_payment"), 2).alias("PaymentMethodID"),
        "VisitDate",
        clock_text((n * 7) % 14 + 7, (n * 13) % 60, (n * 19) % 60).alias("VisitTime"),
        F.date_add("VisitDate", stay).alias("DischargeDate"),
        "BillAmount",
        (F.col("BillAmount") * covered * F.lit("0.01").cast("decimal(3,2)"))
        .cast("decimal(18,2)").alias("InsuranceAmount"),
        banded(F.col("WaitTimeMinutes"), WAIT_SCORES).alias("SatisfactionScore"),
        "WaitTimeMinutes",
    ).select(*VISIT_COLUMNS)


def with_period(df: DataFrame, date_column: str, ranges: list[tuple[str, str, str]]) -> DataFrame:
    """Routes each row to its half-open period in one pass; rows outside stay NULL."""
    period = F
    for label, start, end in ranges:
        period = period.when(in_period(F.col(date_column), _date(start), _date(end)), label)
    return df.withColumn("Period", period)


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


OUTSIDE = "outside"


def split_by_period(df: DataFrame, date_column: str, ranges, path: str) -> int:
    """Writes one Parquet folder per period, and rows outside every range to a folder of
    their own; returns how many those are, so that a caller can stop on them."""
    counted = Observation()
    routed = with_period(df, date_column, ranges).withColumn("Period", F.coalesce("Period", F.lit(OUTSIDE)))
    routed = routed.observe(counted, F.count_if(F.col("Period") == OUTSIDE).alias("outside"))
    routed.write.mode("overwrite").partitionBy("Period").parquet(path)
    return counted.get["outside"]
