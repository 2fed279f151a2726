"""The whole run: stage, clean, consolidate, check, analyse, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.plans.analysis import QUERIES
from visitlake.plans.checks import run_checks
from visitlake.plans.clean import clean_departments, clean_patients, consolidate
from visitlake.plans.generate import PERIODS, generate_visits, numbers, split_by_period
from visitlake.session import stored
from visitlake.sources.exports import export_all, model_table, write_manifest
from visitlake.sources.star import Star, with_doctor_names
from visitlake.sources.tables import VISIT_COLUMNS


def build(spark: SparkSession, raw: dict[str, DataFrame], alias: DataFrame, visits: int, folder: str) -> Star:
    """``raw`` holds patient, department, doctor, diagnosis, treatment and payment tables."""
    outside = split_by_period(generate_visits(numbers(spark, visits), visits), "VisitDate", PERIODS, f"{folder}/staging")
    if outside:
        raise RuntimeError(f"{outside} visits fall outside every period")
    staging = spark.read.parquet(f"{folder}/staging")
    dims = {
        "patient": stored(clean_patients(raw["patient"], alias), f"{folder}/patient"),
        "department": stored(clean_departments(raw["department"]), f"{folder}/department"),
        "doctor": with_doctor_names(raw["doctor"]),
        **{name: raw[name] for name in ("diagnosis", "treatment", "payment")},
    }
    periods = [staging.filter(F.col("Period") == label).drop("Period") for label, _, _ in PERIODS]
    fact = stored(consolidate(periods, dims["patient"], dims["department"]), f"{folder}/visits")
    return Star.of(fact, **dims)


def run(
    spark: SparkSession, raw: dict[str, DataFrame], alias: DataFrame, expected: DataFrame,
    visits: int, folder: str, source: str,
) -> DataFrame:
    """Builds the star, stops on a broken rule, exports model tables and query results,
    and returns the manifest."""
    star = build(spark, raw, alias, visits, folder)
    run_checks(star, alias, expected, PERIODS[0][1], PERIODS[-1][2], fail=True)
    results = {f"dim_{name}": model_table(dim, name) for name, dim in star.dims.items()}
    results["fact_visits"] = model_table(star.visits(*VISIT_COLUMNS), "visits")
    results.update({name: query(star) for name, query in QUERIES.items()})
    manifest = export_all(results, f"{folder}/exports", source)
    write_manifest(manifest, f"{folder}/manifest")
    return manifest
