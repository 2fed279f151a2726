import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from visitlake.operators.quality import QualityError
from visitlake.plans import pipeline, workloads
from visitlake.plans.generate import generate_visits, numbers
from visitlake.session import scratch_path
from visitlake.sources import exports
from visitlake.sources.tables import SCHEMAS, literal_rows, read_export, read_table


def test_byte_order_mark_is_harmless(spark, tmp_path):
    path = tmp_path / "dim.csv"
    path.write_bytes("﻿PaymentMethodID,PaymentMethod\nPM01,Cash\nPM02,\n".encode())
    got = read_export(spark, str(path), SCHEMAS["payment"])
    assert got.columns == ["PaymentMethodID", "PaymentMethod"]
    assert rows(got) == [("PM01", "Cash"), ("PM02", None)]


def test_csv_round_trip_keeps_types_nulls_and_quotes(spark, tmp_path):
    data = [("P1", 'O"Neil, x', "Male", dt.date(1990, 1, 1), None, "line", "C"), ("P2", "A", "Male", None, "", "S", "C")]
    df = spark.createDataFrame(data, SCHEMAS["patient"])
    back = exports.round_trip(spark, df, str(tmp_path / "p"))
    assert back.schema == df.schema
    assert rows(back) == rows(df)


def test_export_is_ordered_across_files(spark, tmp_path):
    df = spark.range(1000).select(F.format_string("P%04d", F.lit(999) - F.col("id")).alias("PaymentMethodID"), F.lit("x").alias("PaymentMethod"))
    exports.export_csv(exports.model_table(df, "payment"), str(tmp_path / "o"))
    parts = sorted((tmp_path / "o").glob("part-*.csv"))
    keys = [line.split(",")[0] for part in parts for line in part.read_text().splitlines()[1:]]
    assert keys == sorted(keys) and len(keys) == 1000


def test_save_as(spark):
    df = spark.createDataFrame([(1, "a")], "n int, t string")
    assert rows(exports.save_as(df, "saved_rows")) == [(1, "a")]
    spark.sql("DROP TABLE saved_rows")


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def raw_tables(spark, visits):
    """Raw dimensions covering the generated keys, with rows cleaning must drop."""
    number = F.col("id") + 1
    key = lambda prefix, width: F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))
    name = lambda label: F.concat(F.lit(label), number.cast("string"))
    people = spark.range(2431).select(
        key("P", 4).alias("PatientID"), F.lit(" ann").alias("FirstName"), F.lit("LEE ").alias("LastName"),
        F.when(F.col("id") % 2 == 0, "m").otherwise("FEMALE").alias("Gender"),
        F.lit(dt.date(1980, 2, 29)).alias("DOB"),
        F.when(F.col("id") % 9 == 0, "Chennnai, Tamil Nadu, India").otherwise("Chennai, Tamil Nadu, India").alias("CityStateCountry"),
    )
    dummy = spark.createDataFrame([("dummy", None, None, None, None, None)], SCHEMAS["patient_raw"])
    return {
        "patient": people.unionByName(dummy),
        "department": spark.range(40).select(
            key("DEP", 2).alias("DepartmentID"), F.lit("Dept- ").alias("DepartmentName"),
            F.when(F.col("id") < 33, F.concat(F.lit("Cat "), F.col("id") % 5)).alias("DepartmentCategory"),
            F.when(F.col("id") < 33, name("Dep ")).alias("Specialization"),
        ),
        "doctor": spark.range(200).select(
            key("D", 3).alias("DoctorID"), F.lit("Dr.").alias("FirstName"), name("No ").alias("LastName"),
            F.lit("Male").alias("Gender"), (F.col("id") % 40).cast("int").alias("ExperienceYears"),
        ),
        "diagnosis": spark.range(40).select(key("DX", 2).alias("DiagnosisID"), name("Dx ").alias("DiagnosisName")),
        "treatment": spark.range(30).select(key("TR", 2).alias("TreatmentID"), name("Tr ").alias("TreatmentName")),
        "payment": spark.range(4).select(key("PM", 2).alias("PaymentMethodID"), name("Pay ").alias("PaymentMethod")),
    }


def test_whole_run(spark, tmp_path):
    visits = 3000
    alias = literal_rows(spark, ["Variant", "Canonical"], [("Chennnai", "Chennai")])
    expected = [("visits", visits), ("patient", 2431), ("department", 33), ("doctor", 200), ("diagnosis", 40), ("treatment", 30), ("payment", 4)]
    expect = spark.createDataFrame(expected, "Dataset string, RowCount bigint")
    manifest = pipeline.run(spark, raw_tables(spark, visits), alias, expect, visits, str(tmp_path), "test")
    counts = {r.Output: r.RowCount for r in manifest.collect()}
    assert counts["fact_visits"] == visits and counts["dim_patient"] == 2431 and counts["q02_annual_growth"] == 6
    assert len(counts) == 7 + 12
    kept = spark.read.parquet(str(tmp_path / "manifest"))
    assert {r.Output: r.RowCount for r in kept.collect()} == counts
    kpis = read_table(spark, str(tmp_path / "exports/q01_operating_kpis"), "TotalVisits bigint", "csv")
    assert kpis.first().TotalVisits == visits

    with pytest.raises(QualityError, match="rows visits: 1 violations"):
        wrong = expect.withColumn("RowCount", F.col("RowCount") + (F.col("Dataset") == "visits").cast("int"))
        pipeline.run(spark, raw_tables(spark, visits), alias, wrong, visits, str(tmp_path / "again"), "test")


def test_layouts_give_the_same_answers(spark, tmp_path):
    visits = generate_visits(numbers(spark, 2000))
    layouts = workloads.write_layouts(visits, str(tmp_path))
    jobs = workloads.workloads("P0007")
    assert sorted(jobs) == [position for position, *_ in workloads.WORKLOADS]
    for workload in jobs.values():
        answers = {name: rows(workload.job(spark.read.parquet(path))) for name, path in layouts.items()}
        assert all(answer == answers["plain"] for answer in answers.values())
    log = workloads.measure(spark, {7: jobs[7], 8: jobs[8]}, {n: layouts[n] for n in ("plain", "by_doctor")}, warmups=1, runs=2)
    assert log.count() == 8 and log.filter("LogicalReads <= 0 or ElapsedUs <= 0").count() == 0
    summary = {r.Position: r for r in workloads.bench_summary(log, "plain", "by_doctor").collect()}
    assert set(summary) == {7, 8} and not summary[8].Unstable
    bucketed = workloads.bucketed_by_doctor(visits, "visits_by_doctor", 4)
    plan = workloads.doctor_load(bucketed.select("DoctorID", "PatientID"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(DoctorID" not in plan
    spark.sql("DROP TABLE visits_by_doctor")


def test_bench_summary(spark):
    log = spark.createDataFrame([
        ("plain", 1, 1, 1000, 5000), ("plain", 1, 2, 1000, 4000), ("sorted", 1, 1, 250, 1234), ("sorted", 1, 2, 250, 2000),
        ("plain", 7, 1, 0, 10), ("sorted", 7, 1, 0, 20), ("plain", 8, 1, 1234567, 10), ("sorted", 8, 1, 1, 20), ("sorted", 8, 2, 2, 20),
        ("plain", 2, 1, 5, 5),
    ], "Phase string, Position int, Iteration int, LogicalReads bigint, ElapsedUs bigint")
    got = {r.Position: r.MarkdownRow for r in workloads.bench_summary(log, "plain", "sorted").collect()}
    assert got == {
        1: "| Monthly trend | q09 | 1,000 | 250 | 75.0% | 4.00 | 1.23 | months stay together in files sorted by date |",
        7: "| Point lookup (control) | -- | 0 | 0 | n/a | 0.01 | 0.02 | block statistics leave a block or two to read |",
        8: "| Full scan (control) | -- | 1,234,567 | 1 | 100.0% | 0.01 | 0.02 | every block is read in any layout (unstable -- rerun) |",
    }
