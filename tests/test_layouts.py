"""Layouts that a lookup can use, and the reads that prove it."""

import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from visitlake.plans import layouts, workloads
from visitlake.plans.generate import generate_visits, numbers

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plain_morton(a, b):
    return sum((a >> i & 1) << (2 * i + 1) | (b >> i & 1) << (2 * i) for i in range(layouts.MORTON_BITS))


def test_bits_are_interleaved(spark):
    rng = random.Random(1)
    pairs = [(0, 0), (65535, 0), (0, 65535), (65535, 65535)] + [(rng.randrange(65536), rng.randrange(65536)) for _ in range(200)]
    got = spark.createDataFrame(pairs, "a int, b int").select("a", "b", layouts.morton(F.col("a"), F.col("b")).alias("m")).collect()
    assert all(r.m == plain_morton(r.a, r.b) for r in got)


def test_scaling_keeps_the_order_and_the_borders(spark):
    values = [None, -5, -4, 0, 7, 99, 100]
    df = spark.createDataFrame([(v,) for v in values], "v int").select("v", layouts.scaled(F.col("v"), F.lit(-5), F.lit(100)).alias("s"))
    got = {r.v: r.s for r in df.collect()}
    assert got[None] == got[-5] == 0 and got[100] == 65535
    assert [got[v] for v in values[1:]] == sorted(got[v] for v in values[1:])
    assert spark.range(1).select(layouts.scaled(F.lit(3), F.lit(3), F.lit(3)).alias("s")).first().s == 0


def test_missing_keys_and_dates_are_written(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES ('V1', 'P1', date'2020-01-01'), ('V2', NULL, date'2021-01-01'), ('V3', 'P2', NULL), ('V4', NULL, NULL) AS t(VisitID, PatientID, VisitDate)")
    layouts.write_morton(df, str(tmp_path / "m"), "PatientID", "VisitDate", "VisitID", 10)
    assert rows(spark.read.parquet(str(tmp_path / "m"))) == rows(df)
    layouts.write_morton(df.limit(0), str(tmp_path / "e"), "PatientID", "VisitDate", "VisitID", 10)


def scanned(df) -> int:
    """Rows the file scan of a plan handed on: those of the row groups it did not skip."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = (plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan).collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    visits = generate_visits(numbers(spark, 60_000))
    return workloads.write_layouts(visits, str(tmp_path_factory.mktemp("layouts")), row_group=16_000)


def test_a_lookup_reads_under_a_tenth_of_the_row_groups(spark, written):
    read = {name: scanned(workloads.point_lookup(spark.read.parquet(path), "P0007")) for name, path in written.items()}
    assert read["by_patient"] < 60_000 / 10 < read["by_doctor"], read
    answers = [rows(workloads.point_lookup(spark.read.parquet(path), "P0007")) for path in written.values()]
    assert all(a == answers[0] != [] for a in answers)


def test_dates_are_narrow_too(spark, written):
    """The second key of the Morton order: a month is not spread over all files."""
    month = lambda path: spark.read.parquet(path).filter("VisitDate >= date'2021-03-01' AND VisitDate < date'2021-03-15'").select("VisitID", "VisitDate")
    assert scanned(month(written["by_patient"])) < 60_000 / 2
    assert rows(month(written["by_patient"])) == rows(month(written["plain"]))


def test_a_key_that_is_not_there_reads_nothing(spark, written):
    df = workloads.point_lookup(spark.read.parquet(written["by_patient"]), "P0000x")
    assert scanned(df) < 60_000 / 100 and df.count() == 0


SCRIPT = """
import json, sys
from pyspark.sql import functions as F
from visitlake.plans import reads, workloads
from visitlake.plans.generate import generate_visits, numbers
from visitlake.session import local_session
folder = sys.argv[1]
spark = local_session(2, 4, "reads", event_log=folder + "/log")
spark.sparkContext.setLogLevel("ERROR")
# Values in no order, as visits come in; those of the generator are periodic and nearly compress away.
drawn = lambda salt, n: F.pmod(F.xxhash64("VisitID", F.lit(salt)), F.lit(n))
visits = generate_visits(numbers(spark, 300_000)).withColumns({
    "PatientID": F.concat(F.lit("P"), F.lpad(drawn(1, 2000).cast("string"), 4, "0")), "BillAmount": (drawn(2, 10**7) / 100).cast("decimal(18,2)"),
    "VisitDate": F.date_add(F.lit("2020-01-01").cast("date"), drawn(3, 2000).cast("int"))})
paths = workloads.write_layouts(visits, folder + "/layouts", 400_000, 500)
jobs = workloads.workloads("P0007")
log = workloads.measure(spark, {7: jobs[7], 8: jobs[8]}, {n: paths[n] for n in ("plain", "by_patient")}, warmups=1, runs=2).collect()
groups = {r.JobGroup: r.RowsRead for r in reads.reads_by_group(spark).collect()}
print("RESULT" + json.dumps([[r.Phase, r.Position, r.Iteration, r.LogicalReads, groups[f"{r.Phase}/{r.Position}/{r.Iteration}"]] for r in log]))
"""


def test_reads_are_those_the_event_log_shows(tmp_path):
    (tmp_path / "log").mkdir()
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], capture_output=True, text=True, cwd=ROOT, timeout=300,
                          env={**os.environ, "PYTHONPATH": ROOT})
    assert "RESULT" in done.stdout, done.stderr[-2000:]
    found = json.loads(done.stdout.split("RESULT")[1])
    seen = {(phase, position, i): (size, n) for phase, position, i, size, n in found}
    assert len(seen) == 8
    for i in (1, 2):
        assert seen["by_patient", 7, i][0] < 0.7 * seen["plain", 7, i][0]
        assert seen["by_patient", 7, i][1] < 300_000 / 5
        assert seen["plain", 8, i][1] == seen["by_patient", 8, i][1] == 300_000
