"""Window and distribution operators against brute force, hot keys included."""

import math
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from visitlake.operators import distribution, windows
from visitlake.operators.relational import rollup_dim


def inclusive(values, p):
    values = sorted(values)
    position = Decimal(p) * (len(values) - 1) / 100
    low = int(position)
    high = min(low + 1, len(values) - 1)
    exact = values[low] + (position - low) * (values[high] - values[low])
    return exact.quantize(Decimal("0.01"))


def nearest(values, p):
    values = sorted(values)
    return values[max(math.ceil(p * len(values) / 100), 1) - 1]


@pytest.fixture(scope="module")
def skewed():
    """One group holds most rows, another a single one, values spread over many bins."""
    rng = random.Random(7)
    data = [("hot", rng.choice([3, 3, 3, 40, 1023, 1024, 5000])) for _ in range(3000)]
    data += [("wide", rng.randrange(0, 200_000)) for _ in range(500)]
    data += [("one", 12), (None, 5), (None, 6), ("pair", 1), ("pair", 4)]
    return data


@pytest.mark.parametrize("method,brute", [("inc", inclusive), ("nearest", nearest)])
def test_percentiles(spark, skewed, method, brute):
    df = spark.createDataFrame([*skewed, ("hot", None)], "g string, v int")
    points = {"p0": 0, "p10": 10, "p50": 50, "p90": 90, "p100": 100}
    got = {r.g: tuple(r)[1:] for r in distribution.percentiles(df, ["g"], "v", points, method).collect()}
    groups = defaultdict(list)
    for g, v in skewed:
        groups[g].append(v)
    assert got == {g: tuple(brute(vs, p) for p in points.values()) for g, vs in groups.items()}


def test_percentiles_of_everything(spark, skewed):
    df = spark.createDataFrame(skewed, "g string, v int")
    row = distribution.percentiles(df, [], "v", {"p50": 50}, "nearest").first()
    assert row.p50 == nearest([v for _, v in skewed], 50)


def test_small_percentile_fixture(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "v int")
    row = distribution.percentiles(df, [], "v", {"a": 10, "b": 50}).first()
    assert (row.a, row.b) == (Decimal("1.30"), Decimal("2.50"))
    assert distribution.percentiles(df, [], "v", {"a": 10}, "nearest").first().a == 1


def test_histogram_and_cumulative(spark, skewed):
    df = spark.createDataFrame(skewed, "g string, v int")
    hist = distribution.histogram(df, ["g"], "v")
    assert {(r.g, r.v): r.Visits for r in hist.collect()} == Counter(skewed)
    upto = {r.g: r.n for r in distribution.cumulative_upto(hist, ["g"], "v", 40, "n").collect()}
    assert upto == {g: sum(1 for k, v in skewed if k == g and v <= 40) for g in {k for k, _ in skewed}}


def test_dense_rank_by_value_equals_a_plain_window(spark):
    rng = random.Random(3)
    data = [(i, i % 3, Decimal(rng.randrange(1000, 5000)) / 1000) for i in range(700)] + [(900, 1, None)]
    df = spark.createDataFrame(data, "id int, part int, v decimal(38,18)")
    ranked = windows.dense_rank_by_value(df, "v", "r", 100, ["part"])
    got = {r.id: r.r for r in ranked.collect()}
    for part in range(3):
        order = {v: i for i, v in enumerate(sorted({v for _, p, v in data if p == part and v is not None}, reverse=True), 1)}
        assert all(got[i] == order.get(v) for i, p, v in data if p == part)
    whole = {r.id: r.r for r in windows.dense_rank_by_value(df, "v", "r", 1000).collect()}
    order = {v: i for i, v in enumerate(sorted({v for _, _, v in data if v is not None}, reverse=True), 1)}
    assert all(whole[i] == order.get(v) for i, _, v in data)


@pytest.mark.parametrize("partitions", [1, 7])
def test_dense_index(spark, partitions):
    keys = [f"K{i:04d}" for i in random.Random(1).sample(range(5000), 1200)]
    df = spark.createDataFrame([(k,) for k in [*keys, *keys[:50]]], "k string").repartition(partitions)
    got = {r.k: r.ix for r in windows.dense_index(df, ["k"], "ix").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_dense_index_of_several_columns(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1), ("a", 2)], "x string, y int")
    assert rows(windows.dense_index(df, ["x", "y"], "ix")) == [("a", 1, 0), ("a", 2, 1), ("b", 1, 2)]


def test_top_with_ties(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([9, 8, 8, 7, 7, 6])], "id int, s int")
    top = windows.top_with_ties(df, [F.desc("s")], 3, "r")
    assert sorted((r.id, r.r) for r in top.collect()) == [(0, 1), (1, 2), (2, 2), (3, 3), (4, 3)]


def test_gap_tiers(spark):
    waits = [10, 10.5, 11.4, 12.5, 12.5, 14, 15]
    df = spark.createDataFrame([(Decimal(str(w)),) for w in waits], "w decimal(10,2)")
    tiers = windows.gap_tiers(df, "w", F.lit(Decimal("1.00")), "tier").orderBy("w").collect()
    assert [r.tier for r in tiers] == [1, 1, 1, 2, 2, 3, 3]


def test_lag_is_positional(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (4, 9)], "m int, n int")
    got = windows.with_lag(df, ["n"], 2, "m").orderBy("m").collect()
    assert [r.Priorn for r in got] == [None, None, 5]


def test_totals_reach_every_row(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 4)], "k string, n int")
    summed = df.groupBy("k").agg(F.sum("n").alias("n"))
    assert rows(windows.with_totals(summed, ["n"])) == [("a", 3, 7), ("b", 4, 7)]


def test_rollup_by_repeated_names(spark):
    fact = spark.createDataFrame([(1, 10), (1, 20), (2, 5), (3, 7), (9, 100)], "k int, v int")
    dim = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "k int, name string")
    got = rollup_dim(fact, [("k", dim)], ["name"], {"n": F.count(F.lit(1)), "v": F.sum("v")})
    assert rows(got) == [("x", 3, 35), ("y", 1, 7)]
