import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from visitlake.llm import kronecker as K
from visitlake.llm.queries import SQL, op11_kronecker_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, anchor long, score string, chunk int"


def exact(x):
    return int(x) * 256 if abs(x) >= 2**53 else math.floor(256 * x)


def brute(rows, step=100):
    rows = [(i, label if i is None or i % 7 else (label + 1) % 10, [exact(x) for x in v]) for i, v, label in rows
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    long = lambda s: max(-(2**63), min(2**63 - 1, s))
    score = lambda a, b: long(sum(x * y for x, y in zip(a, b, strict=True)))
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    anchors = {(i, label, tuple(v)) for i, label, v in rows if i is not None and i % step == 0}
    out = []
    for i, label, v in anchors:
        fitting = [(j, m, score(v, w)) for j, m, w in rows if len(v) == len(w)]
        positives = sorted(((j, s) for j, m, s in fitting if m == label and j != i), key=order)[:5]
        for j, p in positives:
            under = sorted(((k, s) for k, m, s in fitting if m != label and 80 * p <= 100 * s <= 100 * p), key=order)[:5]
            out += [(i, j, rank, k, p, s) for rank, (k, s) in enumerate(under, 1)]
    return sorted(out, key=repr)


def run(spark, rows, step=100):
    frame = spark.createDataFrame([(*r, 1, "clash", 2) for r in rows], SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, K.mined(frame, label, F.col("vec_id") % step == 0).collect()), key=repr)


@pytest.mark.parametrize("bits", [1, 8, 30, 200])
def test_packed_products_are_exact(bits):
    rng = random.Random(bits)
    for count, dimension in [(1, 1), (7, 3), (300, 64), (5, 0)]:
        draw = lambda n: np.array([[rng.randrange(-(2**bits), 2**bits + 1) for _ in range(dimension)] for _ in range(n)],
                                  dtype=object if bits > 40 else np.int64).reshape(n, dimension)
        candidates, anchors = draw(count), draw(4)
        packed = K.Packed(candidates, anchors)
        for a in anchors:
            assert packed.scores(a).tolist() == [K.as_long(sum(x * y for x, y in zip(a.tolist(), c.tolist(), strict=True))) for c in candidates]


def test_components_are_rounded_down_exactly():
    values = [0.0, -0.001, 1 / 256, -1 / 256, 0.999, -2.5, 1e300, -1e308, float(2**53), 2.0**44 + 0.5]
    assert K.whole(pd.Series([values])).tolist() == [[exact(x) for x in values]]
    assert K.whole(pd.Series([values[:6]])).tolist() == [[exact(x) for x in values[:6]]]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_pair(spark, seed, monkeypatch):
    monkeypatch.setattr(K, "CHUNK", 400)
    monkeypatch.setattr(K, "BLOCK", 200)
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    # A third of all rows have one label, and some of the vectors are equal.
    rows = [(i, [round(x + rng.gauss(0, 0.3), seed) for x in centre[i % 4]], 0 if i % 3 == 0 else rng.randrange(9)) for i in range(400)]
    assert run(spark, rows, step=20) == brute(rows, step=20) != []


def test_rows_that_take_no_part_ties_repeats_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    v, near = [1.0, 0.5], [0.9, 0.5]
    rows = [(100, v, 1), (100, v, 1), (101, v, 1), (102, v, None), (103, None, 1), (104, [1.0, None], 1), (108, [nan, 1.0], 2), (109, [inf, 1.0], 2),
            (110, near, 2), (111, near, 2), (111, near, 2), (113, near, 3), (None, near, 2), (None, near, 1), (114, [1.0], 2), (115, [], 2), (200, [], 3), (201, [], 3),
            (300, [-1.0, 0.2], 4), (301, [1.0, 0.2], 4), (400, [0.0, 0.0], 5), (401, v, 5), (402, [0.0, 0.1], 6), (-100, near, 2), (-7, v, 2)]
    assert run(spark, rows) == brute(rows) != []


def test_huge_components(spark):
    rows = [(0, [1e300, 1.0], 1), (1, [1e-290, 2.0], 1), (2, [1e10, 1.0], 1), (3, [9e-300, 2.0], 2), (4, [9e9, 1.0], 2), (5, [0.0, 2.0], 2), (100, [3e9, 1e12], 2), (101, [4e9, 2e3], 2), (102, [4e9, 2e3], 3)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_query_matches_sql_and_every_pair(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    cursor = duck.execute(SQL["op11_kronecker_negatives"])
    names = [c[0] for c in cursor.description]
    df = op11_kronecker_negatives(spark, sf_dir)
    assert df.columns == names
    got = sorted(map(tuple, df.collect()), key=repr)
    assert got == sorted(cursor.fetchall(), key=repr)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    assert got == brute([(r.vec_id, r.embedding, r.label) for r in table])
