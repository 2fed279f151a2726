"""The extract as bytes, against numbers packed by hand."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows
from visitlake.plans import packed
from visitlake.plans.crossfilter import Encoding

SIZES = {"a": 1, "b": 2, "c": 3}


def made(spark, n, seed=1):
    rng = random.Random(seed)
    data = [(rng.randrange(max(n, 1)), rng.choice([0, 1, 255, rng.randrange(256)]), rng.choice([0, 65535, rng.randrange(65536)]), rng.choice([0, 2**24 - 1, rng.randrange(2**24)])) for _ in range(n)]
    return data, spark.createDataFrame(data, "VisitID long, a int, b int, c long")


@pytest.mark.parametrize("n,chunk", [(0, 4), (1, 4), (4, 4), (5, 4), (230, 16)])
def test_chunks_hold_the_bytes_in_key_order(spark, n, chunk):
    data, df = made(spark, n)
    chunks = packed.pack(df, SIZES, rows=chunk).collect()
    assert len(chunks) == 3 * -(-n // chunk) and all(r.FirstRow == r.Chunk * chunk for r in chunks)
    for position, name in enumerate(SIZES, 1):
        mine = sorted((r for r in chunks if r.ColumnName == name), key=lambda r: r.Chunk)
        want = b"".join(row[position].to_bytes(SIZES[name], "little") for row in sorted(data))
        assert b"".join(bytes(r.Bytes) for r in mine) == want
        assert [r.Rows for r in mine] == [min(chunk, n - i) for i in range(0, n, chunk)]


def test_unpacked_rows_are_those_packed(spark):
    data, df = made(spark, 300, 2)
    again = packed.unpack(packed.pack(df, SIZES, rows=32), SIZES)
    assert rows(again.select(*SIZES)) == rows(df.select(*SIZES))
    assert sorted(r.Row for r in again.collect()) == list(range(300))


def test_sizes_and_gaps(spark):
    _, df = made(spark, 100, 3)
    chunks = packed.pack(df, SIZES, rows=30)
    assert rows(packed.totals(chunks)) == [("a", 1, 4, 100, 100, 0), ("b", 2, 4, 100, 200, 0), ("c", 3, 4, 100, 300, 0)]
    torn = chunks.withColumn("Bytes", F.when((F.col("Chunk") == 1) & (F.col("ColumnName") == "b"), F.substring("Bytes", 1, 3)).otherwise(F.col("Bytes")))
    assert {r.ColumnName: r.Gaps for r in packed.totals(torn).collect()} == {"a": 0, "b": 1, "c": 0}


@pytest.mark.parametrize("value", [256, -1, None])
def test_a_code_that_does_not_fit_stops_the_job(spark, value):
    df = spark.createDataFrame([(1, value)], "VisitID long, a int")
    with pytest.raises(Exception, match="does not fit 1 bytes"):
        packed.pack(df, {"a": 1}).collect()


def test_widths():
    assert [packed.width_of(n) for n in (0, 1, 256, 257, 65536, 65537, 2**24, 2**24 + 1)] == [1, 1, 1, 2, 2, 3, 3, 4]
    assert sum(packed.widths(Encoding()).values()) == 11


def test_a_code_is_not_cut_out_of_a_whole_chunk(spark):
    """Codes are read from small blocks that are rows of their own; the rows are those packed across block borders."""
    data, df = made(spark, 2 * packed.BLOCK + 5, 4)
    again = packed.unpack(packed.pack(df, SIZES, rows=packed.BLOCK + 3), SIZES)
    plan = plan_of(again)
    assert plan.split("== Physical Plan ==")[1].count("Generate") >= 3
    assert [tuple(r) for r in again.orderBy("Row").select(*SIZES).collect()] == [row[1:] for row in sorted(data)]
