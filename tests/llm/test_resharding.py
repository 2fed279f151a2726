import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from visitlake.llm import resharding as R
from visitlake.llm.queries import op4_flow_resharding


def cheapest(supply, capacity, cost):
    """All ways, by trying every integer flow."""
    best = None
    ways = [[w for w in itertools.product(range(s + 1), repeat=len(capacity)) if sum(w) == s] for s in supply]
    for flow in itertools.product(*ways):
        if all(sum(f[j] for f in flow) <= c for j, c in enumerate(capacity)):
            price = sum(f[j] * cost[i][j] for i, f in enumerate(flow) for j in range(len(capacity)))
            best = price if best is None else min(best, price)
    return best


def test_flow_is_the_cheapest():
    rng = random.Random(2)
    for _ in range(60):
        supply = [rng.randrange(5) for _ in range(rng.randrange(1, 4))]
        capacity = [rng.randrange(6) for _ in range(3)]
        cost = [[rng.randrange(4) for _ in capacity] for _ in supply]
        if sum(capacity) < sum(supply):
            with pytest.raises(ValueError):
                R.least_cost_flow(supply, capacity, cost)
            continue
        flow = R.least_cost_flow(supply, capacity, cost)
        assert [sum(f) for f in flow] == supply and all(sum(f[j] for f in flow) <= c for j, c in enumerate(capacity))
        assert sum(f[j] * cost[i][j] for i, f in enumerate(flow) for j in range(3)) == cheapest(supply, capacity, cost)


def checked(rows, shards):
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows))) for s in range(shards))
    return [sum(r.size for r in rows if r.shard == s) for s in range(shards)]


def test_rows_and_sizes(spark):
    rows = [(i, "x" * (i % 700), "a", 1) for i in range(3000)] + [(7, "x" * 7, "a", 1), (None, "é", None, 2), (9001, None, "b", 2), (9002, "", "b", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, block int")
    got = R.by_bytes(df.repartition(5), shards=8, old_shards=6).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in rows), key=repr)
    sizes = checked(got, 8)
    assert max(sizes) - min(sizes) <= 700
    old = [sum(r.size for r in got if r.old_shard == s) for s in range(6)]
    least = sum(max(0, x - sum(old) / 8) for x in old)
    assert sum(r.size for r in got if r.old_shard != r.shard) <= least + 8 * 700
    assert R.by_bytes(df.limit(0), 8, 6).count() == 0


def test_one_size_and_one_giant(spark):
    same = spark.createDataFrame([(i, "same text") for i in range(4001)], "doc_id long, text string")
    sizes = checked(R.by_bytes(same, 8, 6).collect(), 8)
    assert max(sizes) - min(sizes) <= 20
    giant = same.union(spark.createDataFrame([(9999, "g" * 500_000)], "doc_id long, text string"))
    checked(R.by_bytes(giant, 8, 6).collect(), 8)


def test_query_on_whole_documents(spark, sf_dir):
    got = op4_flow_resharding(spark, sf_dir).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i, len(t) + 1, zlib.crc32(t)) for i, t in texts.items())
    sizes = checked(got, 8)
    assert max(sizes) - min(sizes) <= max(r.size for r in got) and {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_only_affected_files_are_written(spark, tmp_path):
    folder = str(tmp_path / "layout")
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"),
                                    (F.col("id") % 3).cast("int").alias("shard"), F.concat(F.lit("b"), F.col("id") % 10).alias("block_name"))
    manifest = R.write_layout(rows, folder)
    moves = rows.filter("shard = 0 AND block_name IN ('b1', 'b4')").select("doc_id", "shard", F.lit(3).alias("new_shard"))
    after, written = R.rewrite_affected(manifest, folder, moves)
    assert {(r.shard, r.block_name) for r in written.collect()} == {(0, "b1"), (0, "b4"), (3, "b1"), (3, "b4")}
    got = R.read_layout(after, folder)
    moved = {r.doc_id for r in moves.collect()}
    assert sorted((r.doc_id, r.shard) for r in got.collect()) == sorted((i, 3 if i in moved else i % 3) for i in range(2000))
    assert R.read_layout(manifest, folder).filter("shard = 3").count() == 0
    assert after.filter("version = 'first'").count() == manifest.count() - 2


def test_query_reads_what_lies_in_the_rewritten_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "FILE_BYTES", 20_000)
    monkeypatch.setattr(R, "scratch_path", lambda *_: str(tmp_path / "layout"))
    rows = [(i, "x" * (i % 700)) for i in range(2000)] + [(7, "x" * 7)] * 30 + [(None, "null é")] * 30 + [(None, None), (9000, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen, read = [], R.read_layout
    monkeypatch.setattr(R, "read_layout", lambda manifest, folder: seen.append(manifest) or read(manifest, folder))
    got = R.by_bytes(df, shards=8, old_shards=6).collect()
    checked(got, 8)
    assert len(got) == len(rows)
    files = [(r.version, f"{tmp_path}/layout/{r.version}/shard={r.shard}/block_name={r.block_name}", r.shard) for r in seen[-1].collect()]
    # Files that lose no row are as they were; together with the new ones they hold every row once.
    assert {6, 7} <= {shard for version, _, shard in files if version != "first"} and any(v == "first" for v, _, _ in files)
    lost = {(r.old_shard, r.doc_id) for r in got if r.shard != r.old_shard}
    held = [(r.doc_id, r.text, r.old_shard, shard) for _, f, shard in files for r in spark.read.parquet(f).collect()]
    assert lost and sorted(((h[0], h[1]) for h in held), key=repr) == sorted(rows, key=repr)
    assert sorted(((h[0], zlib.crc32((h[1] or "").encode()), h[2], h[3]) for h in held), key=repr) == sorted(
        ((r.doc_id, r.text_crc32, r.old_shard, r.shard) for r in got), key=repr)


def test_repeated_and_null_ids_are_not_multiplied(spark, tmp_path):
    folder = str(tmp_path / "layout")
    rows = spark.createDataFrame([(1, "a", 0, "b"), (1, "b", 0, "b"), (None, "c", 0, "b"), (None, "d", 0, "b"), (2, "e", 0, "b")],
                                 "doc_id long, text string, shard int, block_name string")
    manifest = R.write_layout(rows, folder)
    moves = rows.filter("doc_id = 1 OR doc_id IS NULL").select("doc_id", "shard", F.lit(1).alias("new_shard"))
    after, _ = R.rewrite_affected(manifest, folder, moves)
    got = sorted((r.text, r.shard) for r in R.read_layout(after, folder).collect())
    assert got == [("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 0)]
