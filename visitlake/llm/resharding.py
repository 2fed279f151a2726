"""Resharding by a flow of least cost.

The bytes of the old shards have to fit the capacities of the new ones. Old and new shards
are the two sides of a small network, an edge costs nothing per byte where a shard stays
itself and one where bytes move, and the flow of least cost says how many bytes each old
shard sends to each new one: together the fewest that have to move.

An old shard is laid out in blocks, by size class from large to small and by a hash within
it. What stays is taken from the front, what leaves from the end, in runs of as many bytes
as the flow says; so borders fall among the smallest rows, and a row goes where its middle
lies. Offsets are block sums first and positions within a block second: nothing is ordered
as a whole, the driver sees one number a shard.

The old layout lies in files of that order, so what leaves a shard is in its last files. Only
files that lose rows are read again and written, and moved rows come into files of their own;
what is said about the new layout is read from its files.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.llm.common import narrow, stored
from visitlake.session import scratch_path

#: Rows a block should have, and the least number of blocks of a size class in a shard.
BLOCK_ROWS, LEAST_BLOCKS = 50_000, 64
BLOCK = ("old_shard", "klass", "block")
#: Bytes of rows a file of a layout begins within; its last block may reach beyond.
FILE_BYTES = 16 << 20


def least_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost: Sequence[Sequence[int]]) -> list[list[int]]:
    """How much of each supply goes to each capacity, at the least total cost (successive shortest paths).

    For the number of shards, not of rows. The capacities must hold the supply.
    """
    m, n = len(supply), len(capacity)
    if sum(capacity) < sum(supply):
        raise ValueError("the new shards cannot hold the old ones")
    flow = [[0] * n for _ in range(m)]
    left, room = list(supply), list(capacity)
    while any(left):
        # Distances from all old shards with bytes left, over edges and over flow that can be taken back.
        to_old = [0 if x else float("inf") for x in left]
        to_new, via_old, via_new = [float("inf")] * n, [-1] * n, [-1] * m
        for _ in range(m + n):
            changed = False
            for i in range(m):
                for j in range(n):
                    if to_old[i] + cost[i][j] < to_new[j]:
                        to_new[j], via_old[j], changed = to_old[i] + cost[i][j], i, True
                    if flow[i][j] and to_new[j] - cost[i][j] < to_old[i]:
                        to_old[i], via_new[i], changed = to_new[j] - cost[i][j], j, True
            if not changed:
                break
        end = min((j for j in range(n) if room[j]), key=lambda j: (to_new[j], j))
        path, j = [], end
        while True:
            i = via_old[j]
            path.append((i, j, 1))
            if via_new[i] < 0:
                break
            j = via_new[i]
            path.append((i, j, -1))
        amount = min([left[i], room[end], *(flow[a][b] for a, b, sign in path if sign < 0)])
        for a, b, sign in path:
            flow[a][b] += sign * amount
        left[i] -= amount
        room[end] -= amount
    return flow


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total * (k + 1) // shards - total * k // shards for k in range(shards)]


def runs(flow: list[list[int]]) -> list[tuple[int, int, int, int]]:
    """(old shard, first byte, byte after the last, new shard): what stays comes first."""
    out = []
    for i, row in enumerate(flow):
        at = 0
        for j in sorted(range(len(row)), key=lambda j: (j != i, j)):
            if row[j]:
                out.append((i, at, at + row[j], j))
                at += row[j]
    return out


def sized(docs: DataFrame, old_shard: Column, *more: str) -> DataFrame:
    """``doc_id, size, text_crc32, old_shard`` and ``more``: a row's size is its bytes and one more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), old_shard.cast("int").alias("old_shard"), *more)


def by_hash(shards: int) -> Column:
    """An old layout by id: rows without an id are in shard 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(shards)), F.lit(0))


def before(value: str, *order: str) -> Column:
    """What precedes a block in its shard (or another first column), by block sums."""
    return F.coalesce(F.sum(value).over(Window.partitionBy(order[0]).orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def filed(rows: DataFrame, old_shards: int, n: int) -> DataFrame:
    """Adds ``klass, block`` to a table of ``n`` rows."""
    klass = F.floor(F.log2("size")).cast("int")
    spread = max(LEAST_BLOCKS, -(-n // (BLOCK_ROWS * max(old_shards, 1))))
    return rows.withColumn("klass", -klass).withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(spread)).cast("int"))


def place(rows: DataFrame, old_shards: int, capacities: Sequence[int] | int) -> DataFrame:
    """Adds ``shard, klass, block`` to rows with ``doc_id, size, text_crc32, old_shard``."""
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    ordered = filed(rows, old_shards, total["n"])
    blocks = stored(ordered.groupBy(*BLOCK).agg(F.sum("size").alias("bytes")))
    supply = [0] * old_shards
    for r in blocks.groupBy("old_shard").agg(F.sum("bytes").alias("bytes")).collect():
        supply[r.old_shard] = r.bytes
    if isinstance(capacities, int):
        capacities = equal_capacities(total["bytes"], capacities)
    cost = [[int(i != j) for j in range(len(capacities))] for i in range(old_shards)]
    plan = runs(least_cost_flow(supply, capacities, cost))

    offsets = blocks.withColumn("offset", before("bytes", *BLOCK)).drop("bytes")
    inside = Window.partitionBy(*BLOCK).orderBy(F.desc("size"), "doc_id", "text_crc32")
    within = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    middle = F.col("offset") + F.col("within") + F.col("size") / 2
    shard = F.coalesce(*[F.when((F.col("old_shard") == i) & (middle >= start) & (middle < end), j) for i, start, end, j in plan], F.lit(0))
    return stored(ordered.withColumn("within", within).join(offsets, list(BLOCK)).withColumn("shard", shard).drop("within", "offset"))


def numbered(placed: DataFrame) -> DataFrame:
    """Adds ``slot``: the place in the shard, by its blocks and the order within them."""
    key = ["shard", *BLOCK]
    firsts = placed.groupBy(*key).agg(F.count("*").alias("n")).withColumn("first", before("n", *key)).drop("n")
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("size"), "doc_id", "text_crc32"))
    return placed.withColumn("rank", rank).join(firsts, key).withColumn("slot", F.col("first") + F.col("rank") - 1).drop("first", "rank")


def reshard(rows: DataFrame, old_shards: int, capacities: Sequence[int] | int) -> DataFrame:
    """Adds ``shard, slot, klass, block`` to rows with ``doc_id, size, text_crc32, old_shard``.

    ``capacities`` are bytes, or a number of shards to be made equal. Every row is placed;
    slots count from 0 in each shard without a gap. Repeated rows and rows without an id are
    rows like others; ties in all columns are interchangeable. An empty table stays empty.
    """
    return numbered(place(rows, old_shards, capacities))


def old_layout(rows: DataFrame, old_shards: int, n: int, folder: str) -> DataFrame:
    """Writes ``n`` rows with their text into files in the order of their blocks, each with a ``row``
    of its own; returns the manifest."""
    ordered = filed(rows, old_shards, n)
    offsets = ordered.groupBy(*BLOCK).agg(F.sum("size").alias("bytes")).withColumn("offset", before("bytes", *BLOCK))
    name = F.concat(F.lit("from"), "old_shard", F.lit("_"), F.floor(F.col("offset") / FILE_BYTES))
    files = stored(offsets.select(*BLOCK, name.alias("block_name")))
    numbers = ordered.withColumn("row", F.monotonically_increasing_id())
    return write_layout(numbers.join(F.broadcast(files), list(BLOCK)).select(
        "row", "doc_id", "text", "old_shard", F.col("old_shard").alias("shard"), "block_name"), folder)


def by_bytes(docs: DataFrame, shards: int, old_shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All documents from an old layout by id into shards of near equal bytes, moving the fewest bytes.

    The old layout is written under the shared folder and its affected files are rewritten;
    sizes, checksums, shards and slots are those of the files of the new one."""
    rows = sized(narrow(docs, doc_id=doc_id, text=text), by_hash(old_shards), "text")
    n = rows.count()
    if not n:
        return reshard(rows.drop("text"), old_shards, shards)
    folder = scratch_path(docs.sparkSession, "layout")
    manifest = old_layout(rows, old_shards, n, folder)
    old = stored(sized(read_layout(manifest, folder), F.col("shard"), "row"))
    moves = place(old, old_shards, shards).filter("shard <> old_shard").select(
        "row", F.col("old_shard").alias("shard"), F.col("shard").alias("new_shard"))
    after, _ = rewrite_affected(manifest, folder, moves, "row")
    new = stored(sized(read_layout(after, folder), F.col("old_shard"), "shard"))
    return numbered(filed(new, old_shards, n))


# Files: a layout is a manifest of (shard, block, version) over folders of one version each.


def _write(rows: DataFrame, folder: str, version: str) -> DataFrame:
    rows.repartition("shard", "block_name").write.partitionBy("shard", "block_name").parquet(f"{folder}/{version}")
    there = rows.sparkSession.read.schema(rows.schema).parquet(f"{folder}/{version}")
    return there.groupBy("shard", "block_name").agg(F.count("*").alias("n")).withColumn("version", F.lit(version))


def write_layout(rows: DataFrame, folder: str) -> DataFrame:
    """Writes rows with ``shard, block_name``; returns the manifest."""
    return stored(_write(rows, folder, "first"))


def read_layout(manifest: DataFrame, folder: str) -> DataFrame:
    """All rows of a manifest. The paths read are one a block, as many as a file index holds."""
    spark, parts = manifest.sparkSession, {}
    for r in manifest.select("shard", "block_name", "version").toLocalIterator():
        parts.setdefault(r.version, []).append(f"{folder}/{r.version}/shard={r.shard}/block_name={r.block_name}")
    read = [spark.read.option("basePath", f"{folder}/{v}").parquet(*paths) for v, paths in sorted(parts.items())]
    out = read[0]
    for more in read[1:]:
        out = out.unionByName(more)
    return out


def rewrite_affected(manifest: DataFrame, folder: str, moves: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Applies ``moves`` (``key, shard, new_shard``; moved rows only) to a layout.

    ``key`` names the rows of a shard: rows of one shard that share it, or have none, move
    together, to the smallest shard named. Where they may part, take a number of each row.
    Blocks that lose or gain no row keep their files; the others are written anew under a
    version of their own, so readers of the old manifest are not disturbed and a failed run
    leaves it valid. Returns the new manifest and the blocks that were written.
    """
    version = f"v-{uuid.uuid4().hex}"
    layout = read_layout(manifest, folder)
    moved = moves.groupBy(F.col(key).alias("__key"), F.col("shard").alias("__from")).agg(F.min("new_shard").alias("__to"))
    same = layout[key].eqNullSafe(F.col("__key")) & (layout["shard"] == F.col("__from"))
    found = layout.join(moved, same).select("shard", "block_name", "__to")
    touched = stored(found.select("shard", "block_name").union(found.select("__to", "block_name")).distinct())
    again = layout.join(F.broadcast(touched), ["shard", "block_name"], "left_semi").select(*layout.columns)
    target = again.join(moved, again[key].eqNullSafe(F.col("__key")) & (again["shard"] == F.col("__from")), "left")
    rows = target.withColumn("shard", F.coalesce("__to", "shard")).select(*layout.columns)
    written = _write(rows, folder, version)
    kept = manifest.join(touched, ["shard", "block_name"], "left_anti")
    return stored(kept.unionByName(written.select(*kept.columns))), touched
