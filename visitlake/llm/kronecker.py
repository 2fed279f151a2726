"""Hard negatives by Kronecker-packed products.

Vectors are whole numbers once their components are scaled. The components of many
candidates are made non-negative by a bias and put side by side into the fields of one wide
integer, one integer for each dimension. A field is wide enough for a whole inner product,
so nothing ever carries from one into the next: multiplying each wide integer once by the
anchor's component of that dimension and adding up gives all inner products at once. Taking
the fields apart and the bias off again gives the exact scores.

Candidates are dealt into chunks of bounded size, the rows of a label to as many as they
need, so that a label with a third of all rows is spread like any other. Anchors meet first
the chunks that hold their label, for their positives, then all chunks, for the negatives
under each positive; from every meeting only the first few of each list go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.llm.common import importable, stored

SCALE, POSITIVES, NEGATIVES, SHARE = 256, 5, 5, 80
#: Components in a chunk of candidates and in a block of anchors; rows there are at least.
CHUNK, BLOCK, LEAST_ROWS = 1 << 18, 1 << 16, 16
#: Fields up to here are taken apart as machine integers, wider ones as integers of any size.
MACHINE_BITS, EXACT = 60, float(1 << 53)
LONGEST = (1 << 63) - 1
NO_ID = LONGEST
POSITIVE = "anchor long, anchor_id long, other long, score long"
NEGATIVE = "anchor long, place int, other long, score long"


def whole(vectors: pd.Series) -> np.ndarray:
    """Scaled components rounded down, exactly: 64-bit integers, or integers of any size where those do not hold them."""
    values = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    if values.size == 0 or np.abs(values).max() < EXACT / SCALE:
        return np.floor(SCALE * values).astype(np.int64)
    # From 2^53 on a double is a whole number.
    exact = [[int(x) * SCALE if abs(x) >= EXACT else int(np.floor(SCALE * x)) for x in row] for row in values.tolist()]
    return np.array(exact, dtype=object)


def as_long(score: int) -> int:
    return max(-LONGEST - 1, min(LONGEST, int(score)))


class Packed:
    """Some candidates in one wide integer for each dimension, ready for anchors up to a given size."""

    def __init__(self, candidates: np.ndarray, anchors: np.ndarray):
        self.count, self.dimension = candidates.shape
        least = lambda values: min(0, int(values.min())) if values.size else 0
        most = lambda values: int(values.max()) if values.size else 0
        self.bias, self.anchor_bias = -least(candidates), -least(anchors)
        largest = max(1, self.dimension * (most(candidates) + self.bias) * (most(anchors) + self.anchor_bias))
        self.machine = candidates.dtype != object and anchors.dtype != object and largest.bit_length() <= MACHINE_BITS
        self.width = (largest.bit_length() + 7) // 8
        if not self.machine:
            candidates = candidates.astype(object)
        self.sums = candidates.sum(axis=1)
        self.wide = [int.from_bytes(self.fields(column + self.bias), "little") for column in candidates.T]

    def fields(self, column: np.ndarray) -> bytes:
        if self.machine:
            return column.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : self.width].tobytes()
        return b"".join(int(x).to_bytes(self.width, "little") for x in column)

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """The inner product of one anchor with every candidate; one beyond a long is the nearest long."""
        biased = (anchor + self.anchor_bias).tolist()
        total = sum(map(mul, biased, self.wide)).to_bytes(self.count * self.width, "little")
        if self.machine:
            apart = np.zeros((self.count, 8), dtype=np.uint8)
            apart[:, : self.width] = np.frombuffer(total, dtype=np.uint8).reshape(self.count, self.width)
            products = apart.view("<u8").ravel().astype(np.int64)
        else:
            products = np.array([int.from_bytes(total[i : i + self.width], "little") for i in range(0, len(total), self.width)], dtype=object)
        own = sum(anchor.tolist())
        scores = products - self.anchor_bias * self.sums - (self.bias * own + self.dimension * self.bias * self.anchor_bias)
        return scores if self.machine else np.array([as_long(s) for s in scores], dtype=np.int64)


def first_of(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the highest scores, ties by the smaller id."""
    some = np.arange(len(scores))
    if len(scores) > 4 * count:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - count)[len(scores) - count])
    # The complement turns the order round and, unlike the negative, exists for every long.
    return some[np.lexsort((ids[some], ~scores[some]))][:count]


def eligible(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, embedding, size`` of the rows that take part."""
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound).withColumn("size", F.size("embedding"))


def least_rows(components: int) -> Column:
    """How many rows a chunk or block of so many components holds."""
    return F.greatest(F.lit(LEAST_ROWS), F.expr(f"{components} DIV greatest(size, 1)"))


def dealt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``chunk``, and ``size, label, chunk`` of the chunks a label is found in.

    Rows of a label go to as many chunks as they fill; small labels share one."""
    counts = stored(rows.groupBy("size", "label").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / least_rows(CHUNK)).cast("int")))
    chunks = counts.agg(F.sum(F.col("n") / least_rows(CHUNK)).alias("n")).first()["n"] or 0
    number = F.pmod(F.xxhash64("size", "label", "part"), F.lit(max(1, round(chunks)))).cast("int").alias("chunk")
    homes = counts.select("size", "label", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select("size", "label", "part", number)
    parts = counts.select("size", "label", "parts")
    placed = rows.join(parts, ["size", "label"]).withColumn("part", F.pmod(F.xxhash64("vec_id", "embedding"), F.col("parts")).cast("int"))
    return placed.select("vec_id", "label", "embedding", "size", number), homes.select("size", "label", "chunk").distinct()


def taken_apart(rows: pd.DataFrame, by: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    for key, part in rows.groupby(by, sort=True):
        yield key, part


def positives_in(anchors: pd.DataFrame, members: pd.DataFrame, count: int) -> list[tuple[int, int, int, int]]:
    """Of each anchor the first other rows of its label among these."""
    found, there = [], dict(taken_apart(members, ["size", "label"]))
    for key, part in taken_apart(anchors, ["size", "label"]):
        if key not in there:
            continue
        ids, numbers = there[key]["vec_id"].to_numpy(), whole(part["embedding"])
        packed = Packed(whole(there[key]["embedding"]), numbers)
        for anchor, anchor_id, vector in zip(part["anchor"], part["anchor_id"], numbers, strict=True):
            others = np.flatnonzero(ids != anchor_id)
            scores = packed.scores(vector)[others]
            found += [(anchor, anchor_id, ids[others[i]], int(scores[i])) for i in first_of(scores, ids[others], count)]
    return found


def negatives_in(anchors: pd.DataFrame, members: pd.DataFrame, count: int, share: int) -> list[tuple[int, int, int, int]]:
    """Under each positive of an anchor the first rows of other labels among these."""
    found, there = [], dict(taken_apart(members, ["size"]))
    for key, part in taken_apart(anchors, ["size"]):
        if key not in there:
            continue
        ids, labels, numbers = there[key]["vec_id"].to_numpy(), there[key]["label"].to_numpy(), whole(part["embedding"])
        packed = Packed(whole(there[key]["embedding"]), numbers)
        for anchor, label, positives, vector in zip(part["anchor"], part["label"], part["positives"], numbers, strict=True):
            limits = [(p["place"], -(-share * int(p["score"]) // 100), int(p["score"])) for p in positives]
            scores = packed.scores(vector)
            near = np.flatnonzero((labels != label) & (scores >= min(low for _, low, _ in limits)) & (scores <= max(high for _, _, high in limits)))
            for place, low, high in limits:
                some = near[(scores[near] >= low) & (scores[near] <= high)]
                found += [(anchor, place, ids[some[i]], int(scores[some[i]])) for i in first_of(scores[some], ids[some], count)]
    return found


def meet(anchors: DataFrame, members: DataFrame, visits: DataFrame, blocks: int, compare, schema: str) -> DataFrame:
    """Compares each block of anchors with every chunk it visits. ``visits`` are anchors with their ``chunk``."""
    here = visits.withColumn("block", F.pmod("anchor", F.lit(blocks)).cast("int"))
    there = members.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    names = schema.replace(" long", "").replace(" int", "").split(", ")

    def both(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        found = compare(x, y) if len(x) and len(y) else []
        return pd.DataFrame(found, columns=names).astype({n: "int32" if n == "place" else "int64" for n in names})

    return here.groupBy("chunk", "block").cogroup(there.groupBy("chunk", "block")).applyInPandas(both, schema)


def ranked(found: DataFrame, by: list[str], count: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "other")
    return found.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= count)


def mined(vectors: DataFrame, label: Column, is_anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding",
          positives: int = POSITIVES, negatives: int = NEGATIVES, share: int = SHARE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each anchor and each of its ``positives`` first other rows of its label, the first
    ``negatives`` rows of other labels whose score is at most the positive's and at least
    ``share`` percent of it, by higher score, then smaller id. ``label`` and ``is_anchor``
    are expressions over ``vec_id`` and the table's own columns.

    Rows with a null label, a null vector, or a null or non-finite component take no part.
    Vectors are compared with those of their length only; empty ones score 0. Repeated rows
    are rows of their own as candidates, and one anchor; rows that share the anchor's id are
    not its positives. Rows without an id come last among ties and are no anchors. A score
    beyond a long counts as the nearest long.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), label.alias("label"),
                          F.col(f"`{embedding}`").alias("embedding"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    sound = stored(eligible(importable(rows)))
    kept = sound.withColumn("vec_id", F.coalesce("vec_id", F.lit(NO_ID))).drop("is_anchor")
    members, homes = dealt(kept)
    chosen = sound.filter(F.col("is_anchor") & F.col("vec_id").isNotNull())
    anchors = stored(chosen.select(F.xxhash64("vec_id", "label", "embedding").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "embedding", "size")
                     .dropDuplicates(["anchor"]))
    blocks = max(1, round(anchors.agg(F.sum(F.lit(1.0) / least_rows(BLOCK)).alias("n")).first()["n"] or 0))

    own = anchors.join(homes, ["size", "label"])
    pairs = meet(anchors, members, own, blocks, lambda x, y: positives_in(x, y, positives), POSITIVE)
    best = stored(ranked(pairs, ["anchor"], positives, "place"))

    # Under a negative score nothing lies between its share and itself.
    listed = best.filter("score >= 0").groupBy("anchor").agg(F.collect_list(F.struct("place", "score")).alias("positives"))
    everywhere = anchors.join(listed, "anchor").join(homes.select("size", "chunk").distinct(), "size")
    under = meet(anchors, members, everywhere, blocks, lambda x, y: negatives_in(x, y, negatives, share), NEGATIVE)
    hard = ranked(under, ["anchor", "place"], negatives, "rank")
    with_id = lambda name: F.when(F.col(name) < NO_ID, F.col(name))
    known = best.select("anchor", "anchor_id", "place", with_id("other").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(known, ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), with_id("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
