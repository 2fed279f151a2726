"""Near duplicates by HyperMinHash.

Each text becomes the set of its distinct five-word shingles, and the set one sketch:
every shingle falls into one of ``REGISTERS`` buckets, and a bucket keeps of its smallest
hash only the number of leading zeros and ten bits of mantissa, 16 bits in all. Empty
buckets borrow the register of another one, picked by a fixed permutation, so that short
texts are compared over as many registers as long ones. Bands of six registers propose
pairs; the share of equal registers, less the share that would be equal by chance,
estimates the Jaccard similarity and drops hopeless pairs; the rest are compared on their
full sets.

Texts with the same set form a class that takes part once. Within a bucket of a band not
all pairs are formed: every class meets two hubs. What is then known to be connected needs
no further comparison. Buckets whose classes are still in several components are compared
in blocks of bounded size, pairs from different components only and each pair in its first
common band only; a block returns the pairs that pass, not those it looked at. So no link
between components is lost, save for pairs that share no band at all: 3 in ten million at
exactly 0.85.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.common import fewer, importable, narrow, stored, unused
from visitlake.llm.components import components

WORDS, SHARE = 5, 85
BANDS, ROWS, MANTISSA = 32, 6, 10
REGISTERS = BANDS * ROWS
EMPTY = 0xFFFF
#: Bytes a task spends on words met before, and what one costs beside its letters.
WORD_BYTES, ENTRY_BYTES, TEXTS_AT_ONCE = 16_000_000, 170, 512
#: Members of a bucket in one block, and rows a task is meant to get of many small ones.
BLOCK, TASK_ROWS = 256, 2_000
#: Classes, members of buckets, and texts to be split that one task stores, at least, if there are as many.
CLASSES_AT_ONCE, MEMBERS_AT_ONCE, SETS_AT_ONCE = 5_000, 50_000, 1_000
SKETCH = "doc_id long, n_shingles long, key binary, registers binary, buckets array<long>"


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of words met before, for one task and of bounded size."""

    def __init__(self):
        super().__init__()
        self.size = 0

    def __missing__(self, word: bytes) -> int:
        self.size += len(word) + ENTRY_BYTES
        if self.size > WORD_BYTES:
            self.clear()
            self.size = len(word) + ENTRY_BYTES
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def shingles(text: str | None, known: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; a shorter text is one shingle as a whole."""
    split = text.encode().lower().split() if text else []  # on bytes: A-Z only, and ASCII blanks only
    if not split:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(known.__getitem__, split), dtype=np.uint64, count=len(split))
    size = min(words, len(split))
    rolled = np.full(len(split) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        rolled = mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - size + 1 + k])
    return np.unique(rolled)


@cache
def lenders() -> np.ndarray:
    """For each bucket the order in which it asks the others for their register."""
    rng = np.random.default_rng(11)
    return np.stack([rng.permutation(REGISTERS) for _ in range(REGISTERS)])


def registers(hashes: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of the smallest hash of each bucket, as 16 bits."""
    spread = mixed(hashes ^ np.uint64(0x5851F42D4C957F2D))
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    bucket = (spread % np.uint64(REGISTERS)).astype(np.int64)
    np.minimum.at(least, bucket, mixed(spread + np.uint64(0x9E3779B97F4A7C15)))
    filled = np.zeros(REGISTERS, dtype=bool)
    filled[bucket] = True
    high = least >> np.uint64(11)
    zeros = 53 - np.frexp(high.astype(np.float64))[1]
    mantissa = ((high << zeros.astype(np.uint64)) >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out = ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)
    if not filled.all():
        empty = np.flatnonzero(~filled)
        order = lenders()[empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out


def bucket_keys(sketch: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in sketch.reshape(BANDS, ROWS).T.astype(np.uint64):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """Of ``doc_id, text``. Texts without words have no key, registers or buckets."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            rows = []
            for text in batch["text"]:
                hashes = shingles(text if isinstance(text, str) else None, known)
                if len(hashes):
                    sketch = registers(hashes)
                    rows.append((len(hashes), hashlib.md5(hashes.tobytes()).digest(), sketch.tobytes(), bucket_keys(sketch)))
                else:
                    rows.append((0, None, None, None))
            out = pd.DataFrame(rows, columns=["n_shingles", "key", "registers", "buckets"], index=batch.index)
            yield pd.concat([batch[["doc_id"]].astype("Int64"), out], axis=1)

    return importable(docs).mapInPandas(of, SKETCH)


@cache
def chance(size_a: int, size_b: int) -> float:
    """Share of registers two disjoint sets of 2^(size/2) shingles have in common by chance."""
    edges = np.concatenate([2.0 ** -(z + 1) * (1 + np.arange(2**MANTISSA) / 2**MANTISSA) for z in range(40)])
    widths = np.repeat(2.0 ** -(np.arange(40) + 1.0) / 2**MANTISSA, 2**MANTISSA)
    of = [np.exp(-rate * edges) - np.exp(-rate * (edges + widths)) for rate in (2 ** (s / 2) / REGISTERS for s in (size_a, size_b))]
    return float((of[0] * of[1]).sum())


def estimated(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of sketches (one a row), corrected for registers equal by chance."""
    equal = (a == b).mean(axis=1)
    sizes = [np.rint(2 * np.log2(np.maximum(n, 1))).astype(int) for n in (n_a, n_b)]
    by_chance = np.array([chance(int(x), int(y)) for x, y in zip(*sizes, strict=True)])
    return np.clip((equal - by_chance) / (1 - by_chance), 0, 1)


def cut(share: int, n: np.ndarray) -> np.ndarray:
    """Six deviations below the limit, for sets of at least ``n`` shingles."""
    limit, filled = share / 100, REGISTERS * (1 - np.exp(-n / REGISTERS))
    return limit - 6 * np.sqrt(limit * (1 - limit) / np.maximum(filled, 1))


def hopeful(pairs: DataFrame, classes: DataFrame, share: int) -> DataFrame:
    """Pairs whose estimate is not below the limit by more than six deviations."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                a, b = (np.frombuffer(b"".join(batch[c]), dtype=np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
                n_a, n_b = batch["na"].to_numpy(), batch["nb"].to_numpy()
                batch = batch[estimated(a, b, n_a, n_b) >= cut(share, np.minimum(n_a, n_b))]
            yield batch[["a", "b"]]

    sized = classes.select("node", "n_shingles", "registers")
    joined = (pairs.join(sized.toDF("a", "na", "ra"), "a").join(sized.toDF("b", "nb", "rb"), "b")
              .filter(f"100 * least(na, nb) >= {share} * greatest(na, nb)"))
    return joined.select("a", "b", "na", "nb", "ra", "rb").mapInPandas(of, "a long, b long")


def confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs whose full sets have ``share`` percent of their union in common, stored."""
    compared = (hopeful(pairs, classes, share).join(sets.select("node", "shingles").toDF("a", "sa"), "a")
                .join(sets.select("node", "shingles").toDF("b", "sb"), "b")
                .withColumn("both", F.size(F.array_intersect("sa", "sb"))))
    return stored(compared.filter(f"100 * both >= {share} * (size(sa) + size(sb) - both)").select("a", "b"))


def shingle_sets(docs: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """``node, shingles, short`` (their lower halves, sorted) of the documents named by ``nodes``, ``most`` at most."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.iloc[start : start + TEXTS_AT_ONCE]
                sets = [shingles(text if isinstance(text, str) else None, known) for text in part["text"]]
                short = [np.sort(x.astype(np.uint32)).tobytes() for x in sets]
                yield pd.DataFrame({"node": part["doc_id"], "shingles": [x.view(np.int64) for x in sets], "short": short}).astype({"node": "Int64"})

    wanted = docs.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    return importable(fewer(wanted, most, SETS_AT_ONCE)).mapInPandas(of, "node long, shingles array<long>, short binary")


def hub_pairs(members: DataFrame) -> DataFrame:
    """Each member of a bucket with two hubs of it: the smallest, and one picked by hash."""
    hubs = members.groupBy("bucket").agg(F.array(F.min("node"), F.min_by("node", F.xxhash64("node"))).alias("hubs"))
    met = members.join(hubs, "bucket").select("node", F.explode(F.array_distinct("hubs")).alias("hub"))
    return met.filter("hub <> node").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()


def similar_across(x: pd.DataFrame, y: pd.DataFrame, bucket: int, share: int, upper: bool) -> list[tuple[int, int]]:
    """Pairs of different components, first met in this bucket, that reach the limit by the
    lower halves of their shingles (a limit lowered by half a percent, for halves equal by chance)."""
    rx, ry = (np.frombuffer(b"".join(p["registers"]), dtype=np.uint16).reshape(-1, REGISTERS) for p in (x, y))
    nx, ny, cx, cy = x["n"].to_numpy(), y["n"].to_numpy(), x["component"].to_numpy(), y["component"].to_numpy()
    sets = [np.frombuffer(s, dtype=np.uint32) for s in y["short"]]
    # The band this bucket belongs to; pairs that share an earlier one are compared there.
    band = int(np.flatnonzero(bucket_keys(rx[0]) == bucket)[0])
    found = []
    for i in range(len(x)):
        ok = (cx[i] != cy) & (100 * np.minimum(nx[i], ny) >= share * np.maximum(nx[i], ny))
        if upper:
            ok[: i + 1] = False
        rows = np.flatnonzero(ok)
        equal = rx[i] == ry[rows]
        first = ~equal[:, : band * ROWS].reshape(len(rows), band, ROWS).all(axis=2).any(axis=1)
        rows, equal = rows[first], equal[first]
        rows = rows[equal.mean(axis=1) >= cut(share, np.minimum(nx[i], ny[rows]))]
        if len(rows):
            own, flat = np.frombuffer(x["short"].iloc[i], dtype=np.uint32), np.concatenate([sets[j] for j in rows])
            places = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            both = np.add.reduceat(own[places] == flat, np.cumsum([0, *(len(sets[j]) for j in rows[:-1])]))
            close = 200 * both >= (2 * share - 1) * (nx[i] + ny[rows] - both)
            found += [(x["node"].iloc[i], y["node"].iloc[j]) for j in rows[close]]
    return found


def across_components(members: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Pairs ``a, b`` of one bucket and different components that look similar, block by block."""
    placed = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    unsettled = (placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
                 .filter("low <> high").select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    left = placed.join(unsettled, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    left = stored(fewer(left, members.count(), MEMBERS_AT_ONCE))
    rows = left.agg(F.sum("blocks")).first()[0] or 0
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    meetings = left.select("node", "component", "bucket", "block", F.explode(others).alias("other")).select(
        "node", "component", "bucket", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    full = (meetings.join(classes.select("node", F.col("n_shingles").alias("n"), "registers"), "node").join(sets.select("node", "short"), "node")
            .withColumn("task", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(max(1, rows // TASK_ROWS)))))

    def compare(task: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (bucket, i, j), part in task.groupby(["bucket", "i", "j"]):
            x, y = part[part["block"] == i], part[part["block"] == j]
            if len(x) and len(y):
                found += similar_across(x, y, bucket, share, upper=i == j)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return full.groupBy("task").applyInPandas(compare, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Texts are linked if at least ``share`` percent of their joint shingles are common to
    both; a component is named by its smallest id. Null and empty texts, and texts of blanks
    only, have no shingles and are alone. Rows without an id are alone as well, unless their
    text equals another one: then they belong to its component and are not kept. Repeated rows get equal
    results. Ids are taken to be unique otherwise: rows of one id with different texts are
    linked with whatever either of them is linked with.
    """
    rows = narrow(docs, doc_id=doc_id, text=text)
    sketched = stored(sketches(rows))
    classes = sketched.filter("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"),
        F.first("buckets").alias("buckets"))
    classes = stored(fewer(classes, sketched.count(), CLASSES_AT_ONCE))
    n_classes = classes.count()
    members = classes.select("node", F.explode("buckets").alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1").select("bucket")
    members = stored(fewer(members.join(crowded, "bucket"), BANDS * n_classes, MEMBERS_AT_ONCE))
    sets = stored(shingle_sets(rows, members.select("node").distinct(), n_classes))

    edges = confirmed(hub_pairs(members), classes, sets, share)
    labels = components(edges)
    more = confirmed(stored(across_components(members, labels, classes, sets, share)), classes, sets, share)
    if more.head(1):
        labels = components(edges.union(more))
    named = classes.select("key", "node").join(labels, "node", "left").select(
        "key", F.coalesce("component", "node").alias("component"))
    return sketched.join(named, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.col("key").isNull() | F.col("component").isNull()).alias("kept"))


def keep_one(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """One row of each component, with its own columns: the one with the smallest id. Texts
    without words and rows linked with nothing all stay; repeated rows stay once."""
    columns = docs.columns
    own, words = unused(docs, "__kept", "__text")
    kept = linked(docs, share=share).filter("kept").select(F.col("doc_id").alias(own)).distinct()
    left = docs.join(kept, F.col("doc_id").eqNullSafe(F.col(own)), "left_semi")
    return left.withColumn(words, F.xxhash64("text")).dropDuplicates(["doc_id", words]).select(*[F.col(f"`{c}`") for c in columns])
