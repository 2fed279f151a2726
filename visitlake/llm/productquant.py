"""Near duplicates among embeddings by product quantisation.

Equal vectors form a class that takes part once, with its size. Coarse centroids cut the
classes into lists; the residual to the list's centroid is coded by the nearest of 256
centroids in each of ``SUBSPACES`` subspaces, and what the code leaves over is coded ``FINER``
times more in the same way. A code thus tells its vector up to a small known error.

Which vectors meet is decided by places: a place is a pair of directions, one in either half of
the rotated space, and a vector is filed at the places that it lies furthest along, some in each of
``TABLES`` rotations. How many directions and how many places are needed is measured on the
sample: neighbours at the limit, moved off a vector in even directions and in those in which the vectors
differ, have to share a place in at least ``RECALL`` of the cases; of the settings that do, the one with
the least work is taken, and if none does, or it is less work, all vectors have one place in common.

Codes meet first, place by place. Table lookups give their distances, and by the triangle
inequality no pair within reach is lost. Only vectors that come close to another
at a place are sent there whole, to be compared exactly, in double precision; a pair
is counted at the first place it shares. Both steps go in as many rounds as keep what is on its way
below the size of the vectors. A crowded place is cut into blocks that meet pair by pair in different
tasks, and returns counts and a spanning forest of its links, never all of them.

Vectors of one length are compared with each other, each length by an index of its own.
Centroids and places are fitted on at most ``TRAIN`` classes of it, picked by hash; every row is indexed.
"""

from __future__ import annotations

import gc
import math
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.common import importable, narrow, stored
from visitlake.llm.components import components

LIMIT, TRAIN, MAX_LISTS, SUBSPACES, CODES, BLOCK, ROUNDS = 0.9, 16_384, 1024, 8, 256, 512, 8
#: Codes of what a code leaves over; rotations; the most places in each; of neighbours at the limit, the share that has to meet.
FINER, TABLES, MOST, RECALL = 2, 4, 12, 0.9995
#: Seconds that a row at a place, a pair there and a place take, roughly: they weigh the settings against each other.
ROW_S, PAIR_S, PLACE_S = 5e-6, 3e-9, 3e-5
#: Bytes one task takes at a time, and bytes on their way that are never worth a round more.
AT_ONCE, LITTLE = 4 << 20, 1 << 28
INDEXED = "node long, list int, codes binary, error float, places binary"
FOUND = "a long, b long, n_links long"


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances to all centroids, and the nearest one."""
    squared = (points**2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(1)
    return np.maximum(squared, 0), squared.argmin(1)


def owners(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([nearest(points[s : s + 1024], centroids)[1] for s in range(0, len(points), 1024)])


def k_means(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centroids = points[rng.choice(len(points), size=min(k, len(points)), replace=False)]
    for _ in range(ROUNDS):
        own = owners(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        counts = np.bincount(own, minlength=len(centroids))
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def split(points: np.ndarray) -> list[np.ndarray]:
    return np.array_split(points, min(SUBSPACES, points.shape[1]), axis=1)


def looked_at(parts: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    return np.concatenate([p[codes[:, i]] for i, p in enumerate(parts)], axis=1)


@dataclass
class Codebook:
    centroids: np.ndarray
    parts: list[np.ndarray]
    limit: float
    finer: list[list[np.ndarray]] = field(default_factory=list)

    @staticmethod
    def fit(points: np.ndarray, total: int, limit: float) -> Codebook:
        lists = max(1, min(MAX_LISTS, math.isqrt(total), len(points)))
        centroids = k_means(points, lists, seed=1)
        residuals = points - centroids[owners(points, centroids)]
        layers = []
        for layer in range(1 + FINER):
            layers.append([k_means(part, CODES, seed=2 + i + SUBSPACES * layer) for i, part in enumerate(split(residuals))])
            codes = np.stack([owners(r, p) for r, p in zip(split(residuals), layers[-1], strict=True)], axis=1)
            residuals = residuals - looked_at(layers[-1], codes)
        return Codebook(centroids, layers[0], limit, layers[1:])

    @property
    def reach(self) -> float:
        """Distance of two unit vectors at the limit."""
        return math.sqrt(2 - 2 * self.limit)

    def encode(self, points: np.ndarray, lists: np.ndarray, finer: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and how far each code is off its vector."""
        left, codes = points - self.centroids[lists], []
        for parts in [self.parts, *self.finer] if finer else [self.parts]:
            codes.append(np.stack([(r.astype(np.float32) @ p.T.astype(np.float32) - (p**2).sum(1).astype(np.float32) / 2).argmax(1)
                                   for r, p in zip(split(left), parts, strict=True)], axis=1))
            left = left - looked_at(parts, codes[-1])
        return np.concatenate(codes, axis=1).astype(np.uint8), np.linalg.norm(left, axis=1)

    def decoded(self, lists: np.ndarray | int, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for, summed from the tables."""
        total, codes = self.centroids[np.broadcast_to(lists, len(codes))], np.ascontiguousarray(codes.T)
        for i, column in enumerate(codes):
            layer, part = divmod(i, len(self.parts))
            split(total)[part][:] += [self.parts, *self.finer][layer][part][column]
        return total

    def single(self) -> Codebook:
        """The same in single precision."""
        short = lambda parts: [p.astype(np.float32) for p in parts]
        return Codebook(self.centroids.astype(np.float32), short(self.parts), self.limit, [short(parts) for parts in self.finer])

    def looked_up(self, queries: np.ndarray, at: np.ndarray | int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of queries to codes of one list, or of a list each."""
        return nearest(queries, self.decoded(at, codes))[0]


def furthest(first: np.ndarray, second: np.ndarray, r: int) -> np.ndarray:
    """Numbers of the ``r`` pairs, of a column of ``first`` and one of ``second``, with the largest sums; the largest first."""
    k, rows = first.shape[1], np.arange(len(first))[:, None]
    r, best = min(r, k * k), []
    for scores in (first, second):
        some = np.argpartition(scores, k - min(r, k), axis=1)[:, k - min(r, k) :]
        best.append(np.take_along_axis(some, np.argsort(-scores[rows, some], axis=1, kind="stable"), 1))
    i, j = np.array([(i, j) for i in range(min(r, k)) for j in range(min(r, k)) if (i + 1) * (j + 1) <= r]).T  # others have r larger ones
    i, j = best[0][:, i], best[1][:, j]
    order = np.argsort(-(first[rows, i] + second[rows, j]), axis=1, kind="stable")[:, :r]
    return np.take_along_axis(i * k + j, order, 1)


@dataclass
class Places:
    """No tables: one place for all."""

    mean: np.ndarray
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    each: int = 1

    @property
    def held(self) -> int:
        return self.each * max(1, len(self.tables))

    def ranked(self, points: np.ndarray, each: int) -> np.ndarray:
        """The places of each row, in every table from the furthest on: row, table, rank."""
        if len(points) > 1024:
            return np.concatenate([self.ranked(points[s : s + 1024], each) for s in range(0, len(points), 1024)])
        out = []
        for t, (turn, first, second) in enumerate(self.tables):
            turned = ((points - self.mean) @ turn).astype(np.float32)
            half = first.shape[1]
            out.append(t * len(first) ** 2 + furthest(turned[:, :half] @ first.T, turned[:, half:] @ second.T, each))
        return np.stack(out, axis=1)

    def of(self, points: np.ndarray) -> np.ndarray:
        if not self.tables:
            return np.zeros((len(points), 1), dtype=np.int32)
        return np.sort(self.ranked(points, self.each).reshape(len(points), -1), axis=1).astype(np.int32)

    @staticmethod
    def fit(points: np.ndarray, total: int, limit: float) -> Places:
        width, mean = points.shape[1], points.mean(0)
        best, least = Places(mean, []), total * (total / (4 * BLOCK) * ROW_S + total / 2 * PAIR_S)
        if total <= len(points) or width < 4:
            return best
        rng = np.random.default_rng(3)
        near, away = points[rng.permutation(len(points))[:8192]], []
        for turned in (rng.normal(size=near.shape), points[rng.integers(len(points), size=len(near))] - points[rng.integers(len(points), size=len(near))]):
            turned = turned - (turned * near).sum(1, keepdims=True) * near
            size = np.linalg.norm(turned, axis=1, keepdims=True)
            away.append((size > 1e-9)[:, 0])
            away.append(limit * near + math.sqrt(1 - limit**2) * turned / np.maximum(size, 1e-9))
        k = 8
        while k <= min(MAX_LISTS, len(points)) and min(TABLES * k * k, total) * PLACE_S < least:
            tables = []
            for _ in range(TABLES):
                turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
                drawn = (points[rng.choice(len(points), size=k, replace=False)] - mean) @ turn
                halves = drawn[:, : width // 2], drawn[:, width // 2 :]
                tables.append((turn, *[(h / np.maximum(np.linalg.norm(h, axis=1, keepdims=True), 1e-12)).astype(np.float32) for h in halves]))
            tried = Places(mean, tables)
            own, needed = tried.ranked(near, MOST), []
            rank = np.maximum(np.arange(own.shape[2])[:, None], np.arange(own.shape[2])[None])
            for sound, moved in (away[:2], away[2:]):
                there = tried.ranked(moved, MOST)
                meets = np.stack([np.where(own[:, t, :, None] == there[:, t, None, :], rank, MOST).min((1, 2)) for t in range(TABLES)]).min(0)
                needed.append(1 + np.quantile(meets[sound], RECALL, method="higher") if sound.any() else 1)
            each = int(max(needed))
            if each <= own.shape[2]:
                tried.each = each
                counts = np.unique(tried.of(points), return_counts=True)[1].astype(float)
                meeting = (counts * (counts - 1)).sum() / len(points) / (len(points) - 1)  # places a pair shares, on average
                work = total * (tried.held * ROW_S + total * meeting / 2 * PAIR_S) + min(TABLES * k * k, total * tried.held) * PLACE_S
                if work < least:
                    best, least = tried, work
            k *= 2
        return best


@dataclass
class Spread:
    """Who meets where: a crowded place (``crowded``, sorted) is cut into blocks, and each pair of blocks is a slot."""

    crowded: np.ndarray
    blocks: np.ndarray
    more: float

    @staticmethod
    def of(places: np.ndarray, total: int) -> Spread:
        at, counts = np.unique(places, return_counts=True)
        expected, size = counts * (total / len(places)), 4 * BLOCK
        crowded = (expected > (2 * size if len(at) > 1 else size)) & (counts > 2)
        blocks = np.minimum(np.ceil(expected[crowded] / size), 0xFFFF).astype(np.int64)
        return Spread(at[crowded].astype(np.int64), blocks, float((expected[crowded] * (blocks - 1)).sum()))

    def slots(self, nodes: np.ndarray, places: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, slot and block of the row there, for all places that ``held`` says a row has."""
        rows, columns = np.nonzero(held)
        places = places[rows, columns].astype(np.int64)
        at = np.searchsorted(self.crowded, places)
        is_crowded = np.zeros(len(places), dtype=bool)
        if len(self.crowded):
            is_crowded = self.crowded[np.minimum(at, len(self.crowded) - 1)] == places
        plain = ~is_crowded
        out = [(rows[plain], places[plain] << 32, np.zeros(plain.sum(), dtype=np.int64))]
        for c in np.unique(at[is_crowded]):
            own, n = rows[is_crowded & (at == c)], int(self.blocks[c])
            mine = (mixed(nodes[own]) % np.uint64(n)).astype(np.int64)
            own, mine, other = np.repeat(own, n), np.repeat(mine, n), np.tile(np.arange(n), len(own))
            out.append((own, (self.crowded[c] << 32) | (np.minimum(mine, other) << 16) | np.maximum(mine, other), mine))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def mixed(numbers: np.ndarray) -> np.ndarray:
    x = numbers.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def unit(vectors: np.ndarray) -> np.ndarray:
    rows = vectors.astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Edges (row, column) that connect all that a block's links connect."""
    rows, columns = adjacent.shape
    label, kept = np.arange(columns), []  # of the columns; a row joins those that it links
    for x in range(rows):
        there = np.flatnonzero(adjacent[x])
        labels = label[there]
        if len(there) and (labels == labels[0]).all():
            kept.append((x, int(there[0])))
        elif len(there):
            labels, first = np.unique(labels, return_index=True)
            kept += [(x, int(y)) for y in there[first]]
            label[np.isin(label, labels)] = labels[0]
    return kept


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Those of the edges that connect all that they connect together."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root, kept = list(range(len(names))), []
    for e, (x, y) in enumerate(zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True)):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[x] = y
            kept.append(e)
    return np.column_stack([a[kept], b[kept]]).astype(np.int64)


def classes_of(vectors: DataFrame) -> DataFrame:
    """The rows with a ``key`` of 128 bits, the same for equal vectors; it is null where the vector links with nothing."""
    wide = F.col("embedding").cast("array<double>")
    # array_contains is null if it is not there and there is a null; hashes of 0.0 and -0.0 are the same.
    whole = F.coalesce(~F.array_contains(wide, F.lit(float("nan"))), F.lit(False))
    high, low = F.array_max(wide), F.array_min(wide)
    sound = whole & (high < float("inf")) & (low > -float("inf")) & ((high != 0) | (low != 0))
    return vectors.withColumn("key", F.when(sound, F.struct(F.xxhash64(wide).alias("h1"), F.xxhash64(F.lit(1), wide).alias("h2"))))


def matrix(vectors: pd.Series, dtype: str) -> np.ndarray:
    return np.concatenate(vectors.to_list()).astype(dtype).reshape(len(vectors), -1)


def unpacked(column: pd.Series, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=dtype).reshape(len(column), -1)


def released(df: DataFrame) -> None:
    """Shuffle files go once the driver's JVM has collected what refers to them; its listeners may do so for a moment yet."""
    for _ in range(2):
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
        time.sleep(0.3)


Records = Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray, np.ndarray]]


def met(rows: DataFrame, spread: Spread, dtype: np.dtype, records: Records, compare: Callable[[np.ndarray], pd.DataFrame], schema: str, n: float, most: int) -> DataFrame:
    """What ``compare`` returns for the records of each part of the slots, sorted by slot. ``records`` makes them of a batch of rows,
    with their places and which of these count; about ``n`` are made, and at most some ``most`` bytes at a time are on their way."""
    rounds = max(1, math.ceil(n * dtype.itemsize / max(most, LITTLE)))
    parts = max(64, math.ceil(n * dtype.itemsize / rounds / AT_ONCE))

    def dealt(now: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                made, places, held = records(batch)
                if rounds > 1:
                    held = held & (mixed(places) % np.uint64(rounds) == now)
                row, slot, mine = spread.slots(made["node"], places, held)
                part = (mixed(slot) // np.uint64(rounds) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                part, row = part[order], row[order]
                starts = np.flatnonzero(np.diff(part, prepend=-1))
                some = max(1, len(starts) * AT_ONCE // max(1, len(part) * dtype.itemsize))
                for s in range(0, len(starts), some):  # the copies of few parts at a time
                    begin, end = starts[s], starts[s + some] if s + some < len(starts) else len(part)
                    out = made[row[begin:end]]
                    out["slot"], out["mine"] = slot[order[begin:end]], mine[order[begin:end]]
                    cuts = [*(starts[s : s + some] - begin), end - begin]
                    yield pd.DataFrame({"part": part[starts[s : s + some]], "data": [out[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]})

        return deal

    def gathered(there: pd.DataFrame) -> pd.DataFrame:
        found = np.frombuffer(b"".join(there["data"]), dtype=dtype)
        return compare(found[np.argsort(found["slot"], kind="stable")])

    out = None
    for now in range(rounds):
        part = stored(rows.mapInPandas(dealt(now), "part long, data binary").groupBy("part").applyInPandas(gathered, schema))
        out = part if out is None else out.union(part)
        if n * dtype.itemsize > LITTLE:
            released(rows)
    return out


def cells(slots: np.ndarray, mine: np.ndarray) -> Iterator[tuple[int, np.ndarray | slice, np.ndarray | slice, bool]]:
    """Place, the rows on either side, and whether both sides are the same; ``slots`` are sorted."""
    cuts = [*np.flatnonzero(np.diff(slots, prepend=-1)).tolist(), len(slots)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        slot = int(slots[a])
        i, j = slot >> 16 & 0xFFFF, slot & 0xFFFF
        if i == j:
            if b > a + 1:
                yield slot >> 32, slice(a, b), slice(a, b), True
        else:
            first = mine[a:b] == i
            if first.any() and not first.all():
                yield slot >> 32, a + np.flatnonzero(first), a + np.flatnonzero(~first), False


def earlier(place: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the rows' places, the sets x and y of each, meet at a place before this one."""
    both = np.concatenate([x, y])
    names, at, counts = np.unique(np.where((both < 0) | (both >= place), -1, both), return_inverse=True, return_counts=True)
    at, wanted = at.reshape(both.shape), np.flatnonzero((names >= 0) & (counts > 1))
    shared = np.zeros((len(x), len(y)), dtype=bool)
    for s in range(0, len(wanted), 2048):
        column = np.full(len(names), 2048)
        column[wanted[s : s + 2048]] = np.arange(len(wanted[s : s + 2048]))
        holds = np.zeros((len(both), 2049), dtype=np.float32)
        holds[np.arange(len(both))[:, None], column[at]] = 1
        shared |= holds[: len(x), :2048] @ holds[len(x) :, :2048].T > 0
    return shared


def links_of(classes: DataFrame, total: int, dtype: str, limit: float) -> DataFrame:
    """Counts and spanning links (``a, b, n_links``) of ``total`` classes of one length: ``node, n, embedding``."""
    # First by share, so that no task or the driver sorts more than a little over what is kept.
    drawn = classes.filter(F.pmod("node", F.lit(1_000_000_007)) < int(min(1.0, 1.5 * TRAIN / total) * 1_000_000_007))
    sample = drawn.orderBy("node").limit(TRAIN).select("embedding").toPandas()["embedding"]
    points = unit(matrix(sample, dtype))
    book, filed = Codebook.fit(points, total, limit), Places.fit(points, total, limit)
    short, halved = book.single(), (book.centroids**2).sum(1).astype(np.float32) / 2
    spread, width = Spread.of(filed.of(points), total), points.shape[1]
    most = total * width * np.dtype(dtype).itemsize
    if most > LITTLE:
        released(classes)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.iloc[start : start + 1024]
                points = unit(matrix(part["embedding"], dtype))
                own = (points.astype(np.float32) @ short.centroids.T - halved).argmax(1)
                codes, error = book.encode(points, own, finer=True)
                yield pd.DataFrame({"node": part["node"].to_numpy(), "list": own, "codes": [c.tobytes() for c in codes],
                                    "error": error.astype(np.float32), "places": [p.tobytes() for p in filed.of(points)]})

    indexed = stored(classes.select("node", "embedding").mapInPandas(index, INDEXED))
    n_codes = len(book.parts) * (1 + FINER)
    code = np.dtype([("slot", "<i8"), ("mine", "<u2"), ("node", "<i8"), ("list", "<u2"), ("codes", "u1", (n_codes,)), ("error", "<f4")])
    whole = np.dtype([("slot", "<i8"), ("mine", "<u2"), ("node", "<i8"), ("n", "<i8"), ("places", "<i4", (filed.held,)), ("vector", dtype, (width,))])

    def coded(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        made = np.zeros(len(batch), dtype=code)
        made["node"], made["list"], made["error"] = batch["node"], batch["list"], batch["error"]
        made["codes"], places = unpacked(batch["codes"], np.uint8), unpacked(batch["places"], np.int32)
        return made, places, np.ones(places.shape, dtype=bool)

    def come_close(there: np.ndarray) -> pd.DataFrame:
        # What is left of the squared reach, halved, as the product of a row of either: at least 0 if within the reach and both errors.
        left, right = np.empty((2, len(there), width + 3), dtype=np.float32)
        for s in range(0, len(there), 2048):
            some = there[s : s + 2048]
            points, error = short.decoded(some["list"], some["codes"]), some["error"]
            spare = (book.reach**2 + error**2 + 2 * book.reach * error - (points**2).sum(1)) / 2
            for half, more in ((left, (error, spare, 1)), (right, (error, 1, spare - book.reach**2 / 2))):
                half[s : s + 2048, :width] = points
                for i, column in enumerate(more):
                    half[s : s + 2048, width + i] = column
        close = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
        for place, x, y, same in cells(there["slot"], there["mine"]):
            from_x, to_y, live = left[x], right[y].T, 0
            for s in range(0, len(from_x), 1024):
                spare = from_x[s : s + 1024] @ to_y
                if same:
                    at = np.arange(len(spare))
                    spare[at, s + at] = -1
                else:
                    live = np.maximum(live, spare.max(0))
                mine = np.flatnonzero(spare.max(1) >= -1e-4)
                if len(mine):
                    close.append((there["node"][x][s + mine], np.full(len(mine), place)))
            if not same:
                mine = np.flatnonzero(live >= -1e-4)
                close.append((there["node"][y][mine], np.full(len(mine), place)))
        nodes, places = (np.concatenate(c) for c in zip(*close, strict=True))
        out = pd.DataFrame({"node": nodes, "place": places.astype(np.int32)})
        return out.drop_duplicates() if len(spread.crowded) else out

    n = total * filed.held + spread.more
    close = met(indexed, spread, code, coded, come_close, "node long, place int", n, most)
    live = stored(close.groupBy("node").agg(F.sort_array(F.collect_set("place")).alias("places")).join(classes.select("node", "n", "embedding"), "node"))
    if n * code.itemsize > LITTLE:
        released(live)
    n_live = live.agg(F.sum(F.size("places"))).first()[0] or 0

    def sent(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        made = np.zeros(len(batch), dtype=whole)
        made["node"], made["n"], made["places"] = batch["node"], batch["n"], -1
        made["vector"] = matrix(batch["embedding"], dtype)
        sizes = batch["places"].map(len).to_numpy()
        held = np.arange(filed.held) < sizes[:, None]
        made["places"][held] = np.concatenate(batch["places"].to_list())
        return made, made["places"], held

    def compare(there: np.ndarray) -> pd.DataFrame:
        points, nodes, weights, at = unit(there["vector"]), there["node"], there["n"], np.arange(len(there))
        counts, edges, few = np.zeros(len(there), dtype=np.int64), [np.zeros((0, 2), dtype=np.int64)], [(np.zeros(0, dtype=np.int64),) * 3]
        for place, x, y, same in cells(there["slot"], there["mine"]):
            for s in range(0, len(at[x]), 2048):
                rows, columns = at[x][s : s + 2048], at[y]
                dots = points[rows] @ points[columns].T
                linked = dots >= limit - 1e-9
                if same:
                    linked &= rows[:, None] < columns
                i, j = np.nonzero(linked)
                if not len(i):
                    continue
                for e in np.flatnonzero(dots[i, j] < limit + 1e-9):  # as one pair alone would be
                    linked[i[e], j[e]] = points[rows[i[e]]] @ points[columns[j[e]]] >= limit
                if len(i) <= 1000:
                    i, j = np.nonzero(linked)
                    few.append((rows[i], columns[j], np.full(len(i), place)))
                    continue
                rows, columns, linked = rows[some := linked.any(1)], columns[others := linked.any(0)], linked[np.ix_(some, others)]
                if filed.held > 1:
                    linked &= ~earlier(place, there["places"][rows], there["places"][columns])
                counts[rows] += linked @ weights[columns]
                counts[columns] += linked.T @ weights[rows]
                pairs = np.array(forest(linked), dtype=np.int64).reshape(-1, 2)
                edges.append(np.column_stack([nodes[rows[pairs[:, 0]]], nodes[columns[pairs[:, 1]]]]))
        i, j, place = (np.concatenate(c) for c in zip(*few, strict=True))
        for s in range(0, len(i) if filed.held > 1 else 0, 10_000):
            some = slice(s, s + 10_000)
            first, second, here = there["places"][i[some]].T.copy(), there["places"][j[some]].T.copy(), place[some].astype(np.int32)
            second[(second < 0) | (second >= here)] = -2
            shared = np.zeros(second.shape, dtype=bool)
            for of_first in first:
                shared |= second == of_first
            place[some][shared.any(0)] = -1
        i, j = i[place >= 0], j[place >= 0]
        np.add.at(counts, i, weights[j])
        np.add.at(counts, j, weights[i])
        edges.append(spanning(nodes[i], nodes[j]))
        held, edges = counts > 0, np.concatenate(edges)
        return pd.concat([
            pd.DataFrame({"a": nodes[held], "b": None, "n_links": counts[held]}),
            pd.DataFrame({"a": edges[:, 0], "b": edges[:, 1], "n_links": 0}),
        ]).astype({"a": "Int64", "b": "Int64", "n_links": "int64"})

    return met(live, spread, whole, sent, compare, FOUND, n_live + min(spread.more, n_live * float(max(spread.blocks, default=0))), most)


def linked(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", limit: float = LIMIT) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    ``n_links`` counts the other rows whose cosine is at least ``limit``, equal vectors
    among them; a component is named by its smallest id. Null, empty and zero vectors and those
    with null or non-finite components link with nothing; vectors link with those of their own
    length only. Rows of one id are taken for rows of their own, with equal results if
    equal; rows without an id count as links but name no component.
    """
    rows = narrow(importable(vectors), vec_id=vec_id, embedding=embedding)
    dtype = "<f4" if "float" in dict(rows.dtypes)["embedding"] else "<f8"
    rows = classes_of(rows)
    keyed = stored(rows.select("vec_id", "key"))  # the vectors are kept once, with the classes
    named = rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("embedding").alias("embedding"))
    classes = stored(named.withColumn("node", F.xxhash64("key")).withColumn("length", F.size("embedding")))
    totals = {r["length"]: r["total"] for r in classes.groupBy("length").agg(F.count("*").alias("total")).collect()}
    plain = keyed.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not totals:
        return plain
    # A class that is the only one of its length has its own rows to link with, and no other.
    found = classes.select(F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(0).cast("long").alias("n_links")).limit(0)
    for length, total in sorted(totals.items()):
        if total > 1:
            found = found.union(links_of(classes.filter(F.col("length") == length), total, dtype, limit))
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n_links").alias("others"))
    labels = components(found.filter("b IS NOT NULL"))
    placed = (classes.select("key", "node", "first", "n").join(counts, "node", "left").join(labels, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    least = placed.groupBy("component").agg(F.min("first").alias("least"))
    by_key = placed.join(least, "component").select("key", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "least")
    out = keyed.select("vec_id", "key").join(by_key, "key", "left")
    component = F.coalesce("least", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"))
