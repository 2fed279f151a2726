"""Repeated passages by suffix arrays, over anchors that equal passages share.

A byte string of ``LENGTH`` bytes has one anchor: of all its k-grams the leftmost of
smallest hash. Equal strings have the same anchor at the same place, so the strings of a
document form runs with a common anchor, and only runs with equal anchors need comparing.

1. A run whose whole content occurs again is repeated as a whole: counts of hashes decide.
2. Other runs that share their anchor with another run are cut into cells of ``CELL``
   starts. All strings of a cell have a core in common; cells whose cores differ share no
   string. Of cells with equal anchor and core, only the few bytes left and right of it
   can differ.
3. Those tails, with the core contracted to one symbol, are sorted by a suffix array, and
   a string is repeated if a neighbour in it starts with the same ``CELL`` symbols. Groups
   too large for one task compare their strings by hash counts, start by start.

The suffix array is built by linear grouping: suffixes are grouped by symbol and the groups
refined from the highest down, each moving the previous smaller suffixes of its members
behind their group; in the end each group holds the suffixes with one Lyndon prefix. A
single pass then emits the order within the groups. Nothing is renamed or sorted again.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.common import importable, narrow, sha256_hex, stored
from visitlake.llm.hyperminhash import mixed

LENGTH, GRAM, CELL = 400, 64, 32
CORE = LENGTH - CELL + 1
#: Strings handled at once, a text's long stretches are cut here; symbols in one suffix array; members of a group in one task.
STRETCH, SYMBOLS, LARGE = 200_000, 60_000, 2_000
POSITION = (1 << 18) - 1
CELLS_AT_ONCE = 20_000
RUNS = "doc_id long, text_hash long, runs array<struct<first:int,last:int,at:int,anchor:long,content:long>>"
CELLS = "doc_id long, text_hash long, at int, cell int, anchor long, core long, left binary, right binary"
PACKED = "doc_id long, text_hash long, data binary"
SPANS = "doc_id long, text_hash long, start int, end int"


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of all suffixes in order, by linear grouping. A suffix that ends is smaller than any that goes on."""
    n = len(symbols)
    members: list[list[int]] = []
    by_symbol: dict[int, int] = {}
    for symbol in sorted(set(symbols)):
        by_symbol[symbol] = len(members)
        members.append([])
    group = [by_symbol[s] for s in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    above, below = [g + 1 for g in range(len(members))], [g - 1 for g in range(len(members))]
    if members:
        above[-1] = -1
    smaller, done = [-1] * n, bytearray(n)
    order, current = [], len(members) - 1
    while current >= 0:
        mine = sorted(i for i in members[current] if group[i] == current)
        members[current] = mine
        reached: dict[int, int] = defaultdict(int)
        for i in mine:
            done[i] = 1
            j = i - 1
            while j >= 0 and done[j]:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                reached[j] += 1
        moved: dict[tuple[int, int], list[int]] = defaultdict(list)
        for j, times in reached.items():
            moved[group[j], times].append(j)
        last: dict[int, int] = {}
        for (old, times), those in sorted(moved.items()):
            behind, new = last.get(old, old), len(members)
            members.append(those)
            above.append(above[behind])
            below.append(behind)
            if above[behind] >= 0:
                below[above[behind]] = new
            above[behind] = new
            last[old] = new
            for j in those:
                group[j] = new
        if mine:
            order.append(current)
        current = below[current]
    free, at = {}, 0
    for g in reversed(order):
        free[g] = at
        at += len(members[g])
    out = [-1] * n
    j = n - 1
    while j >= 0:
        out[free[group[j]]] = j
        free[group[j]] += 1
        j = smaller[j]
    for i in range(n):
        start = out[i]
        j, stop = start - 1, smaller[start]
        while j != stop:
            out[free[group[j]]] = j
            free[group[j]] += 1
            j = smaller[j]
    return out


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, and the powers of the base and of its inverse."""
    base, size = 0x9E3779B97F4A7C15, STRETCH + LENGTH
    powers = np.full(size, base, dtype=np.uint64)
    inverse = np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)
    powers[0] = inverse[0] = 1
    symbols = np.random.default_rng(5).integers(0, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return symbols, np.multiply.accumulate(powers), np.multiply.accumulate(inverse)


class Hashes:
    """Hashes of any stretch of some bytes, equal for equal bytes wherever they stand."""

    def __init__(self, data: bytes):
        symbols, self.powers, inverse = tables()
        codes = symbols[np.frombuffer(data, dtype=np.uint8)]
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(codes * inverse[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.powers[start] + (end - start).astype(np.uint64))


def runs_of(data: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """(first start, last start, anchor position, anchor hash, content hash), stretch by stretch."""
    width = LENGTH - GRAM + 1
    for offset in range(0, len(data) - LENGTH + 1, STRETCH):
        part = data[offset : offset + STRETCH + LENGTH - 1]
        hashes, starts = Hashes(part), np.arange(len(part) - GRAM + 1)
        grams = hashes.of(starts, starts + GRAM)
        key = (grams & ~np.uint64(POSITION)) | starts.astype(np.uint64)
        count = len(part) - LENGTH + 1
        blocks = np.concatenate([key, np.full(-len(key) % width, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        anchor = (np.minimum(back[:count], ahead[width - 1 : width - 1 + count]) & np.uint64(POSITION)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.concatenate([first[1:] - 1, [count - 1]])
        at = anchor[first]
        content = hashes.of(first, last + LENGTH) ^ mixed((at - first).astype(np.uint64))
        yield first + offset, last + offset, at + offset, grams[at].view(np.int64), content.view(np.int64)


def as_bytes(text: object) -> bytes:
    return text.encode() if isinstance(text, str) else b""


def squeezed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts as they are sent through a shuffle: about half their size."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text_hash": batch["text_hash"], "data": [squeeze(as_bytes(t)) for t in batch["text"]]})


def unsqueezed(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def find_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ("first", "last", "at", "anchor", "content")
    for batch in batches:
        for start in range(0, len(batch), 256):
            part, rows = batch.iloc[start : start + 256], []
            for text in part["text"]:
                data = as_bytes(text)
                runs = [dict(zip(names, r, strict=True)) for found in runs_of(data) for r in zip(*(f.tolist() for f in found), strict=True)]
                rows.append(runs)
            yield part[["doc_id", "text_hash"]].astype("Int64").assign(runs=pd.Series(rows, index=part.index, dtype=object))


def cut_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The cells of a document's listed runs. Tails end where the run ends, so a string is in one cell only."""
    names = [c.split()[0] for c in CELLS.split(", ")]
    frame = lambda rows: pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
    for batch in batches:
        rows: list[tuple] = []
        for key, text_hash, packed, runs in zip(batch["doc_id"].astype("Int64"), batch["text_hash"], batch["data"], batch["runs"], strict=True):
            data = unsqueezed(packed)
            for run in runs:
                at, first, end = run["at"], run["first"], run["last"] + LENGTH
                for cell in range((at - run["last"]) // CELL, (at - first) // CELL + 1):
                    core = at - cell * CELL
                    digest = hashlib.blake2b(data[core : core + CORE], digest_size=8).digest()
                    rows.append((key, text_hash, at, cell, run["anchor"], int.from_bytes(digest, "little", signed=True),
                                 data[max(first, core - CELL + 1) : core], data[core + CORE : min(end, core + CORE + CELL - 1)]))
            if len(rows) >= CELLS_AT_ONCE:
                yield frame(rows)
                rows = []
        yield frame(rows)


def repeated_starts(contents: Sequence[tuple[int, bytes, bytes]]) -> list[list[int]]:
    """For distinct (group, left, right): how many bytes before the core a string starts that
    another member of the group holds as well."""
    symbols, place = [], []
    for group, left, right in contents:
        place.append(len(symbols) + len(left))
        symbols += [b + 1 for b in left]
        symbols.append(257 + group)
        symbols += [b + 1 for b in right]
        symbols.append(0)
    order = suffix_array(symbols)
    packed = np.array(symbols, dtype=np.uint32).tobytes()
    same, before = bytearray(len(symbols)), -1
    for start in order:
        if before >= 0 and packed[4 * start : 4 * (start + CELL)] == packed[4 * before : 4 * (before + CELL)]:
            same[start] = same[before] = 1
        before = start
    return [[t for t in range(max(0, CELL - 1 - len(right)), min(CELL - 1, len(left)) + 1) if same[core - t]]
            for core, (_, left, right) in zip(place, contents, strict=True)]


def compare_cells(cells: pd.DataFrame) -> pd.DataFrame:
    """Spans of repeated strings among cells; equal cells are told apart from a cell alone by their number."""
    groups: dict[tuple, dict[tuple, list[int]]] = defaultdict(lambda: defaultdict(list))
    for i, (anchor, cell, core, left, right) in enumerate(zip(*(cells[c] for c in ("anchor", "cell", "core", "left", "right")), strict=True)):
        groups[anchor, cell, core][left, right].append(i)
    found: dict[int, list[int]] = {}
    waiting: list[tuple[int, bytes, bytes]] = []
    owners: list[list[int]] = []
    size = 0

    def settle() -> None:
        for starts, rows in zip(repeated_starts(waiting), owners, strict=True):
            if len(rows) == 1:
                found[rows[0]] = starts
        waiting.clear()
        owners.clear()

    for number, members in enumerate(groups.values()):
        for (left, right), rows in members.items():
            if len(rows) > 1:
                for i in rows:
                    found[i] = list(range(max(0, CELL - 1 - len(right)), min(CELL - 1, len(left)) + 1))
        if len(members) > 1 and any(len(rows) == 1 for rows in members.values()):
            for (left, right), rows in members.items():
                waiting.append((number, left, right))
                owners.append(rows)
                size += len(left) + len(right) + 2
        if size > SYMBOLS:
            settle()
            size = 0
    settle()
    rows = []
    ids, hashes, at, cell = (cells[c].to_numpy() for c in ("doc_id", "text_hash", "at", "cell"))
    for i, starts in found.items():
        core = at[i] - cell[i] * CELL
        rows += [(ids[i], hashes[i], core - most, core - least + LENGTH) for least, most in stretches(starts)]
    return pd.DataFrame(rows, columns=["doc_id", "text_hash", "start", "end"]).astype({"doc_id": "Int64"})


def stretches(numbers: Sequence[int]) -> list[tuple[int, int]]:
    """First and last of each run of whole numbers that follow each other, of sorted ones."""
    out: list[tuple[int, int]] = []
    for n in numbers:
        if out and n == out[-1][1] + 1:
            out[-1] = (out[-1][0], n)
        else:
            out.append((n, n))
    return out


def spans_of_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One span for each run of repeated starts of a cell."""
    for batch in batches:
        rows = []
        for key, text_hash, at, cell, starts in zip(*(batch[c] for c in ("doc_id", "text_hash", "at", "cell", "starts")), strict=True):
            core = at - cell * CELL
            rows += [(key, text_hash, core - most, core - least + LENGTH) for least, most in stretches(sorted(starts))]
        yield pd.DataFrame(rows, columns=["doc_id", "text_hash", "start", "end"]).astype({"doc_id": "Int64"})


def large_groups(cells: DataFrame) -> DataFrame:
    """The same for groups too large for a task: a row for each string, counted by content."""
    t = F.explode(F.sequence(F.lit(0), F.lit(CELL - 1))).alias("t")
    strings = cells.select("*", t).filter((F.col("t") <= F.length("left")) & (CELL - 1 - F.col("t") <= F.length("right")))
    strings = strings.withColumn("string", F.expr(f"md5(concat(substring(left, length(left) - t + 1, t), substring(right, 1, {CELL - 1} - t)))"))
    key = ["anchor", "cell", "core", "t", "string"]
    often = strings.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key)
    # A cell has at most as many starts as it is wide; they leave as spans.
    repeated = strings.join(often, key).groupBy("doc_id", "text_hash", "at", "cell").agg(F.collect_set("t").alias("starts"))
    return repeated.mapInPandas(spans_of_cells, SPANS)


def united(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def repeated_spans(rows: DataFrame, large: int = LARGE) -> DataFrame:
    """Of ``doc_id, text, text_hash``: ``SPANS`` of repeated strings, not yet united."""
    scanned = stored(importable(rows).mapInPandas(find_runs, RUNS))
    runs = scanned.select("doc_id", "text_hash", F.explode("runs").alias("run")).select("doc_id", "text_hash", "run.*")
    counted = runs.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "text_hash", "first", "last", "at")).alias("sample"))
    counted = stored(counted)
    whole = runs.join(counted.filter("n > 1").select("anchor", "content"), ["anchor", "content"], "left_semi").select(
        "doc_id", "text_hash", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end"))

    shared = counted.groupBy("anchor").agg(F.count("*").alias("contents")).filter("contents > 1").select("anchor")
    open_runs = counted.join(shared, "anchor").select("sample.doc_id", "sample.text_hash", F.struct("sample.first", "sample.last", "sample.at", "anchor").alias("run"))
    wanted = open_runs.groupBy("doc_id", "text_hash").agg(F.collect_list("run").alias("runs")).toDF("w_id", "w_hash", "runs")
    # Rows that are repeated come more than once here; their strings are repeated by that alone.
    texts = rows.filter(F.octet_length("text") >= LENGTH).mapInPandas(squeezed, PACKED)
    joined = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash"))).select("doc_id", "text_hash", "data", "runs")
    cells = stored(joined.mapInPandas(cut_cells, CELLS))
    key = ["anchor", "cell", "core"]
    sizes = stored(cells.groupBy(*key).agg(F.count("*").alias("size")).filter("size > 1"))
    placed = cells.join(sizes, key)
    small, huge = placed.filter(F.col("size") <= large).drop("size"), placed.filter(F.col("size") > large).drop("size")
    total = sizes.filter(F.col("size") <= large).agg(F.sum("size")).first()[0] or 0
    buckets = max(1, total // large)
    compared = small.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets))).groupBy("bucket").applyInPandas(compare_cells, SPANS)
    return whole.union(compared).union(large_groups(huge))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row: each byte covered by a
    string of ``LENGTH`` bytes that also starts anywhere else is removed.

    Texts are UTF-8 bytes, a null one is empty; strings do not cross texts. Repeated rows
    repeat all their strings. A row without an id is a row like others. ``keep_text`` adds
    the remaining bytes as ``kept``.
    """
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    rows = narrow(docs, doc_id=doc_id, text=text).withColumn("text_hash", F.coalesce(F.xxhash64("text"), F.lit(0)))
    spans = repeated_spans(rows)
    by_row = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans")).toDF("w_id", "w_hash", "spans")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, whole, found in zip(batch["doc_id"], batch["data"], batch["spans"], strict=True):
                data, gone = unsqueezed(whole), united([(s["start"], s["end"]) for s in found] if found is not None else [])
                edges = [0, *(x for span in gone for x in span), len(data)]
                kept = b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                row = (key, len(data), len(data) - len(kept), len(gone), sha256_hex(kept))
                out.append((*row, kept) if keep_text else row)
            names = [c.split()[0] for c in columns.split(", ")]
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    joined = rows.mapInPandas(squeezed, PACKED).join(by_row, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")), "left")
    return joined.select("doc_id", "data", "spans").mapInPandas(cut, columns)
