"""Repeated passages of words by recompression.

A text is parsed in rounds. Each round first names every maximal run of one symbol by the
symbol and the run's length, then every pair of a left and a right symbol by the two, sides
being drawn by a hash of symbol and round. Names are hashes of what they stand for, so
all tasks give equal runs and equal pairs one name in every round, and a round needs no
exchange between them.

Every symbol knows its support: the words that decided that it stands there, its own and
those looked at to see where a run ends or that a symbol found no partner. Whoever reads
the same words finds the same symbol. So of all symbols whose support lies in a window, the
one of the highest round (of these: of smallest hash, then the leftmost) is the same in
every window with the same words: the window's anchor, called by the words of its support.

Neighbouring windows with equally named anchors form a run.

1. The least and the greatest document of every anchor are gathered, combined before the
   shuffle. Only anchors met in more than one document can belong to a shared window; a
   bitmap of fixed size keeps them.
2. Of those, anchors that stand in runs of more than one content are marked in another bitmap.
3. Runs of an anchor with one content are compared as a whole, the others window by window:
   the least document that holds a piece decides whether the others lose its words.

Texts that lose no word are not shuffled: a third bitmap tells them from the others.
Nothing else is sent about windows whose anchor stands in one document only, and a piece
that a third of all texts hold reaches the count as one row for each task and the join as a
key that adaptive execution splits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.common import importable, narrow, sha256_hex, stored
from visitlake.llm.hyperminhash import mixed

WINDOW, ROUNDS = 13, 2
#: Bytes and words handled at once, however texts are long or many, so few that their arrays stay in a core's cache. Bits of the anchors' bitmap.
BYTES, WORDS, BITS = 400_000, 80_000, 1 << 27
#: Bits of the bitmap of texts that lose words.
TEXT_BITS = 1 << 24
BASE = 0x9E3779B97F4A7C15
NO_ID = (1 << 63) - 1
#: Bits of an anchor's name that the first two steps group by; equal ones only make them keep more.
NAME_BITS = 40
ANCHORS = "anchor long, low long, high long"
PIECES = "anchor int, content long, doc_id long, text_hash int, start int, count int"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
U = np.uint64


@cache
def byte_codes() -> np.ndarray:
    return np.random.default_rng(13).integers(0, 1 << 63, size=256, dtype=U) * U(2) + U(1)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the byte it starts at."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    lengths = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) - starts + 1
    if not len(starts):
        return np.zeros(0, dtype=U), starts
    codes = byte_codes()[raw[inside]]
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(codes), dtype=np.int32) - np.repeat(first.astype(np.int32), lengths)
    codes *= powers(BASE, int(lengths.max()))[place]
    return mixed(np.add.reduceat(codes, first) + lengths.astype(U)), starts


def in_pieces(data: bytes) -> np.ndarray:
    """The same for one long text, cut between words."""
    found, at = [], 0
    blank = re.compile(rb"[ \t-\r]")
    while at < len(data):
        cut = blank.search(data, at + BYTES)
        end = cut.start() if cut else len(data)
        found.append(word_hashes(data[at:end])[0])
        at = end
    return np.concatenate(found) if found else np.zeros(0, dtype=U)


class Contents:
    """Hashes of stretches of words, equal for equal words wherever they stand."""

    def __init__(self, words: np.ndarray):
        self.powers = powers(BASE, len(words) + 1)
        self.sums = np.zeros(len(words) + 1, dtype=U)
        np.cumsum(words * powers(pow(BASE, -1, 1 << 64), len(words)), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.powers[start] + (end - start).astype(U))


def neighbours(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the symbol before and the one behind belong to the same row."""
    same = row[1:] == row[:-1]
    return np.concatenate([[False], same]), np.concatenate([same, [False]])


def shifted(values: np.ndarray, by: int) -> np.ndarray:
    """Of each place the value before (-1) or behind (1) it, at the ends its own."""
    return np.concatenate([values[:1], values[:-1]] if by < 0 else [values[1:], values[-1:]])


def rounds(words: np.ndarray, row: np.ndarray, count: int = ROUNDS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(symbol, support's first word, its end) of each symbol, round by round, the words first.

    A support that would need what lies before or behind a row reaches beyond the row."""
    symbol, low, high = words, np.arange(len(words)), np.arange(1, len(words) + 1)
    out = [(symbol, low, high)]
    for number in range(count):
        if not len(symbol):
            break
        # Runs: where one ends is seen by the symbols next to it.
        before, behind = neighbours(row)
        first = np.flatnonzero(~before | (symbol != shifted(symbol, -1)))
        last = np.append(first[1:], len(symbol)) - 1
        length = (last - first + 1).astype(U)
        own_low = np.where(before[first], shifted(low, -1)[first], low[first] - 1)
        own_high = np.where(behind[last], shifted(high, 1)[last], high[last] + 1)
        symbol = np.where(length > 1, mixed(symbol[first] * U(BASE) + length), symbol[first])
        low, high, row = own_low, own_high, row[first]
        # Pairs: a left symbol takes the right one behind it; one that finds none has looked at the next.
        before, behind = neighbours(row)
        left = (mixed(symbol + U(number + 1)) & U(1)).astype(bool)
        head = left & behind & ~shifted(left, 1)
        tail = before & shifted(head, -1)
        seen_high = np.where(left, np.where(behind, np.maximum(high, shifted(high, 1)), high + 1), high)
        seen_low = np.where(~left & ~tail, np.where(before, np.minimum(low, shifted(low, -1)), low - 1), low)
        pair = mixed(mixed(symbol) * U(3) + shifted(symbol, 1) * U(0xC2B2AE3D27D4EB4F))
        kept = np.flatnonzero(~tail)
        symbol, low, high, row = np.where(head, pair, symbol)[kept], seen_low[kept], seen_high[kept], row[kept]
        out.append((symbol, low, high))
    return out


def least_in(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least key of each range, none of them empty or longer than a window."""
    doubled, size = [key], 1
    while 2 * size <= WINDOW:
        shorter = doubled[-1]
        doubled.append(np.minimum(shorter, np.append(shorter[size:], shorter[-size:])))
        size *= 2
    level = np.log2(end - start).astype(np.int64)
    out = np.empty(len(start), dtype=key.dtype)
    for k, table in enumerate(doubled):
        at = level == k
        out[at] = np.minimum(table[start[at]], table[end[at] - (1 << k)])
    return out


def anchored(words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, Contents]:
    """Start and anchor of every window of the rows, and the hashes of the words."""
    starts = np.arange(max(0, len(words) - WINDOW + 1))
    starts = starts[row[starts] == row[starts + WINDOW - 1]]
    contents, anchor = Contents(words), np.zeros(len(starts), dtype=U)
    waiting = np.arange(len(starts))
    inside = lambda low, high: (low >= 0) & (high <= len(words)) & (high - low <= WINDOW)
    for symbol, low, high in reversed(rounds(words, row)):
        sound = inside(low, high)
        low, high = low[sound], high[sound]
        one_row = row[low] == row[high - 1]
        low, high = low[one_row], high[one_row]
        # Supports follow each other, so those inside a window are neighbours.
        p = starts[waiting]
        begun = np.cumsum(np.bincount(low, minlength=len(words) + 1))
        ended = np.cumsum(np.bincount(high, minlength=len(words) + 1))
        begin, end = np.where(p > 0, begun[p - 1], 0), ended[p + WINDOW]
        some = end > begin
        if some.any():
            name = contents.of(low, high)
            key = (mixed(name + U(1)) & ~U(0xFFFFFF)) | np.arange(len(name), dtype=U)
            anchor[waiting[some]] = name[(least_in(key, begin[some], end[some]) & U(0xFFFFFF)).astype(np.int64)]
        waiting = waiting[~some]
        if not len(waiting):
            break
    return starts, anchor, contents


@dataclass
class Windows:
    """Windows of some rows of a batch, and the runs they form."""

    row: np.ndarray
    start: np.ndarray
    anchor: np.ndarray
    content: np.ndarray
    first: np.ndarray
    count: np.ndarray
    run_content: np.ndarray

    @staticmethod
    def of(row: np.ndarray, start: np.ndarray, anchor: np.ndarray, at: np.ndarray, contents: Contents) -> Windows:
        """``at`` is where a window starts among the hashed words, ``start`` where in its own text."""
        new = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
        first = np.flatnonzero(np.concatenate([[True], new])[: len(row)])
        count = np.diff(np.append(first, len(row)))
        return Windows(row, start, anchor, contents.of(at, at + WINDOW), first, count, contents.of(at[first], at[first] + count + WINDOW - 1))


def as_bytes(text: object) -> bytes:
    return text.encode() if isinstance(text, str) else b""


def parsed(texts: pd.Series) -> Iterator[Windows]:
    """The windows of all texts, in bounded portions."""
    waiting, size = [], 0

    def together() -> Windows:
        words, at = word_hashes(b" ".join(data for _, data in waiting))
        ends = np.cumsum([len(data) + 1 for _, data in waiting])
        owner = np.searchsorted(ends, at, side="right")
        starts, anchor, contents = anchored(words, owner)
        first = np.searchsorted(owner, np.arange(len(waiting)))
        own = owner[starts]
        return Windows.of(np.array([number for number, _ in waiting])[own], starts - first[own], anchor, starts, contents)

    for number, text in enumerate(texts):
        data = as_bytes(text)
        if len(data) > BYTES:
            words = in_pieces(data)
            for offset in range(0, len(words) - WINDOW + 1, WORDS):
                part = words[offset : offset + WORDS + WINDOW - 1]
                starts, anchor, contents = anchored(part, np.zeros(len(part), dtype=np.int64))
                yield Windows.of(np.full(len(starts), number), starts + offset, anchor, starts, contents)
            continue
        if size + len(data) > BYTES:
            yield together()
            waiting, size = [], 0
        waiting.append((number, data))
        size += len(data) + 1
    if waiting:
        yield together()


def ids_of(batch: pd.DataFrame) -> np.ndarray:
    return batch["doc_id"].astype("Int64").fillna(NO_ID).to_numpy(dtype=np.int64)


def named(anchor: np.ndarray) -> np.ndarray:
    return (anchor >> U(64 - NAME_BITS)).astype(np.int64)


def marked(bitmap: np.ndarray, names: np.ndarray) -> np.ndarray:
    bit = names % (32 * len(bitmap))
    return (bitmap[bit >> 5] >> (bit & 31).astype(np.uint32) & np.uint32(1)).astype(bool)


def extremes(names: np.ndarray, values: np.ndarray) -> pd.DataFrame:
    """The least and the greatest value of each name."""
    order = np.argsort(names, kind="stable")
    names, values = names[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])[: len(names)])
    if not len(first):
        return pd.DataFrame({"anchor": first, "low": first, "high": first})
    return pd.DataFrame({"anchor": names[first], "low": np.minimum.reduceat(values, first), "high": np.maximum.reduceat(values, first)})


def find_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The least and the greatest document of each anchor, portion by portion."""
    for batch in batches:
        ids = ids_of(batch)
        for found in parsed(batch["text"]):
            yield extremes(named(found.anchor[found.first]), ids[found.row[found.first]])


def bits_of(anchors: DataFrame, bits: int) -> np.ndarray:
    """A bit for each anchor, whatever their number, as 32-bit words."""
    place = F.pmod("anchor", F.lit(bits))
    words = (anchors.select(place.alias("bit")).groupBy(F.expr("bit DIV 32").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 32 AS INT)))").alias("set")))
    # Gathered in long binary pieces, each a fixed part of the bitmap.
    pieces = words.groupBy(F.expr("word DIV 4096").alias("piece")).agg(F.collect_list(F.struct("word", "set")).alias("all"))
    out = np.zeros(bits // 32, dtype=np.uint32)
    for row in pieces.select(F.transform("all", lambda w: w["word"]).alias("words"), F.transform("all", lambda w: w["set"]).alias("sets")).toLocalIterator():
        out[np.array(row["words"], dtype=np.int64)] = np.array(row["sets"], dtype=np.int64).astype(np.uint32)
    return out


def spread(rows: DataFrame, found, bits: int) -> np.ndarray:
    """A bitmap of the anchors for which ``found`` gives more than one value."""
    each = rows.mapInPandas(found, ANCHORS).groupBy("anchor").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return bits_of(each.filter("low < high"), bits)


def pieces(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """``PIECES`` that may stand in more than one document: runs, or windows where runs of an anchor differ."""
    context, texts = rows.sparkSession.sparkContext, rows.select("doc_id", "text")
    shared = context.broadcast(spread(texts, find_anchors, bits))

    def find_contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for found in parsed(batch["text"]):
                names = named(found.anchor[found.first])
                met = marked(shared.value, names)
                yield extremes(names[met], found.run_content[met].view(np.int64))

    mixed_up = context.broadcast(spread(texts, find_contents, bits))

    def find_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, hashes = ids_of(batch), batch["text_hash"].to_numpy(dtype=np.int32)
            for found in parsed(batch["text"]):
                names = named(found.anchor[found.first])
                met, single = marked(shared.value, names), marked(mixed_up.value, names)
                runs = np.flatnonzero(met & ~single)
                windows = np.flatnonzero(np.repeat(met & single, found.count))
                at = np.concatenate([found.first[runs], windows])
                own = found.row[at]
                yield pd.DataFrame({
                    "anchor": found.anchor[at].astype(np.uint32).view(np.int32), "content": np.concatenate([found.run_content[runs], found.content[windows]]).view(np.int64),
                    "doc_id": ids[own], "text_hash": hashes[own], "start": found.start[at].astype(np.int32),
                    "count": np.concatenate([found.count[runs], np.ones(len(windows), dtype=np.int64)]).astype(np.int32)})

    return rows.mapInPandas(find_pieces, PIECES)


def without(data: bytes, gone: list[dict] | None) -> tuple[int, list[bytes]]:
    """How many words a text has, and those that no listed piece covers. Bytes are split at blanks, tabs and line ends of ASCII only."""
    words = data.split()
    if gone is None or not len(gone):
        return len(words), words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, [p["start"] for p in gone], 1)
    np.add.at(edges, [p["start"] + p["count"] - 1 + WINDOW for p in gone], -1)
    left = np.flatnonzero(np.cumsum(edges)[:-1] == 0)
    return len(words), [words[i] for i in left]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False, bits: int = BITS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row: each word covered by a window
    of ``WINDOW`` words that also starts in a document with a smaller id is removed.

    Words are separated by blanks, tabs and line ends of ASCII; a null or blank text has none, and one of
    fewer words than a window loses none. Windows do not cross texts, and are judged on what
    comes in. Rows of one id take nothing from each other; a row without an id comes after
    all that have one and takes nothing from any. ``keep_text`` adds the words that stay, joined by one space, as ``kept``.
    """
    columns = RESULT + ", kept string" * keep_text
    names = [c.split()[0] for c in columns.split(", ")]
    rows = narrow(importable(docs), doc_id=doc_id, text=text)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.hash("text").alias("text_hash"))
    held = pieces(rows, bits)
    least = held.groupBy("anchor", "content").agg(F.min("doc_id").alias("low"))
    gone = held.join(least, ["anchor", "content"]).filter("low < doc_id")
    own = F.when(F.col("doc_id") < NO_ID, F.col("doc_id"))
    by_row = stored(gone.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "count")).alias("gone")).select(own.alias("w_id"), F.col("text_hash").alias("w_hash"), "gone"))
    losing = rows.sparkSession.sparkContext.broadcast(bits_of(by_row.select(F.xxhash64("w_id", "w_hash").alias("anchor")), min(bits, TEXT_BITS)))

    def result(data: bytes, lost: list[dict] | None) -> tuple:
        count, left = without(data, lost)
        kept = b" ".join(left)
        out = (count, count - len(left), sha256_hex(kept))
        return (*out, kept.decode()) if keep_text else out

    def whole_or_packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Texts that lose nothing are done; others are sent through the shuffle at about half their size."""
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            sent = marked(losing.value, batch["name"].to_numpy(dtype=np.int64))
            out = [(squeeze(as_bytes(t)), *[None] * (len(names) - 1)) if to_be_cut else (None, *result(as_bytes(t), None)) for t, to_be_cut in zip(batch["text"], sent, strict=True)]
            done = pd.DataFrame(out, columns=["data", *names[1:]]).astype({"n_words": "Int64", "n_removed": "Int64"})
            yield done.assign(doc_id=batch["doc_id"].astype("Int64"), text_hash=batch["text_hash"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_up = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            done = zip(*(batch[n] for n in names[1:]), strict=True)
            out = [(key, *(row if data is None else result(open_up(data), lost)))
                   for key, data, lost, row in zip(batch["doc_id"], batch["data"], batch["gone"], done, strict=True)]
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64", "n_words": "Int64", "n_removed": "Int64"})

    # Bits are told by the remainder, so a name counts without its sign.
    named_rows = rows.withColumn("name", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(min(bits, TEXT_BITS))))
    packed = named_rows.mapInPandas(whole_or_packed, "text_hash int, data binary, " + columns)
    joined = packed.join(by_row, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")), "left")
    return joined.select(*names, "data", "gone").mapInPandas(cut, columns)
