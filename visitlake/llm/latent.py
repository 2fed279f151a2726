"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into passages of ``2 * HALF`` words that overlap by
half. Words are hashed into ``FEATURES`` columns and weighted by inverse document frequency
over the halves of all distinct texts: it reaches 0 for no word, and long texts do not make
all columns frequent. Which words are common is counted by the word, not by its column, for
every word of an item. A randomised decomposition of the passage matrix gives the latent
space: one pass multiplies the matrix and its transpose with a random block (each task
sums its own passages, sums are combined before the shuffle), and the small result is
decomposed on the driver, whose share does not depend on the number of documents. The
coordinates are divided by the singular values, so that what all passages of a language
have in common does not make them close.

Passages and items that are close in the latent space are candidates, unless too few words
of the item stand around the passage for it to have leaked. For the rest the longest common subsequence of the item's words and the passage with its surroundings
is found, for the whole item, for its content (words that at most ``COMMON`` of the texts
hold) and for its answer, the last content words. Copies of an item make its own words
common, and in a small table all words are: an item with little content left needs no
closeness, half of its words around a passage are enough to compare them, and the rarer half
of its words stands for its content. An item has leaked if most of its words occur in order, or,
as in a paraphrase, half of the words and of the content but almost all of the answer.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.common import importable, narrow, stored, unused

HALF, FEATURES, RANK, EXTRA = 16, 1 << 14, 64, 8
COMMON = 0.1
#: Items with a smaller share of content, or fewer words of it than an answer has, are compared without the latent space.
LITTLE = 0.25
#: Cosine of a candidate; shares of an item and of its answer that must occur in order.
CLOSE, COPIED, SIMILAR, ANSWERED = 0.15, 0.8, 0.5, 0.8
ANSWER_SHARE, LEAST_ANSWER = 0.25, 4
#: Items compared in one pass over the documents; more items take more passes.
ITEMS_AT_ONCE, TEXTS_AT_ONCE, CHUNK_BYTES = 1_000, 128, 1_000_000
#: Rows of a ``sampled`` table, about.
FITTED = 50_000
#: Bytes of a word that is hashed together with others. Partitions fitted by one task, each task sends one sum.
SHORT, FITTED_AT_ONCE = 64, 8
WORD = re.compile(r"\w+")
#: What ends a word: beyond ASCII, and as a byte of a text in which that has become a blank.
BEYOND, END, ASCII = re.compile(r"[^\w\x00-\x7f]"), re.compile(rb"[^0-9A-Za-z_\x80-\xff]"), bytes(range(128))


def words_of(text: object) -> list[str]:
    return WORD.findall(text.lower()) if isinstance(text, str) else []


def hashed(words: Sequence[str]) -> np.ndarray:
    """32 bits of each word. Nothing is remembered between texts, so many rare words cost no memory."""
    return np.fromiter(map(zlib.crc32, map(str.encode, words)), dtype=np.uint32, count=len(words))


@cache
def checksums() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether a byte is part of a word; what it changes in a CRC-32, by the bytes that follow it; the CRC-32 of zero bytes."""
    letter = np.array([not END.match(bytes([b])) for b in range(256)])
    zeros = [zlib.crc32(bytes(n)) for n in range(SHORT + 1)]
    change = [zlib.crc32(bytes([b]) + bytes(n)) ^ zeros[n + 1] for n in range(SHORT) for b in range(256)]
    return letter, np.array(change, dtype=np.uint32), np.array(zeros, dtype=np.uint32)


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, that of ``hashed``, and the byte it starts at: a CRC-32 is the exclusive or of
    what its bytes change, so all words are hashed by one pass over the bytes."""
    letter, change, zeros = checksums()
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = letter[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint32), starts
    lengths = ends - starts
    codes, last = raw[inside[1:-1]], np.cumsum(lengths)
    behind = np.repeat(last.astype(np.int32), lengths) - np.arange(1, len(codes) + 1, dtype=np.int32)
    changed = np.bitwise_xor.accumulate(change[np.minimum(behind, SHORT - 1) * 256 + codes])[last - 1]
    out = changed ^ zeros[np.minimum(lengths, SHORT)]
    out[1:] ^= changed[:-1]
    for k in np.flatnonzero(lengths > SHORT):
        out[k] = zlib.crc32(data[starts[k] : ends[k]])
    return out, starts


def word_bytes(text: str) -> bytes:
    """The text's bytes, in which those beyond ASCII are parts of words."""
    data = text.encode(errors="replace")
    beyond = b"" if text.isascii() else data.translate(None, ASCII)
    return BEYOND.sub(" ", text).encode() if BEYOND.search(beyond.decode()) else data


def hashed_texts(texts: Sequence[object]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all texts, one text after the other, and how many words each has."""
    whole = [word_bytes(t.lower()) if isinstance(t, str) else b"" for t in texts]
    data, found, at = b"\n".join(whole), [], 0
    ends = np.cumsum([len(w) + 1 for w in whole])
    counts = np.zeros(len(whole), dtype=np.int64)
    while at < len(data):  # one long text is cut between words
        cut = END.search(data, at + CHUNK_BYTES)
        end = cut.start() if cut else len(data)
        hashes, starts = hashed_words(data[at:end])
        found.append(hashes)
        counts += np.diff(np.searchsorted(starts + at, ends), prepend=0)
        at = end
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint32), counts


def columns_of(words: Sequence[str]) -> np.ndarray:
    return (hashed(words) % FEATURES).astype(np.uint16)


class Vocabulary:
    """Places of some words, found by their hashes: another word of one hash in 2^32 counts as the first that has it."""

    def __init__(self, words: Sequence[str]):
        found = hashed(words)
        self.hashes, self.places = np.unique(found, return_index=True)
        self.some = np.zeros(1 << 18, dtype=bool)
        self.some[self.hashes % len(self.some)] = True

    def held(self, found: np.ndarray) -> np.ndarray:
        """The places of the words that are among some hashes, in order."""
        if not len(self.hashes) or not len(found):
            return np.zeros(0, dtype=np.uint32)
        distinct = np.unique(found)
        at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
        return np.sort(self.places[at[self.hashes[at] == distinct]]).astype(np.uint32)

    def held_by(self, found: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
        """The same for each of some texts, given the hashes of all and how many are each text's."""
        if not len(self.hashes):
            return [np.zeros(0, dtype=np.uint32)] * len(counts)
        few = np.flatnonzero(self.some[found % len(self.some)])
        at = np.minimum(np.searchsorted(self.hashes, found[few]), len(self.hashes) - 1)
        sound = self.hashes[at] == found[few]
        text, size = np.repeat(np.arange(len(counts)), counts)[few[sound]], int(self.places.max()) + 1
        held = np.unique(text * size + self.places[at[sound]])
        return np.split((held % size).astype(np.uint32), np.searchsorted(held, np.arange(1, len(counts)) * size))


@dataclass
class Passages:
    """The words of some texts in halves: one row of ``columns`` a half, padded with ``FEATURES``."""

    columns: np.ndarray
    owner: np.ndarray
    number: np.ndarray

    @staticmethod
    def of(texts: Sequence[np.ndarray]) -> Passages:
        """Of the columns of each text's words."""
        counts = np.array([-(-len(t) // HALF) for t in texts], dtype=int)
        rows = np.full((int(counts.sum()), HALF), FEATURES, dtype=np.uint16)
        at = 0
        for columns, count in zip(texts, counts, strict=True):
            rows[at : at + count].ravel()[: len(columns)] = columns
            at += count
        owner = np.repeat(np.arange(len(texts)), counts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        return Passages(rows, owner, number)

    def halves(self, weights: np.ndarray) -> np.ndarray:
        """Sums of the rows of ``weights`` over the words of each half."""
        return sum(weights[self.columns[:, i]] for i in range(HALF))

    def joined(self, halves: np.ndarray) -> np.ndarray:
        """Each half with the next one of its text."""
        goes_on = np.append(self.owner[1:] == self.owner[:-1], False) if len(self.owner) else np.zeros(0, dtype=bool)
        after = np.zeros_like(halves)
        after[goes_on] = halves[1:][goes_on[:-1]]
        return halves + after

    def joined_at(self, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The same for some halves only, given the rows to be summed."""
        after = np.minimum(at + 1, max(len(self.owner) - 1, 0))
        goes_on = (after > at) & (self.owner[after] == self.owner[at])
        both = sum(weights[self.columns[at, i]] for i in range(HALF))
        both[goes_on] += sum(weights[self.columns[after[goes_on], i]] for i in range(HALF))
        return both

    def spread(self, joined: np.ndarray) -> np.ndarray:
        """What the passages a half is part of sum up to."""
        begun = np.insert(self.owner[1:] == self.owner[:-1], 0, False) if len(self.owner) else np.zeros(0, dtype=bool)
        earlier = np.zeros_like(joined)
        earlier[begun] = joined[:-1][begun[1:]]
        return joined + earlier


def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Some texts at once, or one long one."""
    for batch in batches:
        start, size = 0, 0
        for end, text in enumerate(batch["columns" if "columns" in batch else "text"]):
            size += len(text) if isinstance(text, (str, bytes)) else 0
            if end > start and (end - start == TEXTS_AT_ONCE or size > CHUNK_BYTES):
                yield batch.iloc[start:end]
                start, size = end, len(text) if isinstance(text, (str, bytes)) else 0
        if start < len(batch):
            yield batch.iloc[start:]


def vocabulary_of(items: DataFrame) -> list[str]:
    """All words of the items' ``text``."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"word": sorted({w for t in batch["text"] for w in words_of(t)})}, dtype=object)

    return [r.word for r in importable(items).select("text").mapInPandas(of, "word string").distinct().orderBy("word").collect()]


def tokenised(rows: DataFrame, vocabulary: Sequence[str] = ()) -> DataFrame:
    """The rows with ``columns``, those of each text's words as 16-bit integers, and ``held``, the places
    in ``vocabulary`` of the words it holds, stored for the passes that follow."""
    names, places = rows.columns, Vocabulary(vocabulary)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in chunks(batches):
            found, counts = hashed_texts(part["text"].tolist())
            columns = np.split((found % FEATURES).astype(np.uint16), np.cumsum(counts)[:-1])
            out = part[names].assign(columns=[c.tobytes() for c in columns], held=[h.tobytes() for h in places.held_by(found, counts)])
            yield out.astype({c: "Int64" for c in ("doc_id", "text_hash") if c in names})

    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return stored(importable(rows).mapInPandas(of, f"{kinds}, columns binary, held binary"))


def unpacked(part: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(c, dtype=np.uint16) for c in part["columns"]]


def frequencies(tokens: DataFrame, n_words: int = 0) -> tuple[int, np.ndarray, int, np.ndarray]:
    """The number of halves of the distinct texts and how many of them hold each column; the number
    of these texts and how many of them hold each of the ``n_words`` words of the vocabulary."""
    halves_at, texts_at, size = FEATURES, FEATURES + 1, FEATURES + 2 + n_words

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(size, dtype=np.int64)
        for part in chunks(batches):
            halves = np.sort(Passages.of(unpacked(part)).columns, axis=1)
            first = np.ones(halves.shape, dtype=bool)
            first[:, 1:] = halves[:, 1:] != halves[:, :-1]
            n[:FEATURES] += np.bincount(halves[first], minlength=FEATURES + 1)[:FEATURES]
            held = np.frombuffer(b"".join(part["held"]), dtype=np.uint32)
            n[FEATURES + 2 :] += np.bincount(held, minlength=n_words)
            n[halves_at] += len(halves)
            n[texts_at] += len(part)
        some = np.flatnonzero(n)
        yield pd.DataFrame({"feature": some, "n": n[some]})

    distinct = tokens.groupBy(F.xxhash64("columns", "held").alias("words")).agg(F.first(F.struct("columns", "held")).alias("t")).select("t.*")
    found = distinct.mapInPandas(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(size)
    n[found["feature"].to_numpy(dtype=int)] = found["n"]
    return int(n[halves_at]), n[:FEATURES], int(n[texts_at]), n[FEATURES + 2 :]


def weights_of(total: int, by_column: np.ndarray) -> np.ndarray:
    """The weight of each column, above 0 even where every half holds it; the padding has none."""
    return np.append(np.log((1 + total) / (0.5 + by_column)), 0.0).astype(np.float32)


def inverse_frequencies(tokens: DataFrame) -> np.ndarray:
    return weights_of(*frequencies(tokens)[:2])


def summed(numbers: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that occur in a table, and for each the sum of the ``rows`` of its places, one row a row of the table.

    Frequent numbers are summed one by one; of the others the first places are added at once, then the second, and so on."""
    flat = numbers.ravel()
    order = np.argsort(flat, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(flat[order]) != 0)[: len(flat)])
    count = np.diff(np.append(first, len(flat)))
    by_count = np.argsort(-count, kind="stable")
    first, count, place = first[by_count], count[by_count], order // numbers.shape[1]
    out = np.zeros((len(first), rows.shape[1]), dtype=rows.dtype)
    frequent = int((count >= 64).sum())
    for k in range(frequent):
        out[k] = rows[place[first[k] : first[k] + count[k]]].sum(axis=0)
    for n in range(int(count[frequent:].max(initial=0))):
        end = int(np.searchsorted(-count, -n, side="left"))
        out[frequent:end] += rows[place[first[frequent:end] + n]]
    return flat[order][first], out


def sketch(tokens: DataFrame, weights: np.ndarray, block: np.ndarray) -> np.ndarray:
    """A'A times a random block, where the rows of A are the weighted passages."""

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weighted = weights[:, None] * np.vstack([block, np.zeros((1, block.shape[1]), dtype=np.float32)])
        total = np.zeros((FEATURES + 1, block.shape[1]))
        for part in chunks(batches):
            passages = Passages.of(unpacked(part))
            if not len(passages.owner):
                continue
            sums = passages.spread(passages.joined(passages.halves(weighted)))
            columns, of_columns = summed(passages.columns, sums)
            total[columns] += of_columns
        some = np.flatnonzero(total[:FEATURES].any(axis=1))
        yield pd.DataFrame({"feature": some.astype(np.int32), "row": pd.Series(list(total[some] * weights[some, None]), dtype=object)})

    # A task's sum is as large as the space, whatever it has read, so few tasks send less.
    tasks = max(tokens.sparkSession.sparkContext.defaultParallelism, tokens.rdd.getNumPartitions() // FITTED_AT_ONCE)
    rows = tokens.select("columns").coalesce(tasks).mapInPandas(multiply, "feature int, row array<double>").select("feature", array_to_vector("row").alias("row"))
    found = rows.groupBy("feature").agg(vector_to_array(Summarizer.sum(F.col("row"))).alias("row")).toPandas()
    out = np.zeros((FEATURES, block.shape[1]))
    if len(found):
        out[found["feature"].to_numpy()] = np.stack(found["row"].to_numpy())
    return out


def sampled(tokens: DataFrame, most: int = FITTED) -> DataFrame:
    """About ``most`` rows, picked by a hash of id and text, for trials: ``leaks`` fits its space on all rows."""
    total = tokens.count()
    share = min(1.0, most / max(total, 1))
    return tokens if share == 1.0 else tokens.filter(F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1_000_000_007)) < int(share * 1_000_000_007))


def decomposed(product: np.ndarray, block: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors and singular values of A from (A'A) times a random block (Nyström)."""
    shift = np.finfo(float).eps * max(np.linalg.norm(product), 1e-30) * len(product) ** 0.5
    shifted = product + shift * block
    inner = block.T @ shifted
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    good = values > max(values.max(), 0) * 1e-10
    left, singular, _ = np.linalg.svd(shifted @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return left[:, :rank], np.sqrt(np.maximum(singular[:rank] ** 2 - shift, 0))


def latent_space(tokens: DataFrame, weights: np.ndarray, rank: int = RANK, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights times right singular vectors over singular values (a row for each column and the padding), and the singular values."""
    block = np.random.default_rng(seed).normal(size=(FEATURES, rank + EXTRA)).astype(np.float32)
    vectors, values = decomposed(sketch(tokens, weights, block), block.astype(float), rank)
    vectors = vectors / np.maximum(values, max(values.max(initial=0.0) * 1e-6, 1e-30))
    return (weights[:, None] * np.vstack([vectors, np.zeros((1, vectors.shape[1]))])).astype(np.float32), values


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def common_subsequence(masks: dict[str, int], words: Sequence[str]) -> int:
    """Length of the longest common subsequence; ``masks`` has a bit for each place of a word in the other sequence."""
    row = 0
    for word in words:
        mask = masks.get(word, 0)
        if mask:
            either = row | mask
            row = either & ((either - ((row << 1) | 1)) ^ either)
    return row.bit_count()


class Item:
    """An item's words, and which of them are content: not too common to be told from chance.

    ``held`` has the share of the texts that hold each word."""

    def __init__(self, item_id: int, words: list[str], held: dict[str, float]):
        self.id, self.words, self.counts = item_id, words, Counter(words)
        self.columns = Counter(columns_of(words).tolist())
        content = [w for w in words if held[w] <= COMMON]
        self.little = len(content) < max(LEAST_ANSWER, LITTLE * len(words))
        if self.little:
            middle = sorted(held[w] for w in words)[len(words) // 2]
            content = [w for w in words if held[w] <= middle]
        # What has to stand around a passage: any of the words, or content only, where there is enough of it.
        self.told_by = set(words if self.little else content)
        # Either half of it is there, or all but what a copy may lack.
        self.least = SIMILAR * len(words) if self.little else min(SIMILAR * len(content), len(content) - (1 - COPIED) * len(words))
        answer = content[-max(LEAST_ANSWER, round(len(content) * ANSWER_SHARE)) :]
        self.n_content, self.n_answer = len(content), len(answer)
        self.masks, self.content_masks, self.answer_masks = map(self.places, (words, content, answer))

    @staticmethod
    def places(words: Sequence[str]) -> dict[str, int]:
        out: dict[str, int] = {}
        for i, word in enumerate(words):
            out[word] = out.get(word, 0) | 1 << i
        return out

    def shares(self, words: Sequence[str]) -> tuple[float, float, float]:
        """Shares of the item, its content and its answer that occur in order; zero where the item cannot have leaked."""
        own, least = [w for w in words if w in self.masks], SIMILAR * len(self.words)
        if len(own) < least or sum((Counter(own) & self.counts).values()) < least:
            return 0.0, 0.0, 0.0
        return (common_subsequence(self.masks, own) / len(self.words),
                common_subsequence(self.content_masks, own) / max(self.n_content, 1),
                common_subsequence(self.answer_masks, own) / max(self.n_answer, 1))


def leaked(whole: float, content: float, answer: float) -> bool:
    return whole >= COPIED or (min(whole, content) >= SIMILAR and answer >= ANSWERED)


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", close: float = CLOSE) -> DataFrame:
    """``doc_id, text_hash, leaks``: the items found in each text, as (item_id, share, answer_share), for every row.

    Null and empty texts hold nothing; items without words are ignored, repeated items
    count once each. A text shorter than an item is searched as it is; an item longer than a
    passage is searched by all its passages. Repeated rows are repeated. A null id stays null.
    """
    rows = narrow(importable(docs), doc_id=doc_id, text=text).withColumn("text_hash", F.xxhash64("text"))
    items = narrow(benchmark, item_id=item_id, text=item_text).filter("text IS NOT NULL")
    columns = "doc_id long, text_hash long, leaks array<struct<item_id:long,share:double,answer_share:double>>"
    number = items.count()
    passes = max(1, -(-number // ITEMS_AT_ONCE))
    vocabulary = vocabulary_of(items)
    rows = tokenised(rows, vocabulary)
    space, shares = np.zeros((FEATURES + 1, 1), dtype=np.float32), {}
    if number:
        n_halves, by_column, n_texts, by_word = frequencies(rows, len(vocabulary))
        shares = dict(zip(vocabulary, by_word / max(n_texts, 1), strict=True))
        space = latent_space(rows, weights_of(n_halves, by_column))[0]
    found = []
    for turn in range(passes):
        some = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == turn).orderBy("item_id", "text").collect()
        held = {w: shares[w] for r in some for w in words_of(r.text)}
        found.append(rows.mapInPandas(search([(r.item_id, r.text) for r in some], held, space, close), columns))
    if passes == 1:
        return found[0]
    each = [f.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.explode("leaks").alias("leak")) for f in found]
    together = reduce(DataFrame.union, each).groupBy("__id", "__hash").agg(F.collect_set("leak").alias("leaks"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("text_hash").eqNullSafe(F.col("__hash"))
    return rows.join(together, same, "left").select("doc_id", "text_hash", F.coalesce("leaks", F.array().cast(found[0].schema["leaks"].dataType)).alias("leaks"))


class Items:
    """The items of one pass, as passages of the latent space and as a table of their words."""

    def __init__(self, texts: Sequence[tuple[int, str]], held: dict[str, float], space: np.ndarray):
        self.items = [Item(i, w, held) for i, t in texts if (w := words_of(t))]
        parts = Passages.of([columns_of(i.words) for i in self.items])
        latent = unit(parts.joined(parts.halves(space)))
        # Every other passage covers the item; they are grouped by their place in it.
        self.latent = []
        for n in range(0, int(parts.number.max(initial=0)) + 1, 2):
            at = np.flatnonzero(parts.number == n)
            self.latent.append(np.full((len(self.items), latent.shape[1]), np.nan, dtype=np.float32))
            self.latent[-1][parts.owner[at]] = latent[at]
        reach = np.array([-(-len(i.words) // HALF) for i in self.items], dtype=int)
        # Columns of the tables below, so that items of one reach stand side by side.
        self.order = np.argsort(reach, kind="stable")
        self.reaches = [(r, *np.searchsorted(reach[self.order], [r, r + 1])) for r in np.unique(reach).tolist()]
        self.holds = np.zeros((FEATURES + 1, len(self.items)), dtype=np.uint8)
        for k, item in enumerate(self.order):
            self.holds[columns_of(list(self.items[item].told_by)), k] = 1
        self.least = np.array([self.items[item].least for item in self.order])
        self.little = np.array([i.little for i in self.items], dtype=bool)

    def candidates(self, passages: Passages, space: np.ndarray, close: float) -> tuple[np.ndarray, np.ndarray]:
        """(half, item): with enough of the item's words around, and close in the latent space or with little content."""
        counts = sum(self.holds[passages.columns[:, i]] for i in range(HALF))
        sums = np.vstack([np.zeros((1, len(self.items)), dtype=np.int32), np.cumsum(counts, axis=0, dtype=np.int32)])
        place = np.arange(len(passages.owner))
        begin = place - passages.number
        end = begin + np.bincount(passages.owner)[passages.owner]
        found = []
        for reach, low, high in self.reaches:
            around = sums[np.minimum(end, place + 2 + reach), low:high] - sums[np.maximum(begin, place - reach), low:high]
            half, item = np.nonzero(around >= np.ceil(self.least[low:high]).astype(np.int32))
            found.append((half, self.order[low + item]))
        half, item = (np.concatenate(x) for x in zip(*found, strict=True))
        # The few that are left are looked up in the latent space.
        some, at = np.unique(half, return_inverse=True)
        own = unit(passages.joined_at(some, space))
        near = self.little[item]
        for latent in self.latent:
            near |= np.einsum("ij,ij->i", own[at], latent[item]) >= close
        half, item = half[near], item[near]
        possible = self.possible(passages, half, item)
        half, item = half[possible], item[possible]
        by_half = np.lexsort((item, half))
        return half[by_half], item[by_half]

    def possible(self, passages: Passages, half: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Which of some candidates can have as many of the item's words around as a leak needs: neighbours
        are told at once, by columns, of which no fewer agree than words."""
        by_item = np.lexsort((half, item))
        p, k, flat = half[by_item], item[by_item], passages.columns.ravel()
        owner, out = passages.owner[p], np.zeros(len(p), dtype=bool)
        if not len(p):
            return out
        first = np.flatnonzero(np.append(True, (np.diff(k) != 0) | (np.diff(p) != 1) | (np.diff(owner) != 0)))
        last = np.append(first[1:], len(p)) - 1
        begin = p[first] - passages.number[p[first]]
        end = begin + np.bincount(passages.owner)[owner[first]]
        for a, b, low, high in zip(first, last, HALF * begin, HALF * end, strict=True):
            this = self.items[k[a]]
            around = flat[max(low, HALF * p[a] - len(this.words)) : min(high, HALF * (p[b] + 2) + len(this.words))].tolist()
            out[by_item[a : b + 1]] = sum((Counter(c for c in around if c in this.columns) & this.columns).values()) >= SIMILAR * len(this.words)
        return out


def search(texts: list[tuple[int, str]], held: dict[str, float], space: np.ndarray, close: float):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = Items(texts, held, space)
        for part in chunks(batches):
            passages = Passages.of(unpacked(part))
            found: list[list[dict]] = [[] for _ in range(len(part))]
            if items.items and len(passages.owner):
                seen, split, texts_here = set(), {}, part["text"].tolist()
                for p, k in zip(*items.candidates(passages, space, close), strict=True):
                    doc, item = passages.owner[p], items.items[k]
                    if (doc, k) in seen:
                        continue
                    if doc not in split:
                        split[doc] = words_of(texts_here[doc])
                    # The passage, and as many words on either side as the item may stick out.
                    middle = passages.number[p] * HALF
                    around = split[doc][max(0, middle - len(item.words)) : middle + 2 * HALF + len(item.words)]
                    share, content, answer = item.shares(around)
                    if leaked(share, content, answer):
                        seen.add((doc, k))
                        found[doc].append({"item_id": item.id, "share": share, "answer_share": answer})
            yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "text_hash": part["text_hash"].astype("Int64"),
                                "leaks": pd.Series(found, index=part.index, dtype=object)})

    return of


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, leaked, n_items, item_ids, share`` for every row; ``share`` is that of the best item."""
    found = leaks(docs, benchmark)
    return found.select("doc_id", (F.size("leaks") > 0).alias("leaked"), F.size("leaks").cast("long").alias("n_items"),
                        F.array_sort(F.transform("leaks", lambda x: x["item_id"])).alias("item_ids"),
                        F.coalesce(F.array_max(F.transform("leaks", lambda x: x["share"])), F.lit(0.0)).alias("share"))


def keep_unleaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with their own columns, in which no item is found.

    Null and empty texts stay; repeated rows stay or go together; an empty table stays empty."""
    columns = docs.columns
    key, words = unused(docs, "__id", "__hash")
    # Stored, so that its size is known: few of the rows leak, and the others need no shuffle to be told from them.
    bad = stored(leaks(docs, benchmark).filter(F.size("leaks") > 0).select(F.col("doc_id").alias(key), F.col("text_hash").alias(words)).distinct())
    same = F.col("doc_id").eqNullSafe(F.col(key)) & F.xxhash64("text").eqNullSafe(F.col(words))
    return docs.join(bad, same, "left_anti").select(*[F.col(f"`{c}`") for c in columns])
