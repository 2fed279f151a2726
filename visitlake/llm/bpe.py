"""Byte-level BPE through a table of prefixes.

The encoding of any byte prefix ends in exactly one token, and that token does not depend
on what follows. A ``PrefixTable`` stores it for every prefix: the last token of prefix
``i`` is the one token ending at ``i`` that pair-wise agrees with the last token of the
prefix before it. Following the table backwards from any end gives the encoding of that
prefix, so bytes can be appended exactly, and after an edit the table is recomputed only
until it agrees with the old one over the length of the longest token.

Two neighbours agree if merging their joint bytes gives the two of them back. Merging the
whole text can only cross a border of two tokens where merging those two alone would, so
pair-wise agreement is enough for the whole sequence.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from visitlake.llm.common import importable, narrow

ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Bounds on what a worker remembers of earlier words. Only speed depends on them.
WORDS_KEPT, PAIRS_KEPT, LONG_WORD = 400_000, 400_000, 400
#: Texts whose ids a worker holds at once.
TEXTS_AT_ONCE = 256


class Vocabulary:
    """Ranks of byte strings: the lower the rank, the earlier the merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: piece for piece, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._agrees: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}

    @staticmethod
    def read(path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return Vocabulary({base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())})

    def merged(self, data: bytes) -> list[int]:
        """Plain lowest-rank-first merging. For short strings only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            found = [(self.ranks[two], i) for i in range(len(parts) - 1) if (two := parts[i] + parts[i + 1]) in self.ranks]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def reachable(self, token: int) -> bool:
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = self.merged(self.bytes_of[token]) == [token]
        return known

    def agree(self, left: int, right: int) -> bool:
        known = self._agrees.get((left, right))
        if known is None:
            if len(self._agrees) >= PAIRS_KEPT:
                self._agrees.clear()
            known = self._agrees[left, right] = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@dataclass
class PrefixTable:
    """One piece of text and the last token of each of its prefixes (``last[0]`` is unused)."""

    vocabulary: Vocabulary
    data: bytes = b""
    last: list[int] = field(default_factory=lambda: [-1])

    def __post_init__(self) -> None:
        start, self.data = self.data, b""
        self.append(start)

    def _last_token(self, data: bytes, last: list[int], end: int) -> int:
        ranks, agree = self.vocabulary.ranks, self.vocabulary.agree
        for start in range(max(0, end - self.vocabulary.longest), end):
            token = ranks.get(data[start:end])
            if token is not None and self.vocabulary.reachable(token) and (start == 0 or agree(last[start], token)):
                return token
        raise ValueError(f"the vocabulary has no token for byte {data[end - 1]}")

    def append(self, more: bytes) -> None:
        data = self.data + more
        for end in range(len(self.data) + 1, len(data) + 1):
            self.last.append(self._last_token(data, self.last, end))
        self.data = data

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Replaces bytes ``start`` to ``end``; returns how many prefixes were computed anew."""
        data = self.data[:start] + new + self.data[end:]
        shift, last, same, computed = len(new) - (end - start), self.last[: start + 1], 0, 0
        for at in range(start + 1, len(data) + 1):
            last.append(self._last_token(data, last, at))
            computed += 1
            beyond = at >= start + len(new) + self.vocabulary.longest
            same = same + 1 if beyond and last[at] == self.last[at - shift] else 0
            if same >= self.vocabulary.longest:
                last.extend(self.last[at - shift + 1 :])
                break
        self.data, self.last = data, last
        return computed

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes, of all by default."""
        at, found = len(self.data) if end is None else end, []
        while at:
            found.append(self.last[at])
            at -= len(self.vocabulary.bytes_of[found[-1]])
        return found[::-1]


class Encoder(dict):
    """Encodes texts match by match; it is itself the memory of matches met before."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        super().__init__()
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.split = self.pattern.findall

    def ids_of(self, piece: bytes) -> list[int]:
        whole = self.vocabulary.ranks.get(piece)
        return [whole] if whole is not None else PrefixTable(self.vocabulary, piece).tokens()

    def __missing__(self, piece: str) -> bytes:
        packed = np.array(self.ids_of(piece.encode()), dtype="<u4").tobytes()
        if len(piece) <= LONG_WORD:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.split(text)))

    def decode(self, packed: bytes) -> bytes:
        return self.vocabulary.decode(np.frombuffer(packed, dtype="<u4").tolist())


class EditableText:
    """A text under edit: its matches, each with its prefix table, kept in step."""

    #: The pattern looks this far beyond a match (a contraction is three characters).
    LOOKAHEAD = 3

    def __init__(self, encoder: Encoder, text: str):
        self.encoder, self.text, self.pieces = encoder, text, encoder.split(text)
        self.packed = [encoder[p] for p in self.pieces]

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> int:
        """Replaces characters; returns how many matches were split and encoded anew."""
        text, shift = self.text[:start] + new + self.text[end:], len(new) - (end - start)
        starts = np.cumsum([0, *map(len, self.pieces)]).tolist()
        keep = 0
        while keep < len(self.pieces) and starts[keep + 1] + self.LOOKAHEAD <= start:
            keep += 1
        old_start = {at: i for i, at in enumerate(starts) if at >= end}
        at, fresh, rest = starts[keep], [], len(self.pieces)
        while at < len(text):
            if at >= start + len(new) and at - shift in old_start:
                rest = old_start[at - shift]
                break
            match = self.encoder.pattern.match(text, at)
            fresh.append(match.group())
            at = match.end()
        self.pieces[keep:rest] = fresh
        self.packed[keep:rest] = [self.encoder[p] for p in fresh]
        self.text = text
        return len(fresh)

    def ids(self) -> list[int]:
        return np.frombuffer(b"".join(self.packed), dtype="<u4").tolist()


@cache
def encoder_for(path: str, pattern: str) -> Encoder:
    """One per Python worker."""
    return Encoder(Vocabulary.read(path), pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
                     keep_ids: bool = False) -> DataFrame:
    """Encodes each whole text and decodes the ids again.

    A row in, a row out, without a shuffle; null texts count as empty (no tokens, the hash of
    nothing), repeated rows are repeated, other columns are left out. Memory is bounded by a batch of texts, the ids
    of ``TEXTS_AT_ONCE`` and ``WORDS_KEPT``. ``keep_ids`` adds the ids themselves as ``ids array<long>``.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_for(path, pattern)
        for part in (batch.iloc[at : at + TEXTS_AT_ONCE] for batch in batches for at in range(0, len(batch), TEXTS_AT_ONCE)):
            rows = []
            for key, whole in zip(part["doc_id"], part["text"], strict=True):
                packed = encoder.encode(whole) if isinstance(whole, str) else b""
                row = (key, len(packed) // 4, hashlib.sha256(packed).hexdigest(),
                       hashlib.sha256(encoder.decode(packed)).hexdigest())
                rows.append((*row, np.frombuffer(packed, dtype="<u4").astype("int64")) if keep_ids else row)
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"doc_id": "Int64"})

    schema = ENCODED + ", ids array<long>" * keep_ids
    return narrow(importable(docs), doc_id=doc_id, text=text).mapInPandas(encode, schema)
