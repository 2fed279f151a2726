"""Secrets in texts, told apart by how many owners hold the same value.

Patterns find candidates in every whole text. The hashes of their values are then counted
over the whole corpus: a value that many owners or many repositories hold is an example
copied from documentation, one that a single owner holds looks live. Live values are also
found where they stand bare, without the words that gave them away elsewhere: those spans
are added as ``copy``. Every string as long as a value can be is a candidate for that; a first
scan finds the live values, and a bitmap of their hashes keeps the second one from listing
every word, before a join decides. Values are compared without trailing ``TRAILING``, wherever
they stand, and never leave the scan, only their hashes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.llm.common import importable, narrow, sha256_hex, stored

KINDS = ("assign", "access", "hex", "copy")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# The runs of 32 and more among the leftmost runs; a shorter run cannot hide a longer one.
HEX = re.compile(r"[0-9a-f]{32,}")
BARE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
#: Padding and punctuation: not told apart from what follows a value.
TRAILING = ".=-"
#: Bits of the bitmap of live hashes, named by their first six hexadecimal digits.
BITS = 1 << 24
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: A value of at most this many owners and repositories looks live.
MAX_OWNERS, MAX_REPOSITORIES = 1, 3
SCANNED = ("doc_id long, owner string, repository string, n_assign long, n_access long, n_hex long, "
           "base_sha256 string, found array<struct<start:int,kind:int,end:int,value:string>>")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value), leftmost non-overlapping for each kind, short ones dropped after matching."""
    lowered, found = text.lower(), []
    if any(w in lowered for w in WORDS):
        found += [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(found)


def hashed(value: str) -> str:
    """The hash of a value's normal form."""
    return hashlib.sha256((value.rstrip(TRAILING) or value).encode()).hexdigest()[:32]


def bare_spans(text: str, base: list[tuple[int, int, int, str]], known: np.ndarray, met: dict[str, str | None]) -> list[tuple[int, int, int, str]]:
    """Strings outside the base spans whose hash is in the bitmap: copies, if a live value is the same.

    ``met`` keeps the hashes of strings met before, None for those that are not in the bitmap."""
    found = []
    for m in BARE.finditer(text):
        value = m.group()
        if value not in met:
            digest = hashed(value)
            bit = int(digest[:6], 16)
            met[value] = digest if known[bit >> 5] >> (bit & 31) & 1 else None
        if met[value] is not None:
            end = m.start() + len(value.rstrip(TRAILING) or value)
            if all(end <= b[0] or m.start() >= b[2] for b in base):
                found.append((m.start(), 3, end, value))
    return found


def bitmap(values: DataFrame) -> np.ndarray:
    """A bit for each ``value`` of hashes, as 32-bit words."""
    bits = values.select(F.conv(F.substring("value", 1, 6), 16, 10).cast("long").alias("bit"))
    words = bits.groupBy(F.expr("bit DIV 32").alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 32 AS INT)))").alias("bits")).toPandas()
    out = np.zeros(BITS // 32, dtype=np.uint32)
    out[words["word"].to_numpy(dtype=int)] = words["bits"].to_numpy(dtype=np.uint32)
    return out


def named(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, _ in spans)


def scan(known: np.ndarray | None = None):
    """Base spans of each text, and with a bitmap of live hashes what may be bare copies of them."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, met = [], {}
            for text in batch["text"]:
                text = text if isinstance(text, str) else ""
                base = base_spans(text)
                counts = [sum(b[1] == kind for b in base) for kind in range(3)]
                bare = bare_spans(text, base, known, met) if known is not None else []
                found = [{"start": s, "kind": k, "end": e, "value": hashed(v)} for s, k, e, v in base + bare]
                rows.append((*counts, sha256_hex(named(base).encode()), found))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "found"], index=batch.index)
            yield pd.concat([batch[["doc_id", "owner", "repository"]].astype({"doc_id": "Int64"}), out], axis=1)

    return of


def ownership(found: DataFrame) -> DataFrame:
    """``value, n_owners, n_repositories`` of every base value, combined before each shuffle."""
    return (found.filter("kind < 3").groupBy("value", "owner", "repository").agg(F.lit(1).alias("one"))
            .groupBy("value", "owner").agg(F.count("*").alias("n"))
            .groupBy("value").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories")))


def scan_documents(docs: DataFrame, owner: Column, repository: Column, doc_id: str = "doc_id", text: str = "text",
                   max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """One row for each row: the base counts and hash, all spans, and how many of them hold a
    live value (``n_live``) or a widely copied one (``n_example``).

    A null text is empty; a null owner or repository counts as one of its own. Repeated rows
    are repeated; they belong to the same owner and do not make a value an example.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                       F.coalesce(owner, F.lit("")).alias("owner"), F.coalesce(repository, F.lit("")).alias("repository"))
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    first = importable(rows).mapInPandas(scan(), SCANNED).select("owner", "repository", F.explode("found").alias("f"))
    scanned = rows.mapInPandas(scan(bitmap(ownership(first.select("owner", "repository", "f.*")).filter(live))), SCANNED)
    # The row number holds from here on, because it is written with the rows.
    rows = stored(scanned.withColumn("row", F.monotonically_increasing_id()))
    found = rows.select("row", "owner", "repository", F.explode("found").alias("f")).select("row", "owner", "repository", "f.*")
    known = ownership(found).select("value", live.alias("live"))
    spans = (found.join(known, "value").filter("kind < 3 OR live").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("all"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example")))
    kinds = F.array(*map(F.lit, KINDS))
    listed = F.transform("all", lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"]))
    return rows.join(spans, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce(F.array_join(listed, ","), F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"))
