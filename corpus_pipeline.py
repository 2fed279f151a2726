"""From raw documents to token ids: five stages, each over all that the one before it kept.

Each stage is written as Parquet and read again, so a lost executor costs one stage at most.
The order matters: toxic documents go first, so that nothing learns from or is compared
with them; boilerplate goes before near duplicates are looked for, so that pages are not
alike by their footers; and only texts that stay are encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from visitlake.llm import bpe, hyperminhash, latent, linespread, toxicity
from visitlake.llm.common import read, stored


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity model, fitted on this table's labels, rejects."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that many sites share; every document stays, ``n_chars`` follows its text."""
    return linespread.strip_documents(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Shingles of five words, at least 80 percent in common."""
    return hyperminhash.keep_one(docs, share=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a benchmark item is found."""
    return latent.keep_unleaked(docs, read(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids``."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.encode_documents(docs, path, pattern, keep_ids=True)


STAGES = [
    ("toxicity", clean_language),
    ("line dedup", without_boilerplate),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", encoded),
]

#: A fitted model, sketches and a tokenizer are beyond SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage, read from where it was written."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
